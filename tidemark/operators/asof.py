"""Backward as-of join: for each probe the last known values of its entity, however many rows an entity has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    probes: DataFrame,
    values: DataFrame,
    by: list[str],
    probe_time: str,
    value_time: str,
    measures: list[str],
    block: str = "month",
    lookback_seconds: int | None = None,
    strict: bool = False,
    tie: list[str] | None = None,
) -> DataFrame:
    """Every probe row with ``measures`` and ``<measure>_desde``, the time each was reported at.

    Each measure is its last non-NULL value at or before (``strict``: before) the probe's time, for itself: one that is
    missing in the last row comes from an older one. Nothing older than ``lookback_seconds`` counts. Of several
    values for one time the last by ``tie`` counts, then the greatest. Without a value, for a NULL time and for a
    NULL entity column that no value has, the measures are NULL; NULL entities match each other. Repeated probes stay.

    Probes and values are united and cut into blocks of time per entity. A block is carried through by a window of
    its own, so an entity with very many rows is many groups; what it starts with is the last value of the blocks
    before it, found among one aggregated row per block. There is no range join, and no group grows with an entity.
    """
    taken = [c for c in (*measures, *(f"{m}_desde" for m in measures)) if c in probes.columns]
    if taken:
        raise ValueError(f"probes have columns of the result's names: {taken}")
    keys = [f"_k{i}" for i in range(len(by))]
    order = [f"_o{i}" for i in range(len(tie or []))]
    own = [f"_c{i}" for i in range(len(probes.columns))]
    facts = [f"_m{i}" for i in range(len(measures))]
    kinds = dict(values.dtypes)

    def empty(kind: str) -> Column:
        return F.lit(None).cast(kind)

    # A value goes in front of the probes of its time, or behind them where it has to be earlier.
    value_rows = values.filter(F.col(value_time).isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(value_time).cast("timestamp").alias("_t"),
        F.lit(1 if strict else -1).alias("_paso"), *[F.col(c).alias(o) for c, o in zip(tie or [], order)],
        *[F.struct(F.col(value_time).alias("t"), F.col(m).alias("v")).alias(f) for m, f in zip(measures, facts)],
        *[empty(kind).alias(c) for c, (_, kind) in zip(own, probes.dtypes)],
    )
    value_rows = value_rows.withColumns({f: F.when(F.col(f"{f}.v").isNotNull(), F.col(f)) for f in facts})
    probe_rows = probes.select(
        *[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(probe_time).cast("timestamp").alias("_t"),
        F.lit(0).alias("_paso"), *[empty(kinds[c]).alias(o) for c, o in zip(tie or [], order)],
        *[empty(f"struct<t:{kinds[value_time]},v:{kinds[m]}>").alias(f) for m, f in zip(measures, facts)],
        *[F.col(c).alias(n) for c, n in zip(probes.columns, own)],
    )
    rows = value_rows.unionByName(probe_rows).withColumn("_b", F.date_trunc(block, "_t"))
    # The last value of a block, combined in every input task; blocks without values are not there.
    rank = F.struct("_t", *order)
    ends = value_rows.withColumn("_b", F.date_trunc(block, "_t")).groupBy(*keys, "_b").agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), F.struct(rank, F.col(f"{f}.v")))).alias(f) for f in facts]
    )
    # Blocks of probes alone need what came before them too.
    asked = probe_rows.select(*keys, F.date_trunc(block, "_t").alias("_b")).distinct()
    known = ends.unionByName(asked.select("*", *[empty(ends.schema[f].dataType.simpleString()).alias(f) for f in facts]))
    spans = known.groupBy(*keys, "_b").agg(*[F.max(f).alias(f) for f in facts])
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select(
        *[F.col(k).alias(f"s{k}") for k in keys], F.col("_b").alias("s_b"),
        *[F.last(f, ignorenulls=True).over(before).alias(f"s{f}") for f in facts],
    )
    same = F.col("_b").eqNullSafe(F.col("s_b"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"s{k}"))
    inside = Window.partitionBy(*keys, "_b").orderBy(
        "_t", "_paso", *order, *[F.col(f"{f}.v") for f in facts]
    ).rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.select("*", *[_last(f, inside).alias(f"l{f}") for f in facts]).filter(F.col("_paso") == 0)
    met = carried.join(starts, same, "left")

    def found(f: str) -> Column:
        value = F.coalesce(F.col(f"l{f}"), F.col(f"s{f}"))
        fresh = F.col("_t").isNotNull()
        if lookback_seconds is not None:
            age = F.timestamp_diff("MICROSECOND", value["t"].cast("timestamp"), F.col("_t"))
            fresh = fresh & (age <= lookback_seconds * 1_000_000)
        return F.when(fresh, value)

    out = [F.col(n).alias(c) for n, c in zip(own, probes.columns)]
    for m, f in zip(measures, facts):
        out += [found(f)["v"].alias(m), found(f)["t"].alias(f"{m}_desde")]
    return met.select(*out)


def _last(fact: str, window) -> Column:
    return F.last(fact, ignorenulls=True).over(window)
