"""Keyed upsert of a batch into an accumulated table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar, clean

GENERAL_KEYS = ["fecha", "tipo_moneda", "banco"]
PERSON_KEYS = ["fecha", "tipo_moneda", "tipo_persona", "banco"]


def _with_dates(df: DataFrame) -> DataFrame:
    if "fecha" not in df.columns:
        return df
    text = dict(df.dtypes)["fecha"] == "string"
    day = calendar.parse_day(F.col("fecha")) if text else F.col("fecha").cast("date")
    return df.withColumn("fecha", day)


def upsert(existing: DataFrame | None, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows without a namesake in the batch, plus the whole batch.

    Keys compare as text, dates day-first, NULL and blank alike. A key column missing on
    either side turns the merge into an append. Columns only one side has are kept. The
    batch is taken as it is, repeated keys included.

    Batch keys are made distinct before the join, so a key that fills the batch costs one
    row; a key that fills ``existing`` leaves the anti join a skewed stream side, which
    adaptive execution splits.
    """
    if existing is None:
        return _with_dates(batch)
    keyed = all(k in existing.columns and k in batch.columns for k in keys)
    kept = existing
    if keyed:
        names = [f"_clave_{i}" for i in range(len(keys))]
        new_keys = batch.select(
            *[clean.key_text(batch, k).alias(n) for k, n in zip(keys, names)]
        ).distinct()
        same = F.lit(True)
        for key, name in zip(keys, names):
            same = same & clean.key_text(existing, key).eqNullSafe(F.col(name))
        kept = existing.join(new_keys, same, "left_anti")
    return _with_dates(kept).unionByName(_with_dates(batch), allowMissingColumns=True)


def ordered(df: DataFrame, keys: list[str]) -> DataFrame:
    """By date, missing dates last; the other keys make the order definite."""
    rest = [F.col(k).asc_nulls_last() for k in keys if k in df.columns and k != "fecha"]
    return df.orderBy(F.col("fecha").asc_nulls_last(), *rest)


def latest_per_key(df: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """One row per key, the last to arrive; an aggregate, so hot keys combine map-side.

    A NULL arrival is before all others, and blank text keys are the same as NULL ones.
    """
    rest = [c for c in df.columns if c not in keys]
    # Inside a struct a NULL compares as the least value instead of dropping its row.
    picked = F.max_by(F.struct(*rest), F.struct(F.col(arrival))).alias("_ultima")
    text = [c for c, kind in df.dtypes if c in keys and kind == "string"]
    df = df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in text})
    return df.groupBy(*keys).agg(picked).select(
        *keys, *[F.col(f"_ultima.{c}").alias(c) for c in rest]
    )


def upsert_versions(existing: DataFrame | None, batch: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """The newest version of every key, whichever side has it; ``arrival`` stays a column.

    Rows of one side that share a key and its greatest arrival are a version of that key, and stay or go together; a
    NULL arrival is before all others. Of two versions with one arrival the one with the greater checksum
    stays, so batches may be merged in any order, and again, and give the same table. Keys compare as in ``upsert``.

    Only keys, arrivals and checksums are aggregated, map-side first; rows meet their key's verdict in one join.
    """
    rows = _with_dates(batch).withColumn("_lado", F.lit(1))
    if existing is not None:
        rows = _with_dates(existing).withColumn("_lado", F.lit(0)).unionByName(rows, allowMissingColumns=True)
    names = [f"_clave_{i}" for i in range(len(keys))]
    keyed = rows.select("*", *[clean.key_text(rows, k).alias(n) for k, n in zip(keys, names)])
    # Columns only one side has are empty on the other, and an empty one does not count in the hash.
    content = [c for c in sorted(rows.columns) if c not in ("_lado", arrival, *keys)]
    check = F.bit_xor(F.xxhash64(*content) if content else F.lit(0).cast("bigint"))
    versions = keyed.groupBy(*names, F.col(arrival).alias("_llegada"), F.col("_lado").alias("_de")).agg(check.alias("_suma"))
    newest = versions.groupBy(*names).agg(F.max(F.struct("_llegada", "_suma", "_de")).alias("_v")).select(
        *[F.col(n).alias(f"_{n}") for n in names], F.col("_v._llegada").alias("_llegada"), F.col("_v._de").alias("_de")
    )
    same = F.col(arrival).eqNullSafe(F.col("_llegada")) & (F.col("_lado") == F.col("_de"))
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return keyed.join(newest, same, "left_semi").drop("_lado", *names)
