"""Harmonise discovered columns to the fixed measures, split by person type, stack.

Column mapping is worked out per table from its own array of names, so pages with
different headings are handled in one pass without joining or shuffling cells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clean, fixed, gates

TARGETS = [fixed.BANK, *fixed.MEASURES]
MAPPING_TYPE = "array<struct<destino:string,origen:string,tipo:string>>"


def _first_matching(names: Column, lowered: Column, target: str) -> Column:
    """First column, in position order, that stands for the target; NULL without one.

    ``lowered`` holds the names in lower case, made once for all targets.
    """
    if target == fixed.BANK:
        found = F.filter(names, lambda n: n == fixed.BANK)
    elif target in fixed.MEASURE_EXACT:
        found = F.filter(names, lambda n, i: F.get(lowered, i).isin(fixed.MEASURE_EXACT[target]))
    else:
        words = fixed.MEASURE_KEYWORDS[target]
        found = F.filter(
            names,
            lambda n, i: reduce(lambda a, b: a | b, [F.get(lowered, i).contains(w.lower()) for w in words]),
        )
    return F.try_element_at(found, F.lit(1))


def map_columns(df: DataFrame, names: str = "columnas", out: str = "mapa") -> DataFrame:
    """Add the mapping of the nine targets: array of ``destino, origen, tipo``.

    ``tipo`` is ``keyword`` or ``positional``: targets without a matching column take the
    columns no target uses, in order. That can be wrong, hence the mark. ``names`` is the
    full list of columns, bank first.
    """
    lowered = df.withColumn("_minusculas", F.transform(names, lambda n: F.lower(n)))
    matched = lowered.withColumn(
        "_por_clave",
        F.array(
            *[
                F.struct(F.lit(t).alias("destino"), _first_matching(F.col(names), F.col("_minusculas"), t).alias("origen"))
                for t in TARGETS
            ]
        ),
    )
    # A list of the columns in use would be made again for every name.
    spare = F.filter(
        names, lambda n: ~F.coalesce(F.exists("_por_clave", lambda m: m["origen"] == n), F.lit(False))
    )
    lacking = F.transform(
        F.filter("_por_clave", lambda m: m["origen"].isNull() & (m["destino"] != fixed.BANK)),
        lambda m: m["destino"],
    )
    placed = matched.withColumn("_libres", spare).withColumn("_faltan", lacking)

    def complete(m: Column) -> Column:
        turn = F.array_position("_faltan", m["destino"]).cast("int")
        extra = F.when(turn > 0, F.get("_libres", turn - 1))
        return F.struct(
            m["destino"].alias("destino"),
            F.coalesce(m["origen"], extra).alias("origen"),
            F.when(m["origen"].isNotNull(), "keyword")
            .when(extra.isNotNull(), "positional").alias("tipo"),
        )

    return placed.withColumn(out, F.transform("_por_clave", complete)).drop(
        "_minusculas", "_por_clave", "_libres", "_faltan"
    )


def with_bank_first(names: Column) -> Column:
    return F.concat(F.array(F.lit(fixed.BANK)), names)


def label_first(df: DataFrame) -> DataFrame:
    """``Banco`` as first column; without one the first column takes that name."""
    if fixed.BANK not in df.columns and df.columns:
        df = df.withColumnRenamed(df.columns[0], fixed.BANK)
    return df.select(f"`{fixed.BANK}`", *[f"`{c}`" for c in df.columns if c != fixed.BANK])


def _places(tables: DataFrame, measures: list[str]) -> DataFrame:
    """Add ``lugares``: for each measure the position of its cell in a row.

    ``indices`` gives the place in a row of each of the ``columnas``.
    """
    mapped = map_columns(
        tables.withColumn("_todas", with_bank_first(F.col("columnas"))), names="_todas"
    )
    # Each measure has its place in the mapping. Looked up by name inside a function over the measures, the optimiser
    # would put the whole mapping into that function, to be worked out again for each of them.
    sources = F.array(
        *[
            F.get("mapa", F.lit(TARGETS.index(m)))["origen"] if m in TARGETS else F.lit(None).cast("string")
            for m in measures
        ]
    )
    return mapped.withColumn(
        "lugares",
        F.transform(sources, lambda s: F.get("indices", F.array_position("columnas", s).cast("int") - 1)),
    ).drop("_todas")


def _bank_rows(tables: DataFrame, keep: list[str], measures: list[str]) -> DataFrame:
    """One row per bank row of each table: ``keep`` and ``f`` (banco, textos by measure)."""
    if "indices" not in tables.columns:
        tables = tables.withColumn("indices", F.transform("columnas", lambda c, i: i))
    placed = _places(tables, measures)
    rows = F.transform(
        "filas",
        lambda r, i: F.struct(
            F.get("bancos", i).alias("banco"),
            F.transform("lugares", lambda p: F.get(r, p)).alias("textos"),
        ),
    )
    # The outer forms keep the optimiser from repeating the extraction in a size filter.
    return placed.select(*keep, F.explode_outer(rows).alias("f")).filter(F.col("f").isNotNull())


def harmonise(tables: DataFrame, keep: list[str], measures: list[str] = fixed.MEASURES) -> DataFrame:
    """Long facts ``banco, bucket, valor, valor_raw`` for every target measure.

    ``tables`` has ``columnas``, ``filas`` and ``bancos``, one row per table, so columns are
    matched once per table and each bank only picks cells by position. Both the number and,
    where a text is not one, the text itself are kept.
    """
    banks = _bank_rows(tables, keep, measures)
    names = F.array(*[F.lit(m) for m in measures])
    cells = banks.select(*keep, "f.banco", F.posexplode_outer("f.textos").alias("n", "texto"))
    rate = clean.clean_rate(F.col("texto"))
    return cells.select(
        *keep, "banco", F.get(names, F.col("n")).alias("bucket"),
        rate["valor"].alias("valor"), rate["valor_raw"].alias("valor_raw"),
    )


def harmonise_wide(tables: DataFrame, keep: list[str], measures: list[str] = fixed.MEASURES) -> DataFrame:
    """``banco`` and one column per measure, a row for every bank row of the tables.

    Straight from the cells, without a shuffle: rows that share a name or have none stay apart.
    """
    banks = _bank_rows(tables, keep, measures)
    values = [
        clean.clean_rate(F.get("f.textos", F.lit(i)))["valor"].alias(m) for i, m in enumerate(measures)
    ]
    return banks.select(*keep, "f.banco", *values)


def split_person(tables: DataFrame) -> DataFrame:
    """Columns of a person-type table by person, names cut to their term bucket.

    Gives up to two rows per table, with ``tipo_persona``, the ``columnas`` of that person
    and their ``indices`` in the table's rows, which stay as they are. Columns naming
    neither person are halved by position, the odd one going to the second half.
    """
    pairs = F.transform("columnas", lambda n, i: F.struct(n.alias("n"), i.alias("i")))
    with_pairs = tables.withColumn("_pares", pairs)
    natural = F.filter("_pares", lambda p: p["n"].rlike(fixed.NATURAL_PATTERN))
    legal = F.filter("_pares", lambda p: p["n"].rlike(fixed.LEGAL_PATTERN))
    neither = (F.size(natural) == 0) & (F.size(legal) == 0)
    half = F.floor(F.size("_pares") / F.lit(2)).cast("int")
    parts = F.array(
        F.struct(
            F.lit(fixed.NATURAL).alias("tipo_persona"),
            F.when(neither, F.filter("_pares", lambda p: p["i"] < half)).otherwise(natural).alias("p"),
        ),
        F.struct(
            F.lit(fixed.LEGAL).alias("tipo_persona"),
            F.when(neither, F.filter("_pares", lambda p: p["i"] >= half)).otherwise(legal).alias("p"),
        ),
    )
    others = [c for c in tables.columns if c != "columnas"]
    return (
        with_pairs.select(*others, F.explode_outer(parts).alias("t"))
        .filter(F.size("t.p") > 0)
        .select(
            *others,
            "t.tipo_persona",
            F.transform("t.p", lambda p: clean.bucket_name(p["n"])).alias("columnas"),
            F.transform("t.p", lambda p: p["i"]).alias("indices"),
        )
    )


def general_rates(tables: DataFrame, keep: list[str]) -> DataFrame:
    """General rates of both currency types, long form."""
    return harmonise(tables.filter(~F.col("por_persona")), [*keep, "tipo_moneda"])


def general_wide(tables: DataFrame, keep: list[str]) -> DataFrame:
    """General rates of both currency types, one row per bank row."""
    return harmonise_wide(tables.filter(~F.col("por_persona")), [*keep, "tipo_moneda"])


def person_wide(tables: DataFrame, keep: list[str]) -> DataFrame:
    """Term rates by person type, one row per bank row and person."""
    return harmonise_wide(
        split_person(tables.filter("por_persona")), [*keep, "tipo_moneda", "tipo_persona"], fixed.TERM_BUCKETS
    )


def person_rates(
    tables: DataFrame, keep: list[str], natural: bool = True, legal: bool = True
) -> DataFrame:
    """Term rates by person type, long form; either person can be left out."""
    parts = split_person(tables.filter("por_persona"))
    chosen = parts.filter(gates.person_kept(F.col("tipo_persona"), natural, legal))
    return harmonise(chosen, [*keep, "tipo_moneda", "tipo_persona"], fixed.TERM_BUCKETS)


def to_wide(
    long: DataFrame, keys: list[str], measures: list[str] = fixed.MEASURES, value: str = "valor"
) -> DataFrame:
    """One column per measure, for long facts that have one value per key and bucket.

    ``keys`` must tell rows apart; ``harmonise_wide`` does it without any for tables with unnamed banks.
    """
    return long.groupBy(*keys).pivot("bucket", measures).agg(F.max(value)).select(*keys, *[f"`{m}`" for m in measures])


def to_long(wide: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Measures as rows ``bucket, valor``; empty ones are kept."""
    return wide.unpivot(keys, [F.col(f"`{m}`").alias(m) for m in measures], "bucket", "valor")


def canonical(df: DataFrame, columns: list[str]) -> DataFrame:
    """Output columns in order; absent ones are empty doubles."""
    return df.select(
        *[
            F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("double").alias(c)
            for c in columns
        ]
    )


def tagged(df: DataFrame, **tags: str) -> DataFrame:
    """Constant columns in front of the others."""
    return df.select(*[F.lit(v).alias(k) for k, v in tags.items()], "*")


def stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
