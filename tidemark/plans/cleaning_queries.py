"""Clean-up queries over texts rendered from customer balances, names and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import clean, fixed
from tidemark.plans.registry import query, table

NUMBER_SQL = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
NBSP = " "


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s{NBSP}]+|[\\s{NBSP}]+$', '', 'g')"


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


AMOUNT_TEXT_SQL = f"""
texts AS (SELECT c_custkey, c_acctbal, CASE c_custkey % 12
    WHEN 0 THEN '-' WHEN 1 THEN 'S/M' WHEN 2 THEN '{NBSP}' WHEN 3 THEN ''
    WHEN 4 THEN NULL WHEN 5 THEN 'N/A' WHEN 6 THEN '1_000' WHEN 7 THEN '1.5d'
    WHEN 8 THEN ' ' || round(c_acctbal * 100)::BIGINT || ',5 '
    WHEN 9 THEN '{NBSP}' || round(c_acctbal * 100)::BIGINT || ',000.25' || chr(9)
    WHEN 10 THEN '--'
    ELSE round(c_acctbal * 100)::BIGINT || '.75' END AS texto FROM customer)
"""


def amount_texts(spark, sf_dir):
    """Balances as cell texts, with the marks that stand for missing values mixed in."""
    cents = F.round(F.col("c_acctbal") * 100).cast("long")
    kind = F.col("c_custkey") % 12
    text = (
        F.when(kind == 0, "-").when(kind == 1, "S/M").when(kind == 2, NBSP).when(kind == 3, "")
        .when(kind == 4, F.lit(None)).when(kind == 5, "N/A").when(kind == 6, "1_000")
        .when(kind == 7, "1.5d")
        .when(kind == 8, F.concat(F.lit(" "), cents, F.lit(",5 ")))
        .when(kind == 9, F.concat(F.lit(NBSP), cents, F.lit(",000.25\t")))
        .when(kind == 10, "--")
        .otherwise(F.concat(cents, F.lit(".75")))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", text.alias("texto"))


@query(
    "clean_amount",
    f"""
    WITH {AMOUNT_TEXT_SQL}, t AS (SELECT *, {strip_sql("texto")} AS s FROM texts)
    SELECT c_custkey, texto, CASE WHEN s NOT IN ('', '-', 'S/M')
      AND regexp_matches(replace(s, ',', ''), {NUMBER_SQL})
      THEN try_cast(replace(s, ',', '') AS DOUBLE) END AS valor FROM t
    """,
)
def clean_amount(spark, sf_dir):
    return amount_texts(spark, sf_dir).withColumn("valor", clean.clean_amount(F.col("texto")))


@query(
    "clean_rate_split",
    f"""
    WITH {AMOUNT_TEXT_SQL}, t AS (SELECT *, {strip_sql("texto")} AS s FROM texts),
    u AS (SELECT *, CASE WHEN regexp_matches(replace(replace(s, ',', ''), ' ', ''), {NUMBER_SQL})
      THEN try_cast(replace(replace(s, ',', ''), ' ', '') AS DOUBLE) END AS n FROM t)
    SELECT c_custkey, CASE WHEN s NOT IN ({sql_list(fixed.RATE_MISSING)}) THEN n END AS valor,
      CASE WHEN s NOT IN ({sql_list(fixed.RATE_MISSING)}) AND n IS NULL THEN s END AS valor_raw
    FROM u
    """,
)
def clean_rate_split(spark, sf_dir):
    rates = amount_texts(spark, sf_dir).withColumn("r", clean.clean_rate(F.col("texto")))
    return rates.select("c_custkey", "r.valor", "r.valor_raw")


NAME_SQL = """
names AS (SELECT c_custkey, CASE c_custkey % 9
    WHEN 0 THEN 'Dólar de N.A.' WHEN 1 THEN ' dólar de n.a. ' WHEN 2 THEN 'Dólar canadiense'
    WHEN 3 THEN 'Dólar Canadiense' WHEN 4 THEN ' Euro' WHEN 5 THEN 'Euro'
    WHEN 6 THEN 'YEN JAPONÉS' WHEN 7 THEN 'Peso Chileno' ELSE c_mktsegment END AS nombre
  FROM customer)
"""


def currency_names(spark, sf_dir):
    kind = F.col("c_custkey") % 9
    name = (
        F.when(kind == 0, "Dólar de N.A.").when(kind == 1, " dólar de n.a. ")
        .when(kind == 2, "Dólar canadiense").when(kind == 3, "Dólar Canadiense")
        .when(kind == 4, " Euro").when(kind == 5, "Euro").when(kind == 6, "YEN JAPONÉS")
        .when(kind == 7, "Peso Chileno").otherwise(F.col("c_mktsegment"))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("nombre"))


@query(
    "normalise_currency",
    f"""
    WITH {NAME_SQL}
    SELECT c_custkey, nombre,
      CASE WHEN lower({strip_sql("nombre")}) = 'dólar de n.a.' THEN 'Dólar Estadounidense'
        ELSE {strip_sql("nombre")} END AS sin_mayusculas,
      CASE WHEN nombre = 'Dólar de N.A.' THEN 'Dólar Estadounidense' ELSE nombre END AS exacto
    FROM names
    """,
)
def normalise_currency(spark, sf_dir):
    name = F.col("nombre")
    return currency_names(spark, sf_dir).select(
        "c_custkey", "nombre",
        clean.normalise_currency(name).alias("sin_mayusculas"),
        clean.normalise_currency(name, exact=True).alias("exacto"),
    )


ISO_SQL = "iso(n, c) AS (VALUES " + ", ".join(f"('{n}', '{c}')" for n, c in fixed.ISO_CODES) + ")"


@query(
    "iso_lookup_ci",
    f"""
    WITH {NAME_SQL}, {ISO_SQL}
    SELECT c_custkey, nombre, coalesce(c, '???') AS codigo FROM names
    LEFT JOIN iso ON lower(n) = lower({strip_sql("nombre")})
    """,
)
def iso_lookup_ci(spark, sf_dir):
    return clean.iso_code(currency_names(spark, sf_dir), "nombre")


@query(
    "iso_lookup_exact",
    f"""
    WITH {NAME_SQL}, {ISO_SQL}
    SELECT c_custkey, nombre, coalesce(c, '???') AS codigo FROM names LEFT JOIN iso ON n = nombre
    """,
)
def iso_lookup_exact(spark, sf_dir):
    return clean.iso_code(currency_names(spark, sf_dir), "nombre", exact=True)


BUCKET_TEXT_SQL = """
texts AS (SELECT c_custkey, CASE c_custkey % 6
    WHEN 0 THEN 'Natural - Hasta 30 días' WHEN 1 THEN 'Jurídica - 31-90 días - ' || c_mktsegment
    WHEN 2 THEN 'Natural más de 360 días' WHEN 3 THEN 'JURÍDICA HASTA 30 DÍAS'
    WHEN 4 THEN 'PERSONA MÁS DE 360 DÍAS' ELSE c_mktsegment END AS columna FROM customer)
"""


@query(
    "bucket_name",
    f"""
    WITH {BUCKET_TEXT_SQL}
    SELECT c_custkey, columna, CASE
      WHEN contains(columna, ' - ') THEN {strip_sql("substr(columna, strpos(columna, ' - ') + 3)")}
      WHEN regexp_matches(columna, '(?i)(Hasta.*|31-90.*|91-180.*|181-360.*|Más de.*)')
      THEN {strip_sql("regexp_extract(columna, '(?i)(Hasta.*|31-90.*|91-180.*|181-360.*|Más de.*)', 1)")}
      ELSE columna END AS tramo FROM texts
    """,
)
def bucket_name(spark, sf_dir):
    kind, segment = F.col("c_custkey") % 6, F.col("c_mktsegment")
    name = (
        F.when(kind == 0, "Natural - Hasta 30 días")
        .when(kind == 1, F.concat(F.lit("Jurídica - 31-90 días - "), segment))
        .when(kind == 2, "Natural más de 360 días").when(kind == 3, "JURÍDICA HASTA 30 DÍAS")
        .when(kind == 4, "PERSONA MÁS DE 360 DÍAS").otherwise(segment)
    )
    texts = table(spark, sf_dir, "customer").select("c_custkey", name.alias("columna"))
    return texts.withColumn("tramo", clean.bucket_name(F.col("columna")))


@query(
    "normalise_keys",
    r"""
    WITH k AS (SELECT o_orderkey, CASE o_orderkey % 4
        WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%-d/%-m/%Y')
        WHEN 2 THEN 'sin fecha' END AS fecha,
      CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS banco FROM orders)
    SELECT o_orderkey, CASE WHEN regexp_matches(fecha, '^\d{1,2}/\d{1,2}/\d{4}$')
        THEN try_strptime(fecha, '%d/%m/%Y')::date::VARCHAR END AS clave_fecha,
      nullif(banco, '') AS clave_banco FROM k
    """,
)
def normalise_keys(spark, sf_dir):
    kind, day = F.col("o_orderkey") % 4, F.col("o_orderdate")
    keys = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(kind == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(kind == 1, F.date_format(day, "d/M/yyyy"))
        .when(kind == 2, "sin fecha").alias("fecha"),
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")).alias("banco"),
    )
    return keys.select(
        "o_orderkey",
        clean.key_text(keys, "fecha").alias("clave_fecha"),
        clean.key_text(keys, "banco").alias("clave_banco"),
    )
