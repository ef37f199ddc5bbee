"""Upsert, append, status-ledger and summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import calendar as cal
from tidemark.operators import ledger, merge
from tidemark.plans.registry import query, table
from tidemark.session import scratch_path
from tidemark.sources import accumulated

CUT = "1999-06-01"
OVERLAP = "1999-01-01"

# Existing: general rates before CUT. Batch: from OVERLAP on, so five months are replaced.
RATES_SQL = """
rates AS (SELECT l_shipdate::date AS fecha,
    CASE WHEN l_linestatus = 'F' THEN 'Moneda Nacional' ELSE 'Moneda Extranjera' END AS tipo_moneda,
    CASE l_linenumber WHEN 1 THEN {null_bank} WHEN 2 THEN {blank_bank}
      ELSE 'Banco ' || l_linenumber END AS banco,
    CASE WHEN l_returnflag = 'R' THEN 'Natural' ELSE 'Jurídica' END AS tipo_persona,
    max(l_discount) AS tasa_max, min(l_tax) AS tasa_min
  FROM lineitem GROUP BY ALL)
"""


def rates(spark, sf_dir, null_bank, blank_bank):
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_shipdate").cast("date").alias("fecha"),
            F.when(F.col("l_linestatus") == "F", "Moneda Nacional")
            .otherwise("Moneda Extranjera").alias("tipo_moneda"),
            F.when(F.col("l_linenumber") == 1, F.lit(null_bank))
            .when(F.col("l_linenumber") == 2, F.lit(blank_bank))
            .otherwise(F.concat(F.lit("Banco "), "l_linenumber")).alias("banco"),
            F.when(F.col("l_returnflag") == "R", "Natural").otherwise("Jurídica").alias("tipo_persona"),
        )
        .agg(F.max("l_discount").alias("tasa_max"), F.min("l_tax").alias("tasa_min"))
    )


def general(df):
    return df.groupBy("fecha", "tipo_moneda", "banco").agg(
        F.max("tasa_max").alias("tasa_max"), F.min("tasa_min").alias("tasa_min")
    )


GENERAL_SQL = """
g AS (SELECT fecha, tipo_moneda, banco, max(tasa_max) AS tasa_max, min(tasa_min) AS tasa_min
      FROM rates GROUP BY ALL)
"""


def upsert_sql(source: str, keys: list[str], batch_value: str = "tasa_max + 1") -> str:
    same = " AND ".join(
        f"nullif(e.{k}::VARCHAR, '') IS NOT DISTINCT FROM nullif(b.{k}::VARCHAR, '')" for k in keys
    )
    return f"""
    e AS (SELECT * FROM {source} WHERE fecha < DATE '{CUT}'),
    b AS (SELECT * REPLACE ({batch_value} AS tasa_max) FROM {source} WHERE fecha >= DATE '{OVERLAP}')
    SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM b WHERE {same})
    UNION ALL BY NAME SELECT * FROM b
    """


def split(df):
    existing = df.filter(F.col("fecha") < CUT)
    batch = df.filter(F.col("fecha") >= OVERLAP).withColumn("tasa_max", F.col("tasa_max") + 1)
    return existing, batch


@query(
    "upsert_general",
    f"WITH {RATES_SQL.format(null_bank=repr('Banco 1'), blank_bank=repr('Banco 2'))}, {GENERAL_SQL}, "
    + upsert_sql("g", merge.GENERAL_KEYS),
)
def upsert_general(spark, sf_dir):
    existing, batch = split(general(rates(spark, sf_dir, "Banco 1", "Banco 2")))
    return merge.upsert(existing, batch, merge.GENERAL_KEYS)


@query(
    "upsert_person",
    f"WITH {RATES_SQL.format(null_bank=repr('Banco 1'), blank_bank=repr('Banco 2'))}, "
    + upsert_sql("rates", merge.PERSON_KEYS),
)
def upsert_person(spark, sf_dir):
    existing, batch = split(rates(spark, sf_dir, "Banco 1", "Banco 2"))
    return merge.upsert(existing, batch, merge.PERSON_KEYS)


@query(
    "upsert_null_keys",
    f"WITH {RATES_SQL.format(null_bank='NULL', blank_bank=repr(''))}, {GENERAL_SQL}, "
    + upsert_sql("g", merge.GENERAL_KEYS),
)
def upsert_null_keys(spark, sf_dir):
    existing, batch = split(general(rates(spark, sf_dir, None, "")))
    return merge.upsert(existing, batch, merge.GENERAL_KEYS)


@query(
    "append_missing_columns",
    f"""
    WITH {RATES_SQL.format(null_bank=repr('Banco 1'), blank_bank=repr('Banco 2'))}, {GENERAL_SQL}
    SELECT fecha, tipo_moneda, banco, tasa_max, tasa_min, NULL::VARCHAR AS tipo_persona
    FROM g WHERE fecha < DATE '{CUT}'
    UNION ALL
    SELECT fecha, tipo_moneda, banco, tasa_max, NULL, tipo_persona
    FROM rates WHERE fecha >= DATE '{OVERLAP}'
    """,
)
def append_missing_columns(spark, sf_dir):
    """The existing table lacks one key column, so the batch is appended."""
    rows = rates(spark, sf_dir, "Banco 1", "Banco 2")
    existing = general(rows).filter(F.col("fecha") < CUT)
    batch = rows.filter(F.col("fecha") >= OVERLAP).drop("tasa_min")
    return merge.upsert(existing, batch, merge.PERSON_KEYS)


def captures(spark, sf_dir, *more):
    """One capture per order: its label says which date the data is in force for."""
    day, key = F.col("o_orderdate").cast("date"), F.col("o_custkey")
    shown = F.when(key % 50 == 0, F.date_sub(day, 1)).otherwise(day)
    label = F.when(
        key % 50 != 1, F.concat(F.lit("Tasas al "), F.date_format(shown, "dd/MM/yyyy"))
    )
    return table(spark, sf_dir, "orders").select(
        day.alias("requested_date"), label.alias("label_text"),
        (F.col("o_orderkey") % 211 == 0).alias("failed"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("n_rows"),
        *more,
    )


STATUS_SQL = """
caps AS (SELECT o_orderdate::date AS fecha, o_orderkey % 211 = 0 AS failed,
    CASE WHEN o_custkey % 50 = 0 THEN strftime(o_orderdate - INTERVAL 1 DAY, '%d/%m/%Y') END AS old,
    CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS n FROM orders),
facts AS (SELECT fecha, bool_or(failed) AS fallo, strftime(max(strptime(old, '%d/%m/%Y')), '%d/%m/%Y') AS vigente_al, sum(n)::BIGINT AS filas
  FROM caps GROUP BY 1),
statuses AS (SELECT fecha, CASE
    WHEN isodow(fecha) > 5 THEN 'fin de semana'
    WHEN fecha IN (SELECT fecha FROM holidays) THEN 'feriado'
    WHEN fallo THEN 'error' WHEN vigente_al IS NOT NULL THEN 'no vigente'
    WHEN coalesce(filas, 0) = 0 THEN 'sin datos' ELSE 'ok' END AS estado, vigente_al, filas
  FROM spine LEFT JOIN facts USING (fecha))
"""


def _status_sql() -> str:
    from tidemark.plans.calendar_queries import HOLIDAY_SQL, ORDER_YEARS, SPINE_SQL

    return f"WITH {ORDER_YEARS}, {HOLIDAY_SQL}, {SPINE_SQL}, {STATUS_SQL}"


def order_statuses(spark, sf_dir, *more):
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("dia"))
    return ledger.date_status(
        cal.spine_of(days, "dia"), ledger.capture_facts(captures(spark, sf_dir, *more))
    )


@query(
    "date_status",
    _status_sql()
    + """SELECT fecha, estado, CASE WHEN estado = 'no vigente' THEN vigente_al END AS vigente_al,
      CASE WHEN estado = 'ok' THEN filas END AS filas FROM statuses""",
)
def date_status(spark, sf_dir):
    return order_statuses(spark, sf_dir)


@query(
    "date_status_last_attempt",
    _status_sql()
    .replace("caps AS (SELECT", "caps AS (SELECT o_orderkey % 3 AS attempt,")
    .replace("FROM caps GROUP BY 1", "FROM caps JOIN (SELECT o_orderdate::date AS fecha, max(o_orderkey % 3) AS attempt "
             "FROM orders GROUP BY 1) USING (fecha, attempt) GROUP BY 1")
    + """SELECT fecha, estado, CASE WHEN estado = 'no vigente' THEN vigente_al END AS vigente_al,
      CASE WHEN estado = 'ok' THEN filas END AS filas FROM statuses""",
)
def date_status_last_attempt(spark, sf_dir):
    return order_statuses(spark, sf_dir, (F.col("o_orderkey") % 3).alias("attempt"))


@query(
    "date_status_counts",
    _status_sql() + "SELECT estado, count(*) AS dias FROM statuses GROUP BY 1",
)
def date_status_counts(spark, sf_dir):
    return ledger.status_counts(order_statuses(spark, sf_dir))


@query(
    "run_summary",
    f"""
    WITH {RATES_SQL.format(null_bank=repr('Banco 1'), blank_bank=repr('Banco 2'))}, {GENERAL_SQL}
    , n AS (SELECT 'General' AS salida, fecha, 1 AS n FROM g UNION ALL SELECT 'Persona', fecha, 1 FROM rates
      UNION ALL SELECT salida, o_orderdate::date, 0 FROM orders, (VALUES ('General'), ('Persona')) s(salida))
    SELECT salida, fecha, sum(n)::BIGINT AS filas, CASE WHEN sum(n) > 0 THEN 'written' ELSE 'no_rows' END AS accion
    FROM n GROUP BY 1, 2
    """,
)
def run_summary(spark, sf_dir):
    rows = rates(spark, sf_dir, "Banco 1", "Banco 2")
    both = general(rows).select(F.lit("General").alias("salida"), "fecha").unionByName(
        rows.select(F.lit("Persona").alias("salida"), "fecha")
    )
    outputs = F.explode(F.array(F.lit("General"), F.lit("Persona"))).alias("salida")
    asked = table(spark, sf_dir, "orders").select(outputs, F.col("o_orderdate").cast("date").alias("fecha"))
    return ledger.run_summary(both, requested=asked)


@query(
    "ordered_rates",
    f"""
    WITH {RATES_SQL.format(null_bank='NULL', blank_bank=repr(''))}
    SELECT fecha, tipo_moneda, tipo_persona, banco, tasa_max FROM rates
    ORDER BY fecha, tipo_moneda, tipo_persona, banco NULLS LAST
    """,
)
def ordered_rates(spark, sf_dir):
    rows = rates(spark, sf_dir, None, "")
    return merge.ordered(rows, merge.PERSON_KEYS).select(
        "fecha", "tipo_moneda", "tipo_persona", "banco", "tasa_max"
    )


@query(
    "json_lines_roundtrip",
    f"""
    WITH {RATES_SQL.format(null_bank='NULL', blank_bank=repr(''))}
    SELECT *, banco IS NULL AS con_nulo FROM rates
    """,
)
def json_lines_roundtrip(spark, sf_dir):
    """Rates written as JSON lines and read back; ``con_nulo`` from the line, which has the empty field too."""
    rows = rates(spark, sf_dir, None, "")
    path = scratch_path(spark, "json")
    accumulated.write_json_lines(rows, path)
    line = F.from_json("value", rows.schema).alias("fila")
    return spark.read.text(path).select(line, F.col("value").contains('"banco":null').alias("con_nulo")).select(
        "fila.*", "con_nulo"
    )
