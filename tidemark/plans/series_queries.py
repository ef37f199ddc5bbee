"""Quote-series queries: seeds, densify, fills."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.operators import asof, series
from tidemark.plans.registry import query, table
from tidemark.session import scratch_path
from tidemark.sources import accumulated

START, END = date(1995, 3, 1), date(2001, 7, 31)
LATE_START, LATE_END = date(2001, 1, 1), date(2001, 3, 31)

QUOTES_SQL = """
quotes AS (
  SELECT o_orderdate::date AS fecha, substr(o_orderpriority, 1, 1) AS codigo,
    o_orderpriority AS moneda,
    max(o_totalprice) FILTER (o_orderstatus = 'F') AS compra,
    min(o_totalprice) FILTER (o_orderstatus = 'O') AS venta, min(o_orderkey) AS ord
  FROM orders GROUP BY ALL)
"""
LINE_QUOTES_SQL = """
quotes AS (
  SELECT l_shipdate::date AS fecha, l_returnflag AS codigo,
    l_returnflag || l_linestatus || '-' || l_linenumber AS moneda,
    max(l_extendedprice) FILTER (l_discount >= 0.05) AS compra,
    min(l_extendedprice) FILTER (l_tax >= 0.05) AS venta, min(l_orderkey) AS ord
  FROM lineitem GROUP BY ALL)
"""
CUSTOMER_QUOTES_SQL = """
quotes AS (
  SELECT o_orderdate::date AS fecha, 'C' AS codigo, o_custkey::VARCHAR AS moneda,
    max(o_totalprice) FILTER (o_orderstatus <> 'P') AS compra,
    min(o_totalprice) FILTER (o_orderstatus <> 'F') AS venta, min(o_orderkey) AS ord
  FROM orders GROUP BY ALL)
"""


def order_quotes(spark, sf_dir):
    """Quotes stand-in: one series per order priority."""
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_orderdate").cast("date").alias("fecha"),
            F.substring("o_orderpriority", 1, 1).alias("codigo"),
            F.col("o_orderpriority").alias("moneda"),
        )
        .agg(
            F.max(F.when(status == "F", price)).alias("compra"),
            F.min(F.when(status == "O", price)).alias("venta"),
            F.min("o_orderkey").alias("ord"),
        )
    )


def line_quotes(spark, sf_dir):
    """Quotes stand-in: 42 series over ship dates."""
    price = F.col("l_extendedprice")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_shipdate").cast("date").alias("fecha"),
            F.col("l_returnflag").alias("codigo"),
            F.concat("l_returnflag", "l_linestatus", F.lit("-"), "l_linenumber").alias("moneda"),
        )
        .agg(
            F.max(F.when(F.col("l_discount") >= 0.05, price)).alias("compra"),
            F.min(F.when(F.col("l_tax") >= 0.05, price)).alias("venta"),
            F.min("l_orderkey").alias("ord"),
        )
    )


def customer_quotes(spark, sf_dir):
    """Quotes stand-in with many sparse series: one per customer."""
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_orderdate").cast("date").alias("fecha"),
            F.lit("C").alias("codigo"),
            F.col("o_custkey").cast("string").alias("moneda"),
        )
        .agg(
            F.max(F.when(status != "P", price)).alias("compra"),
            F.min(F.when(status != "F", price)).alias("venta"),
            F.min("o_orderkey").alias("ord"),
        )
    )


def needs_sql(start: date, end: date) -> str:
    return f"""
    firsts AS (
      SELECT moneda, arg_min_null(compra, fecha) AS primera FROM quotes
      WHERE fecha BETWEEN DATE '{start}' AND DATE '{end}' GROUP BY 1)
    """


def seeds_sql(start: date, days: int, weekdays_only: bool) -> str:
    only = "AND isodow(fecha) < 6" if weekdays_only else ""
    return f"""
    back AS (SELECT * FROM quotes
      WHERE fecha BETWEEN DATE '{start}' - {days} AND DATE '{start}' - 1 {only}),
    hits AS (SELECT moneda, max(fecha) AS dia FROM back WHERE compra IS NOT NULL GROUP BY 1),
    seeds AS (
      SELECT b.moneda, arg_max(compra, fecha) AS compra,
        arg_max(venta, fecha) FILTER (dia IS NULL OR fecha >= dia) AS venta
      FROM back b LEFT JOIN hits h ON b.moneda = h.moneda
      GROUP BY 1 HAVING count(compra) + count(venta) > 0)
    """


def fill_sql(start: date, end: date, method: str, with_seeds: bool) -> str:
    """Reference-style fill: spine x currency, left join, then ignore-null windows."""
    seed_rows = (
        f"UNION ALL SELECT DATE '{start}' - 1, moneda, s.compra, s.venta FROM seeds s "
        "JOIN firsts f USING (moneda) WHERE f.primera IS NULL AND s.compra IS NOT NULL"
        if with_seeds
        else ""
    )
    value = {
        "none": "{m}",
        "forward": "last_value({m} IGNORE NULLS) OVER past",
        "both": "coalesce(last_value({m} IGNORE NULLS) OVER past, "
        "first_value({m} IGNORE NULLS) OVER ahead)",
    }[method]
    return f"""
    inrange AS (SELECT * FROM quotes WHERE fecha BETWEEN DATE '{start}' AND DATE '{end}'),
    present AS (SELECT moneda, min(codigo) AS codigo, min(ord) AS ord FROM inrange GROUP BY 1),
    known AS (SELECT fecha, moneda, compra, venta FROM inrange {seed_rows}),
    days AS (SELECT unnest(generate_series(DATE '{start}' - 1, DATE '{end}', INTERVAL 1 DAY))::date AS fecha),
    grid AS (
      SELECT d.fecha, p.codigo, p.moneda, k.compra, k.venta, p.ord
      FROM days d CROSS JOIN present p
      LEFT JOIN known k ON k.fecha = d.fecha AND k.moneda = p.moneda),
    filled AS (
      SELECT fecha, codigo, moneda, {value.format(m="compra")} AS compra,
        {value.format(m="venta")} AS venta, ord
      FROM grid
      WINDOW past AS (PARTITION BY moneda ORDER BY fecha ROWS UNBOUNDED PRECEDING),
        ahead AS (PARTITION BY moneda ORDER BY fecha
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT * FROM filled WHERE fecha >= DATE '{start}'
    """


@query(
    "needs_seed_all",
    f"""
    WITH {CUSTOMER_QUOTES_SQL}, {needs_sql(LATE_START, LATE_END)}
    SELECT c_custkey::VARCHAR AS moneda FROM customer
    LEFT JOIN firsts ON moneda = c_custkey::VARCHAR WHERE primera IS NULL
    """,
)
def needs_seed_all(spark, sf_dir):
    chosen = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("moneda"))
    return series.needs_seed(customer_quotes(spark, sf_dir), LATE_START, LATE_END, chosen)


@query(
    "needs_seed_present",
    f"""
    WITH {CUSTOMER_QUOTES_SQL}, {needs_sql(LATE_START, LATE_END)}
    SELECT moneda FROM firsts WHERE primera IS NULL
    """,
)
def needs_seed_present(spark, sf_dir):
    return series.needs_seed(customer_quotes(spark, sf_dir), LATE_START, LATE_END)


@query(
    "seed_range_46",
    f"WITH {CUSTOMER_QUOTES_SQL}, {seeds_sql(LATE_START, 46, False)} SELECT * FROM seeds",
)
def seed_range_46(spark, sf_dir):
    return series.find_seeds(customer_quotes(spark, sf_dir), LATE_START)


@query(
    "seed_weekdays_45",
    f"WITH {CUSTOMER_QUOTES_SQL}, {seeds_sql(LATE_START, 45, True)} SELECT * FROM seeds",
)
def seed_weekdays_45(spark, sf_dir):
    return series.find_seeds(
        customer_quotes(spark, sf_dir), LATE_START, fixed.WEEKDAY_LOOKBACK_DAYS, skip_weekends=True
    )


@query("densify", f"WITH {LINE_QUOTES_SQL}, {fill_sql(START, END, 'none', False)}")
def densify(spark, sf_dir):
    return series.densify(line_quotes(spark, sf_dir), START, END)


@query("ffill_calendar", f"WITH {LINE_QUOTES_SQL}, {fill_sql(START, END, 'forward', False)}")
def ffill_calendar(spark, sf_dir):
    return series.fill(line_quotes(spark, sf_dir), START, END, method="forward")


@query("ffill_bfill_calendar", f"WITH {LINE_QUOTES_SQL}, {fill_sql(START, END, 'both', False)}")
def ffill_bfill_calendar(spark, sf_dir):
    return series.fill(line_quotes(spark, sf_dir), START, END)


@query(
    "fill_with_seeds",
    f"WITH {QUOTES_SQL}, {needs_sql(START, END)}, {seeds_sql(START, 46, False)}, "
    f"{fill_sql(START, END, 'both', True)}",
)
def fill_with_seeds(spark, sf_dir):
    return series.fill_with_seeds(order_quotes(spark, sf_dir), START, END)


@query(
    "export_roundtrip",
    "SELECT *, year(fecha)::INTEGER AS anio FROM ("
    f"WITH {QUOTES_SQL}, {needs_sql(START, END)}, {seeds_sql(START, 46, False)}, "
    f"{fill_sql(START, END, 'both', True)})",
)
def export_roundtrip(spark, sf_dir):
    """The filled series exported by year under its range name, and read back."""
    filled = series.fill_with_seeds(order_quotes(spark, sf_dir), START, END)
    folder = scratch_path(spark, "export")
    return spark.read.parquet(accumulated.export_series(filled, folder, "weighted", START, END))


REPEATED_SQL = """
WITH raw AS (SELECT o_orderdate::date AS fecha, o_orderpriority AS moneda, o_orderkey AS ord,
    CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS compra,
    CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS venta FROM orders),
back AS (SELECT * FROM raw WHERE fecha BETWEEN DATE '%s' - 46 AND DATE '%s' - 1),
best AS (SELECT moneda, max(fecha) FILTER (compra IS NOT NULL) AS cd, max(fecha) FILTER (venta IS NOT NULL) AS vd
  FROM back GROUP BY 1)
SELECT b.moneda, max_by(compra, ord) FILTER (compra IS NOT NULL AND fecha = cd) AS compra,
  CASE WHEN any_value(cd) IS NULL OR any_value(vd) >= any_value(cd)
    THEN max_by(venta, ord) FILTER (venta IS NOT NULL AND fecha = vd) END AS venta
FROM back b JOIN best USING (moneda) GROUP BY 1 HAVING count(compra) + count(venta) > 0
"""


@query("seed_repeated_days", REPEATED_SQL % (LATE_START, LATE_START))
def seed_repeated_days(spark, sf_dir):
    """Look-back days with many rows each: the last known value of the day in input order."""
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("fecha"), F.col("o_orderpriority").alias("moneda"),
        F.when(status == "F", price).alias("compra"), F.when(status != "F", price).alias("venta"),
        F.col("o_orderkey").alias("ord"),
    )
    return series.find_seeds(raw, LATE_START)


@query(
    "fill_customer_series",
    f"WITH {CUSTOMER_QUOTES_SQL}, {needs_sql(LATE_START, LATE_END)}, "
    f"{seeds_sql(LATE_START, 45, True)}, {fill_sql(LATE_START, LATE_END, 'both', True)}",
)
def fill_customer_series(spark, sf_dir):
    return series.fill_with_seeds(
        customer_quotes(spark, sf_dir), LATE_START, LATE_END,
        fixed.WEEKDAY_LOOKBACK_DAYS, skip_weekends=True,
    )


@query(
    "fill_switched_off",
    f"WITH {LINE_QUOTES_SQL} SELECT fecha, codigo, moneda, compra, venta, ord FROM quotes "
    f"WHERE fecha BETWEEN DATE '{START}' AND DATE '{END}'",
)
def fill_switched_off(spark, sf_dir):
    return series.fill(line_quotes(spark, sf_dir), START, END, enabled=False)


@query(
    "first_seen_order",
    f"WITH {LINE_QUOTES_SQL} SELECT moneda, min(ord) AS ord FROM quotes GROUP BY 1",
)
def first_seen_order(spark, sf_dir):
    return series.first_seen_order(line_quotes(spark, sf_dir))


@query(
    "asof_quotes",
    """
    WITH v AS (SELECT o_orderpriority AS moneda, o_orderdate AS ts, o_orderkey AS n,
        CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS compra,
        CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS venta FROM orders),
    c AS (SELECT moneda, ts, arg_max(compra, n) AS compra FROM v WHERE compra IS NOT NULL GROUP BY 1, 2),
    s AS (SELECT moneda, ts, arg_max(venta, n) AS venta FROM v WHERE venta IS NOT NULL GROUP BY 1, 2),
    p AS (SELECT o_orderkey AS id, o_orderpriority AS moneda, o_orderdate - INTERVAL 12 HOUR AS cuando FROM orders)
    SELECT p.id, p.moneda, p.cuando, c.compra, c.ts AS compra_desde, s.venta, s.ts AS venta_desde FROM p
    ASOF LEFT JOIN c ON p.moneda = c.moneda AND p.cuando >= c.ts ASOF LEFT JOIN s ON p.moneda = s.moneda AND p.cuando >= s.ts
    """,
)
def asof_quotes(spark, sf_dir):
    """For any number of moments per currency the last buy and the last sell price known then."""
    orders, price, status = table(spark, sf_dir, "orders"), F.col("o_totalprice"), F.col("o_orderstatus")
    values = orders.select(
        F.col("o_orderpriority").alias("moneda"), F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("n"),
        F.when(status == "F", price).alias("compra"), F.when(status == "O", price).alias("venta"),
    )
    probes = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("moneda"),
        (F.col("o_orderdate") - F.expr("INTERVAL 12 HOURS")).alias("cuando"),
    )
    return asof.asof_join(probes, values, ["moneda"], "cuando", "ts", ["compra", "venta"], tie=["n"])
