"""Calendar queries over order dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import calendar
from tidemark.operators import calendar as cal
from tidemark.plans.registry import query, table

# Easter by the same public rule, one step per CTE, for the SQL side.
EASTER_SQL = """
years AS (SELECT DISTINCT {year} AS y FROM {source}),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
e2 AS (SELECT *, (19*a + b - b//4 - (b - (b+8)//25 + 1)//3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2*(b % 4) + 2*(c//4) - h - c % 4) % 7 AS l FROM e2),
e4 AS (SELECT *, h + l - 7*((a + 11*h + 22*l)//451) + 114 AS s FROM e3),
easter AS (SELECT y, make_date(y, s // 31, s % 31 + 1) AS pascua FROM e4)
"""
HOLIDAY_SQL = """
holidays AS (
  SELECT y, make_date(y, md // 100, md % 100) AS fecha FROM easter,
    (SELECT unnest([101,501,607,629,723,728,729,806,830,1008,1101,1208,1209,1225]) AS md)
  UNION ALL SELECT y, pascua - 3 FROM easter
  UNION ALL SELECT y, pascua - 2 FROM easter)
"""
ORDER_YEARS = EASTER_SQL.format(year="year(o_orderdate)", source="orders")
SPINE_SQL = """
spine AS (SELECT unnest(generate_series(
    (SELECT min(o_orderdate)::date FROM orders),
    (SELECT max(o_orderdate)::date FROM orders), INTERVAL 1 DAY))::date AS fecha)
"""


def order_days(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("dia"))


@query("date_spine", f"WITH {SPINE_SQL} SELECT fecha FROM spine")
def date_spine(spark, sf_dir):
    return cal.spine_of(order_days(spark, sf_dir), "dia")


@query("easter_by_year", f"WITH {ORDER_YEARS} SELECT y::INTEGER AS anio, pascua FROM easter")
def easter_by_year(spark, sf_dir):
    years = order_days(spark, sf_dir).select(F.year("dia").alias("anio")).distinct()
    return years.select("anio", calendar.easter(F.col("anio")).alias("pascua"))


@query(
    "holidays_by_year",
    f"WITH {ORDER_YEARS}, {HOLIDAY_SQL} SELECT y::INTEGER AS anio, fecha FROM holidays",
)
def holidays_by_year(spark, sf_dir):
    return cal.holidays(order_days(spark, sf_dir).select(F.year("dia").alias("anio")))


@query(
    "holidays_2025_only",
    """
    SELECT (o_orderdate + INTERVAL 27 YEAR)::date AS fecha, count(*) AS pedidos,
      (o_orderdate + INTERVAL 27 YEAR)::date IN (
        '2025-01-01','2025-04-17','2025-04-18','2025-05-01','2025-06-07','2025-06-29',
        '2025-07-23','2025-07-28','2025-07-29','2025-08-06','2025-08-30','2025-10-08',
        '2025-11-01','2025-12-08','2025-12-09','2025-12-25') AS es_feriado
    FROM orders GROUP BY ALL
    """,
)
def holidays_2025_only(spark, sf_dir):
    days = order_days(spark, sf_dir).select(F.add_months("dia", 27 * 12).alias("fecha"))
    return days.groupBy("fecha").agg(F.count(F.lit(1)).alias("pedidos")).withColumn(
        "es_feriado", calendar.is_holiday_in(F.col("fecha"), 2025)
    )


@query(
    "weekend_flags",
    """
    SELECT o_orderdate::date AS fecha, isodow(o_orderdate) > 5 AS fin_de_semana,
      count(*) AS pedidos
    FROM orders GROUP BY ALL
    """,
)
def weekend_flags(spark, sf_dir):
    return (
        order_days(spark, sf_dir)
        .groupBy(F.col("dia").alias("fecha"))
        .agg(F.count(F.lit(1)).alias("pedidos"))
        .withColumn("fin_de_semana", calendar.is_weekend(F.col("fecha")))
    )


@query(
    "business_days",
    f"""
    WITH {ORDER_YEARS}, {HOLIDAY_SQL}, {SPINE_SQL}
    SELECT fecha FROM spine
    WHERE isodow(fecha) < 6 AND fecha NOT IN (SELECT fecha FROM holidays)
    """,
)
def business_days(spark, sf_dir):
    return cal.business_days(cal.spine_of(order_days(spark, sf_dir), "dia"))


@query(
    "business_days_custom_calendar",
    f"""
    WITH {ORDER_YEARS}, {HOLIDAY_SQL}, {SPINE_SQL}
    SELECT fecha FROM spine
    WHERE fecha NOT IN (SELECT fecha FROM holidays WHERE y = 1998)
    """,
)
def business_days_custom_calendar(spark, sf_dir):
    own = cal.holiday_table(spark, 1998, 1998)
    spine = cal.spine_of(order_days(spark, sf_dir), "dia")
    return cal.business_days(spine, custom_holidays=own, skip_weekends=False)


CUSTOMER_RANGE_SQL = """
ranges AS (SELECT o_custkey, min(o_orderdate)::date AS ini, max(o_orderdate)::date AS fin
           FROM orders GROUP BY 1)
"""


def customer_ranges(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min(day).alias("ini"), F.max(day).alias("fin")
    )


@query(
    "weekday_count",
    f"""
    WITH {CUSTOMER_RANGE_SQL},
    days AS (SELECT o_custkey, unnest(generate_series(ini, fin, INTERVAL 1 DAY))::date AS d
             FROM ranges)
    SELECT o_custkey, count(*) FILTER (isodow(d) < 6)::INTEGER AS dias_habiles
    FROM days GROUP BY 1
    """,
)
def weekday_count(spark, sf_dir):
    return customer_ranges(spark, sf_dir).select(
        "o_custkey", calendar.weekdays_between(F.col("ini"), F.col("fin")).alias("dias_habiles")
    )


@query(
    "range_days",
    f"WITH {CUSTOMER_RANGE_SQL} SELECT o_custkey, (fin - ini + 1)::INTEGER AS dias FROM ranges",
)
def range_days(spark, sf_dir):
    return customer_ranges(spark, sf_dir).select(
        "o_custkey", calendar.range_days(F.col("ini"), F.col("fin")).alias("dias")
    )


@query(
    "previous_quarter",
    """
    SELECT DISTINCT o_orderdate::date AS fecha,
      (date_trunc('quarter', o_orderdate) - INTERVAL 3 MONTH)::date AS inicio,
      date_trunc('quarter', o_orderdate)::date - 1 AS fin
    FROM orders
    """,
)
def previous_quarter(spark, sf_dir):
    days = order_days(spark, sf_dir).distinct()
    return days.select(F.col("dia").alias("fecha"), calendar.previous_quarter(F.col("dia")).alias("q")).select(
        "fecha", "q.inicio", "q.fin"
    )


@query(
    "parse_dmy",
    r"""
    WITH texts AS (SELECT o_orderkey, CASE o_orderkey % 5
        WHEN 0 THEN strftime(o_orderdate, '%-d/%-m/%Y')
        WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
        WHEN 2 THEN '31/02/' || year(o_orderdate)
        WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d')
        ELSE ' ' || strftime(o_orderdate, '%-d/%m/%Y') || ' ' END AS texto FROM orders)
    SELECT o_orderkey, texto, CASE WHEN regexp_matches(trim(texto), '^\d{1,2}/\d{1,2}/\d{4}$')
        THEN try_strptime(trim(texto), '%d/%m/%Y')::date END AS fecha
    FROM texts
    """,
)
def parse_dmy(spark, sf_dir):
    day, key = F.col("o_orderdate"), F.col("o_orderkey") % 5
    text = (
        F.when(key == 0, F.date_format(day, "d/M/yyyy"))
        .when(key == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(key == 2, F.concat(F.lit("31/02/"), F.year(day)))
        .when(key == 3, F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit(" "), F.date_format(day, "d/MM/yyyy"), F.lit(" ")))
    )
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", text.alias("texto"))
        .withColumn("fecha", calendar.parse_dmy(F.col("texto")))
    )


@query(
    "format_dmy",
    """
    SELECT DISTINCT o_orderdate::date AS fecha, strftime(o_orderdate, '%d/%m/%Y') AS texto,
      strftime(o_orderdate, '%d%m%Y') AS sufijo FROM orders
    """,
)
def format_dmy(spark, sf_dir):
    day = F.col("fecha")
    return (
        order_days(spark, sf_dir).select(F.col("dia").alias("fecha")).distinct()
        .select(day, calendar.format_dmy(day).alias("texto"), calendar.date_suffix(day).alias("sufijo"))
    )
