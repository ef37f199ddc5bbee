"""Gate queries: which captures are used, and why others are not."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import fixed, gates
from tidemark.operators import series
from tidemark.plans import rendering
from tidemark.plans.registry import query, table
from tidemark.sources import captures


def responses(spark, sf_dir):
    """Response bytes per order: complete, short, challenge page, and without heading."""
    key = F.col("doc_id")
    html = F.col("html")
    body = (
        F.when(key % 7 == 1, F.substring(html, 1, 399))
        .when(key % 7 == 2, F.concat(F.lit("\r\n\t <HTML><body>"), html))
        .when(key % 7 == 3, F.regexp_replace(html, "FECHA", "DIA"))
        .when(key % 7 == 4, F.substring(html, 1, 400))
        .otherwise(html)
    )
    return rendering.flat_responses(spark, sf_dir).select(
        "doc_id", F.encode(body, "ISO-8859-1").alias("content")
    )


@query(
    "payload_gate",
    "SELECT o_orderkey AS doc_id, o_orderkey % 7 NOT IN (1, 2, 3) AS pasa FROM orders",
)
def payload_gate(spark, sf_dir):
    content = F.col("content")
    return responses(spark, sf_dir).select(
        "doc_id", gates.payload_ok(content, gates.latin1(content)).alias("pasa")
    )


@query(
    "block_gate",
    """SELECT page_id, (page_id % 4 = 0 AND contains(html, '<nav>'))
       OR contains(html, '<iframe id="main-iframe"') AS bloqueada FROM pages""",
)
def block_gate(spark, sf_dir):
    """A block frame is put into the navigation of some pages, then looked for."""
    html = F.when(
        F.col("page_id") % 4 == 0,
        F.replace("html", F.lit("<nav>"), F.lit('<nav><iframe id="main-iframe" src="/x">')),
    ).otherwise(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", gates.is_blocked(html).alias("bloqueada"))


@query(
    "table_hits",
    """SELECT c_custkey AS doc_id, 2 AS nacionales, 1 AS extranjeras, true AS con_datos FROM customer""",
)
def table_hits(spark, sf_dir):
    html = F.col("html")
    national, foreign = (gates.table_hits(html, i) for i in (fixed.NATIONAL_IDS, fixed.FOREIGN_IDS))
    return rendering.pivot_pages(spark, sf_dir).select(
        "doc_id", national.alias("nacionales"), foreign.alias("extranjeras"),
        (gates.table_hits(html, fixed.NATIONAL_IDS + fixed.FOREIGN_IDS) > 0).alias("con_datos"),
    )


LABEL_SQL = r"""
labels AS (SELECT o_orderkey, o_orderdate::date AS pedida, CASE o_orderkey % 6
    WHEN 0 THEN 'Moneda Extranjera del 01/01/1990 al ' || strftime(o_orderdate, '%d/%m/%Y')
    WHEN 1 THEN 'Moneda Nacional al ' || strftime(o_orderdate, '%d/%m/%Y')
    WHEN 2 THEN 'Moneda Extranjera al ' || strftime(o_orderdate - INTERVAL 1 DAY, '%d/%m/%Y')
    WHEN 3 THEN 'Moneda Extranjera sin fecha'
    WHEN 4 THEN strftime(o_orderdate, '%d/%m/%Y') || ' y 123/01/20001' END AS etiqueta FROM orders),
dated AS (SELECT *, regexp_extract_all(etiqueta, '\b(\d{2}/\d{2}/\d{4})\b', 1)[-1] AS eff FROM labels)
"""


def labels(spark, sf_dir, orders=None):
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 6
    shown, before = (F.date_format(d, "dd/MM/yyyy") for d in (day, F.date_sub(day, 1)))
    text = (
        F.when(kind == 0, F.concat(F.lit("Moneda Extranjera del 01/01/1990 al "), shown))
        .when(kind == 1, F.concat(F.lit("Moneda Nacional al "), shown))
        .when(kind == 2, F.concat(F.lit("Moneda Extranjera al "), before))
        .when(kind == 3, "Moneda Extranjera sin fecha")
        .when(kind == 4, F.concat(shown, F.lit(" y 123/01/20001")))
    )
    source = table(spark, sf_dir, "orders") if orders is None else orders
    return source.select("o_orderkey", day.cast("date").alias("pedida"), text.alias("etiqueta"))


@query("effective_date", f"WITH {LABEL_SQL} SELECT o_orderkey, eff AS vigente_al FROM dated")
def effective_date(spark, sf_dir):
    return labels(spark, sf_dir).select(
        "o_orderkey", gates.effective_date(F.col("etiqueta")).alias("vigente_al")
    )


@query(
    "in_force",
    f"WITH {LABEL_SQL} SELECT o_orderkey, pedida FROM dated "
    "WHERE eff IS NULL OR eff = strftime(pedida, '%d/%m/%Y')",
)
def in_force(spark, sf_dir):
    rows = labels(spark, sf_dir)
    return rows.filter(gates.in_force(F.col("etiqueta"), F.col("pedida"))).select("o_orderkey", "pedida")


@query(
    "foreign_confirmed",
    f"WITH {LABEL_SQL} SELECT o_orderkey, coalesce(contains(etiqueta, 'Extranjera') "
    "AND eff = strftime(pedida, '%d/%m/%Y'), false) AS confirmada FROM dated",
)
def foreign_confirmed(spark, sf_dir):
    confirmed = gates.foreign_confirmed(F.col("etiqueta"), F.col("pedida"))
    return labels(spark, sf_dir).select("o_orderkey", confirmed.alias("confirmada"))


@query(
    "http_ok",
    """
    SELECT o_orderpriority AS moneda, count(*) AS respuestas,
      count(*) FILTER (CASE o_orderstatus WHEN 'F' THEN 200 WHEN 'O' THEN 404 END < 400) AS correctas
    FROM orders GROUP BY 1
    """,
)
def http_ok(spark, sf_dir):
    """Failed and unanswered requests give nothing; other currencies go on."""
    status = F.when(F.col("o_orderstatus") == "F", 200).when(F.col("o_orderstatus") == "O", 404)
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("moneda"))
        .agg(
            F.count(F.lit(1)).alias("respuestas"),
            F.count(F.when(gates.http_ok(status), 1)).alias("correctas"),
        )
    )


@query(
    "currency_selection",
    "SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS codigo FROM orders "
    "WHERE substr(o_orderpriority, 1, 1) IN ('1', '3')",
)
def currency_selection(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("codigo")
    )
    return series.select_currencies(rows, ["1", "3"])


@query(
    "nonblank_rows",
    "SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0 OR c_mktsegment = 'BUILDING'",
)
def nonblank_rows(spark, sf_dir):
    blank = F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).otherwise("  \t")
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "x").otherwise("")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.array(blank, segment).alias("celdas"))
    return rows.filter(gates.any_text(F.col("celdas"))).select("c_custkey")


@query(
    "gated_quotes",
    """
    WITH q AS (SELECT o_orderkey AS doc_id, o_orderdate::date AS fecha,
      CASE WHEN o_orderkey % 3 = 0 THEN 'Dólar Estadounidense' ELSE o_orderpriority END AS moneda,
      CASE WHEN o_orderkey % 3 = 0 THEN 'USD' ELSE '???' END AS codigo, o_totalprice AS precio
      FROM orders WHERE o_orderkey % 7 NOT IN (1, 2, 3))
    SELECT doc_id, 0 AS fila, fecha, moneda, codigo, precio AS compra, NULL::DOUBLE AS venta FROM q
    UNION ALL
    SELECT doc_id, 1, fecha, moneda, codigo, NULL, round(precio + 1, 2) FROM q
    """,
)
def gated_quotes(spark, sf_dir):
    """Gate, decode, extract and code: captured bytes to quotes in one job."""
    return captures.weighted_quotes(responses(spark, sf_dir), ["doc_id"])
