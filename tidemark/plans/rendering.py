"""Captured pages stood in for by HTML rendered from table rows.

Each row renders its own page, so pages are made without grouping and their number grows
with the table. What extraction must give back is then known from the row itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.plans.registry import table
from tidemark.session import even_out


def text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def tr(*cells: str | Column, tag: str = "td", attrs: str = "") -> Column:
    inner = [x for c in cells for x in (f"<{tag}>", c, f"</{tag}>")]
    return text(f"<tr{attrs}>", *inner, "</tr>\r\n")


def amount(col: Column) -> Column:
    """Amount with thousands separators and two decimals, as pages print it."""
    return F.format_number(col, 2)


def orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus"
    )


def customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")


def flat_responses(spark, sf_dir) -> DataFrame:
    """One response per order: heading, the order's quote, and rows to be skipped."""
    key, day, price = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_totalprice")
    name = F.when(key % 3 == 0, "Dólar de N.A.").otherwise(F.col("o_orderpriority"))
    html = text(
        "\r\n\r\n<TABLE BORDER=1>\r\n",
        tr("FECHA", "MONEDA", "COMPRA", "VENTA"),
        tr(F.date_format(day, "d/M/yyyy"), name, amount(price), "S/M"),
        tr(F.date_format(day, "dd/MM/yyyy"), text(" ", name, " "), "&nbsp;",
           text("<b>", amount(price + 1), "</b>")),
        tr("31/02/2020", name, "1", "2"),
        tr("total", F.col("o_orderstatus"), "1"),
        "</TABLE><!-- ", F.repeat(F.lit("relleno "), 30), "-->",
    )
    return even_out(orders(spark, sf_dir), "o_orderkey").select(
        key.alias("doc_id"), day.cast("date").alias("dia"), html.alias("html")
    )


def grid_pages(spark, sf_dir) -> DataFrame:
    """One average-rate page per order: a grid with quotes, and rows to be left out."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    buy = F.when(key % 5 == 0, "&nbsp;").otherwise(amount(price))
    html = text(
        "<html><body><table class='rgMasterTable'><tr class='rgRow'><td>fuera</td></tr></table>",
        f"<div id='{fixed.GRID_ID}'><div class='x'><table class='rgMasterTable rgClipCells'><thead>",
        "<tr><th>MONEDA</th><th> </th><th>COMPRA (S/)</th><th>VENTA (S/)</th></tr></thead><tbody>",
        tr("Dólar de N.A.", buy, amount(price + 2), attrs=" class='rgRow'"),
        tr(F.col("o_orderpriority"), amount(price * 2), "-", attrs=" class='rgAltRow otra'"),
        tr(" ", "&nbsp;", "", attrs=" class='rgRow'"),
        tr("sólo dos", "1", attrs=" class='rgAltRow'"),
        tr("pie", "1", "2", attrs=" class='rgFooter'"),
        "</tbody></table></div></div></body></html>",
    )
    return even_out(orders(spark, sf_dir), "o_orderkey").select(
        key.alias("doc_id"), F.col("o_orderdate").cast("date").alias("dia"), html.alias("html")
    )


def labels_zone(*labels: str | Column) -> Column:
    rows = [x for name in labels for x in ("<tr><td class='rpgRowHeaderField rpgX'>", name, "</td></tr>")]
    return text("<table>", *rows, "</table>")


def pivot_pages(spark, sf_dir) -> DataFrame:
    """One deposit-rate page per customer, in four layouts by customer key.

    0: heading over all columns. 1: an entity heading too many. 2: a cell too many.
    3: heading without entity word too many, and one label too few. All pages also have a
    person-type table and a foreign table without heading.
    """
    key, bal = F.col("c_custkey"), F.col("c_acctbal")
    kind = key % 4
    bank_a = text("Banco ", F.col("c_nationkey"))
    bank_b = text("Caja ", F.col("c_mktsegment"))
    lead = (
        F.when(kind == 1, "<th rowspan='2'>Empresa</th>")
        .when(kind == 3, "<th rowspan='2'>Otros</th>")
        .otherwise("")
    )
    extra = F.when(kind == 2, "<td>sobra</td>").otherwise("")
    second_label = F.when(kind == 3, "").otherwise(
        text("<tr><td class='rpgRowHeaderField'>", bank_b, "</td></tr>")
    )

    def row(*cells: str | Column) -> Column:
        body = [x for c in cells for x in ("<td>", c, "</td>")]
        return text("<tr>", extra, *body, "</tr>")

    general = text(
        f"<table id='{fixed.NATIONAL_IDS[0]}'><tr><td><table><tr><td>chica</td></tr></table></td>",
        "<td><table><tr><td class='rpgRowHeaderField'>", bank_a, "</td></tr>", second_label, "</table></td>",
        "<td><table><thead><tr>", lead,
        "<th rowspan='2'>Depósitos de Ahorro</th><th colspan='3'>Depósitos a Plazo</th>",
        "<th rowspan='2'>Depósitos CTS</th></tr><tr><th>Hasta 30 días</th><th>31-90 días</th>",
        "<th>181-360 días</th></tr></thead><tbody>",
        row(amount(bal), text(key.cast("string"), ".5<br>nota"), "-", "S/D", "N/A"),
        row("&nbsp;", "", "", "", ""),
        row(text(" ", amount(bal + 1), " "), "1", "2", "3 000", "4"),
        "</tbody></table></td></tr></table>",
    )
    person = text(
        f"<table id='{fixed.NATIONAL_IDS[2]}'><tr><td>", labels_zone(bank_a),
        "</td><td><table><thead><tr><th>Natural - Hasta 30 días</th><th>Natural - 31-90 días</th>",
        "<th>Jurídica - Hasta 30 días</th><th>Jurídica - Más de 360 días</th></tr></thead>",
        "<tbody><tr><td>", amount(bal), "</td><td>--</td><td>2.5</td><td>", key.cast("string"),
        "</td></tr></tbody></table></td></tr></table>",
    )
    foreign = text(
        f"<table id='{fixed.FOREIGN_IDS[0]}'><tr><td>", bank_b, "</td></tr>",
        "<tr><td>1.25</td><td>", amount(bal), "</td><td>x</td></tr></table>",
    )
    return even_out(customers(spark, sf_dir), "c_custkey").select(
        key.alias("doc_id"),
        text("<html><body>", general, person, foreign, "</body></html>").alias("html"),
    )
