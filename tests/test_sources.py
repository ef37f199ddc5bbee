"""Capture files to quotes, and small operators without a query of their own."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions import fixed, gates
from tidemark.operators import reshape, series
from tidemark.session import scratch_path
from tidemark.sources import captures

ROW = "<tr><td>{}</td><td>{}</td><td>{}</td><td>{}</td></tr>"


def response(*rows):
    body = "".join(ROW.format(*r) for r in rows)
    html = f"\r\n\r\n<TABLE BORDER=1>{ROW.format('FECHA', 'MONEDA', 'COMPRA', 'VENTA')}{body}</TABLE>"
    return (html + " " * 400).encode("latin-1")


def test_files_to_weighted_quotes(spark):
    folder = Path(scratch_path(spark, "captures"))
    (folder / "x").mkdir(parents=True)
    (folder / "x" / "fuente_02012025.html").write_bytes(
        response(("2/1/2025", "Dólar de N.A.", "3,754.5", "S/M"), ("30/02/2025", "Euro", "1", "1"), ("3/1/2025", "EURO", "\xa0", "4"))
    )
    (folder / "fuente_03012025.html").write_bytes(b"<html>" + response())
    (folder / "otra.html").write_bytes(b"corta")
    found = captures.read_captures(spark, str(folder))
    assert {r.requested_date for r in found.select("requested_date").collect()} == {
        date(2025, 1, 2), date(2025, 1, 3), None,
    }
    quotes = captures.weighted_quotes(found, ["requested_date"]).orderBy("fila").collect()
    assert [(q.fecha, q.moneda, q.codigo, q.compra, q.venta) for q in quotes] == [
        (date(2025, 1, 2), "Dólar Estadounidense", "USD", 3754.5, None),
        (date(2025, 1, 3), "EURO", "EUR", None, 4.0),
    ]


def test_failed_response_gives_nothing(spark):
    df = spark.createDataFrame(
        [(1, 200, response(("1/1/2025", "Euro", "1", "2"))), (2, 500, response(("1/1/2025", "Euro", "1", "2"))),
         (3, None, response(("1/1/2025", "Euro", "1", "2")))],
        "doc_id int, status int, content binary",
    )
    assert [q.doc_id for q in captures.weighted_quotes(df, ["doc_id"]).collect()] == [1]


def grid_page(rows):
    body = "".join(f"<tr class='rgRow'><td>{a}</td><td>{b}</td><td>{c}</td></tr>" for a, b, c in rows)
    heads = "".join(f"<th>{h}</th>" for h in fixed.GRID_COLUMNS)
    return f"<div id='{fixed.GRID_ID}'><table class='rgMasterTable'><thead><tr>{heads}</tr></thead>{body}</table></div>"


def test_average_quotes_and_stale_pages(spark):
    day = date(2025, 1, 3)
    df = spark.createDataFrame(
        [(1, day, "al 03/01/2025", grid_page([("Dólar de N.A.", "3.7", "3.8"), ("Dólar canadiense", "2", "-")])),
         (2, day, "al 02/01/2025", grid_page([("Euro", "4", "4.1")])),
         (3, day, "al 03/01/2025", '<iframe id="main-iframe"></iframe>' + grid_page([("Euro", "9", "9")]))],
        "doc_id int, requested_date date, label_text string, html string",
    )
    every = captures.average_quotes(df, ["doc_id"]).collect()
    assert sorted((q.doc_id, q.moneda, q.codigo, q.compra, q.venta) for q in every if q.venta) == [
        (1, "Dólar Estadounidense", "USD", 3.7, 3.8), (2, "Euro", "EUR", 4.0, 4.1),
    ]
    # Names are compared as written here, so a lower-case one has no code.
    assert [q.codigo for q in every if q.moneda == "Dólar canadiense"] == ["???"]
    checked = captures.average_quotes(df.select("doc_id", "requested_date", "label_text", "html"), ["doc_id", "label_text"], check_in_force=True)
    assert {q.doc_id for q in checked.collect()} == {1}


def test_empty_choice_is_an_error(spark):
    with pytest.raises(ValueError):
        gates.selected(F.col("codigo"), [])
    df = spark.createDataFrame([("66",), ("34",)], "codigo string")
    assert series.select_currencies(df, ["66"]).count() == 1


def test_label_first(spark):
    df = spark.createDataFrame([(1, "x")], "`a b` int, Banco string")
    assert reshape.label_first(df).columns == ["Banco", "a b"]
    assert reshape.label_first(df.drop("Banco")).columns == ["Banco"]


@pytest.mark.parametrize(
    "text, passes", [("x" * 395 + "FECHA", True), ("x" * 394 + "FECHA", False), (" \r\n<HtMl>FECHA" + "x" * 400, False), ("x" * 500, False)]
)
def test_payload_gate(spark, text, passes):
    df = spark.createDataFrame([(text.encode("latin-1"),)], "c binary")
    assert df.select(gates.payload_ok(F.col("c"), gates.latin1(F.col("c")))).first()[0] is passes
