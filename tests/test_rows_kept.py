"""Cases in which rows or dates used to be lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar
from tidemark.operators import ledger, merge, reshape, weblog
from tidemark.sources import accumulated, captures


def test_unnamed_banks_stay_apart(spark):
    tables = spark.createDataFrame(
        [(1, False, "MN", ["Hasta 30 días"], [["1.5"], ["2.5"], ["-"]], ["", "", ""])],
        "doc_id long, por_persona boolean, tipo_moneda string, columnas array<string>, filas array<array<string>>, bancos array<string>",
    )
    wide = reshape.general_wide(tables, ["doc_id"])
    assert sorted((r["Hasta 30 días"] for r in wide.collect()), key=str) == [1.5, 2.5, None]


def test_iso_dates_are_dates(spark):
    days = spark.createDataFrame([("2025-01-02",), ("2/1/2025",), ("x",), (None,)], "t string")
    got = [r[0] for r in days.select(calendar.parse_day(F.col("t"))).collect()]
    assert got == [dt.date(2025, 1, 2), dt.date(2025, 1, 2), None, None]
    old = spark.createDataFrame([("2025-01-01", "A", 1.0), ("2025-01-02", "A", 2.0)], "fecha string, banco string, v double")
    new = spark.createDataFrame([("2025-01-02", "A", 3.0)], "fecha string, banco string, v double")
    out = merge.upsert(old, new, ["fecha", "banco"]).collect()
    assert sorted((r.fecha, r.v) for r in out) == [(dt.date(2025, 1, 1), 1.0), (dt.date(2025, 1, 2), 3.0)]


def test_latest_keeps_buckets_and_unknown_arrivals(spark):
    rows = [("A", "b1", None, 1.0), ("A", "b2", 5, 2.0), ("", "b1", 1, 3.0), (None, "b1", 2, 4.0)]
    df = spark.createDataFrame(rows, "banco string, bucket string, llegada long, valor double")
    out = merge.latest_per_key(df, ["banco", "bucket"], "llegada").collect()
    assert sorted(((r.banco or "", r.bucket, r.valor) for r in out)) == [("", "b1", 4.0), ("A", "b1", 1.0), ("A", "b2", 2.0)]


def test_latest_stale_date_is_a_date(spark):
    label = "Tasas vigentes al {}"
    rows = [(dt.date(2020, 2, 5), label.format(d), False, 1) for d in ("31/01/2020", "01/02/2020")]
    df = spark.createDataFrame(rows, "requested_date date, label_text string, failed boolean, n_rows long")
    assert ledger.capture_facts(df).first().vigente_al == "01/02/2020"


def test_other_events_do_not_delay_the_idle_point(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, t, "Network.a"), (1, t + dt.timedelta(seconds=1), "Page.b"), (1, t + dt.timedelta(seconds=2.5), "Page.c")]
    df = spark.createDataFrame(rows, "capture_id long, ts timestamp, method string")
    assert weblog.network_idle(df).first().reposo == t + dt.timedelta(seconds=2)


def test_bad_bytes_do_not_stop_the_job(spark):
    df = spark.createDataFrame([(bytearray(b"ab\xffc"),)], "content binary")
    assert df.select(captures.page_text(F.col("content"))).first()[0] == "ab�c"


def test_merge_by_month_needs_the_date(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), "A")], "fecha date, banco string")
    with pytest.raises(ValueError):
        accumulated.write_accumulated(df, "unused", ["banco"])
