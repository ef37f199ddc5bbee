"""Last attempts per date, page-complete times and manifests of captures that saved nothing."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import ledger, weblog


def test_only_the_last_attempt_counts(spark):
    day, other = dt.date(2020, 2, 3), dt.date(2020, 2, 4)
    df = spark.createDataFrame(
        [
            (1, day, "Tasas al 31/01/2020", True, 0),
            (2, day, "Tasas al 03/02/2020", False, 7),
            (2, day, "Tasas al 03/02/2020", False, 2),
            (None, other, "Tasas al 04/02/2020", False, 5),
        ],
        "attempt int, requested_date date, label_text string, failed boolean, n_rows int",
    )
    got = {r.fecha: (r.fallo, r.vigente_al, r.filas) for r in ledger.capture_facts(df).collect()}
    assert got == {day: (False, None, 9), other: (False, None, 5)}
    whole = ledger.capture_facts(df.drop("attempt")).where(F.col("fecha") == day).first()
    assert (whole.fallo, whole.vigente_al, whole.filas) == (True, "31/01/2020", 9)


def test_idle_waits_for_the_page(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [
        ("late", "Network.a", 0), ("late", "Page.done", 5), ("late", "Network.b", 6),
        ("early", "Network.a", 0), ("early", "Page.done", 1), ("early", "Network.b", 9),
        ("never", "Network.a", 0),
    ]
    df = spark.createDataFrame(
        [(c, m, start + dt.timedelta(seconds=s)) for c, m, s in rows], "capture_id string, method string, ts timestamp_ntz"
    )

    def seconds(**how):
        return {
            r.capture_id: ((r.reposo - start).total_seconds(), r.por_tope)
            for r in weblog.network_idle(df, cap_seconds=60, **how).collect()
        }

    assert seconds() == {"late": (2, False), "early": (2, False), "never": (2, False)}
    # Quiet from 2 s on, but complete at 5 s only; the gap is still open then.
    done = F.col("method") == "Page.done"
    assert seconds(complete=done) == {"late": (5, False), "early": (2, False), "never": (60, True)}


def test_manifest_without_saved_files(spark):
    found = spark.createDataFrame(
        [("a", "r1", "http://h/x", 1, 10, "h/x.html"), ("b", "r2", "http://h/y", 1, None, "h/y.html")],
        "capture_id string, request_id string, url string, first_seq long, bytes long, relpath string",
    )
    missing = spark.createDataFrame([], "capture_id string, url string")
    opened = spark.createDataFrame([("a", "http://h/", "http://h/x")], "capture_id string, root_url string, final_url string")
    got = weblog.manifest(found, weblog.body_warnings(found), missing, opened)
    rows = {r.capture_id: r for r in got.collect()}
    assert (rows["a"].saved_count, rows["a"].root_url, rows["a"].final_html) == (1, "http://h/", "h/index.final.html")
    assert (rows["b"].warnings_count, rows["b"].root_url, rows["b"].offline_html) == (1, None, None)
