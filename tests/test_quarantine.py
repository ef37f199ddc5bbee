"""Nothing disappears uncounted: log entries and streamed rows are accepted or kept with their reason."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import network_log
from tidemark.streaming import quarantine
from tidemark.streaming.events import read_stream

SCHEMA = "k long, ts timestamp, why string"
START = dt.datetime(2024, 1, 1)


def at(hours):
    return START + dt.timedelta(hours=hours)


def test_every_log_line_is_an_event_or_is_kept(spark):
    folder = scratch_path(spark, "log")
    good = '{"capture_id":1,"seq":%d,"ts":"2024-01-01T00:00:00Z","message":"{\\"message\\":{\\"method\\":\\"Network.x\\"}}"}'
    lines = [good % 1, good % 2, "no json", '{"capture_id":1,"seq":3}', '{"capture_id":1,"seq":4,"message":"{cut"}', '{"capture_id":"x","seq":5,"message":"{}"}']
    spark.createDataFrame([(line,) for line in lines], "value string").repartition(2).write.text(folder)
    events, skipped, counted = network_log.split_log(network_log.read_log(spark, folder))
    assert counted == {"leidas": 6, "eventos": 2, "omitidas": 4}
    assert sorted(r.seq for r in events.collect()) == [1, 2] and events.columns[-2:] == ["method", "params"]
    kept = {(r.motivo, r.linea_mala) for r in skipped.collect()}
    assert ("line is no log entry", "no json") in kept and ("no message", None) in kept and len(kept) == 4
    # The plain parser gives the same events.
    assert network_log.parse_messages(network_log.read_log(spark, folder).drop("linea_mala")).count() == 2


def drops(spark, *batches):
    folder = scratch_path(spark, "in")
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return read_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def test_late_and_bad_rows_are_kept_apart(spark):
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    stream = drops(
        spark,
        [(1, at(10), None), (2, at(0), None), (3, at(9), "mala")],
        [(4, at(8), None), (5, at(20), None), (6, None, None), (7, at(1), "mala"), (8, at(1), None)],
        [(9, at(17), None), (10, at(18), None)],
    )
    quarantine.ingest_checked(stream, out, state, F.col("why"), ts="ts", late_seconds=2 * 3600).awaitTermination()
    got = {r.k: (r.lote, r.motivo) for r in quarantine.rows(spark, out, stream.schema).collect()}
    # Within the first batch nothing is late; a NULL time never is; a bad row keeps its own reason.
    assert got == {
        1: (0, "aceptada"), 2: (0, "aceptada"), 3: (0, "mala"), 4: (1, "aceptada"), 5: (1, "aceptada"), 6: (1, "aceptada"),
        7: (1, "mala"), 8: (1, "tarde"), 9: (2, "tarde"), 10: (2, "aceptada"),
    }
    read = {r.lote: (r.leidas, r.aceptadas, r.apartadas) for r in quarantine.counts(spark, out).collect()}
    assert read == {0: (3, 2, 1), 1: (5, 3, 2), 2: (2, 1, 1)}


def test_without_times(spark):
    out = scratch_path(spark, "out")
    stream = drops(spark, [(1, at(0), None)], [(2, None, "x")])
    quarantine.ingest_checked(stream, out, scratch_path(spark, "state"), F.col("why")).awaitTermination()
    assert quarantine.counts(spark, out).agg(F.sum("leidas"), F.sum("apartadas")).first()[:] == (2, 1)


def test_a_drop_is_not_one_file(spark, monkeypatch):
    """The rows of a drop stay in the tasks they are in; a drop is still one batch."""
    import glob

    from tidemark.plans import stream_queries

    folders, made = [], stream_queries.labels
    read = stream_queries.streams.read_stream
    monkeypatch.setattr(stream_queries, "labels", lambda *a: made(*a).repartition(3))
    monkeypatch.setattr(stream_queries.streams, "read_stream", lambda s, f, *a, **k: folders.append(f) or read(s, f, *a, **k))
    rows = {r.motivo: r.filas for r in stream_queries.quarantined_ingest_stream(spark, "/root/testdata/sf0.001").collect()}
    assert len(glob.glob(f"{folders[0]}/*.parquet")) == 6
    assert rows["leidas"] == sum(n for reason, n in rows.items() if reason != "leidas")
