"""Streams give the batch result, however the input is cut into batches."""

import os
from pathlib import Path

from pyspark.sql import functions as F

from tidemark.functions import gates
from tidemark.operators import weblog
from tidemark.plans.registry import table
from tidemark.session import scratch_path
from tidemark.sources import accumulated
from tidemark.streaming import events as streams

SF_DIR = "/root/testdata/sf0.001"


def cut(spark, df, parts, *order):
    """Write a table as several files in arrival order, one per micro-batch."""
    folder = scratch_path(spark, "arrivals")
    df.repartitionByRange(parts, *order).write.parquet(folder)
    # A file stream takes files by modification time: make that the order of arrival.
    for age, file in enumerate(sorted(Path(folder).glob("part-*"))):
        os.utime(file, (1_700_000_000 + age, 1_700_000_000 + age))
    return streams.read_stream(spark, folder, df.schema, files_per_batch=1)


def test_sessions(spark):
    events = table(spark, SF_DIR, "events").select("user_id", "ts")
    stream = cut(spark, events, 3, "ts")
    got = spark.read.parquet(
        streams.run_to_files(streams.idle_sessions(stream, "user_id", gap="2 hours", late="1 hour"), "s")
    )
    batch = weblog.idle_sessions(events, "user_id", gap_seconds=7200).selectExpr(
        "user_id", "cast(inicio AS timestamp) AS inicio", "cast(fin AS timestamp) AS fin", "eventos"
    )
    assert got.exceptAll(batch).count() == 0
    # Only sessions the watermark has not passed are still open.
    last = events.selectExpr("cast(max(ts) AS timestamp) - INTERVAL 1 HOUR AS w").first().w
    assert batch.exceptAll(got).filter(batch.fin <= last).count() == 0


def test_first_per_url(spark):
    """Also when the first event arrives last, long after its key was seen."""
    events = table(spark, SF_DIR, "events").selectExpr("user_id", "event_type AS url", "ts", "event_id")
    keys = ["user_id", "url"]
    for order in ("ts", "-event_id"):
        arriving = cut(spark, events.withColumn("_o", F.expr("double(ts::timestamp)" if order == "ts" else order)), 3, "_o")
        path = streams.run_updates(streams.first_per_url(arriving.drop("_o"), keys), "u")
        got = {(r.user_id, r.url): (r.ts, r.event_id) for r in streams.settled_first(spark.read.parquet(path), keys).collect()}
        want = {}
        for r in events.collect():
            want[r.user_id, r.url] = min(want.get((r.user_id, r.url), (r.ts, r.event_id)), (r.ts, r.event_id))
        assert got == want


def test_upsert_over_several_batches(spark):
    orders = table(spark, SF_DIR, "orders").selectExpr(
        "cast(date_trunc('week', o_orderdate) AS date) AS fecha", "o_orderstatus AS banco",
        "o_totalprice AS valor", "o_orderkey AS llegada",
    )
    path, keys = scratch_path(spark, "acc"), ["fecha", "banco"]
    streams.upsert_stream(
        cut(spark, orders, 3, "llegada"), path, keys, "llegada", scratch_path(spark, "acc-state")
    ).awaitTermination()
    got = accumulated.read_accumulated(spark, path).select("fecha", "banco", "valor")
    want = orders.groupBy("fecha", "banco").agg({"llegada": "max"}).withColumnRenamed("max(llegada)", "llegada")
    want = orders.join(want, ["fecha", "banco", "llegada"]).select("fecha", "banco", "valor")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_gate_on_stream(spark):
    pages = table(spark, SF_DIR, "orders").selectExpr(
        "cast(o_orderdate AS date) AS requested_date",
        "concat('al ', date_format(date_add(o_orderdate, cast(o_orderkey % 2 AS int)), 'dd/MM/yyyy')) AS label_text",
    )
    kept = spark.read.parquet(streams.run_to_files(streams.in_force_captures(cut(spark, pages, 2, "requested_date")), "g"))
    want = pages.filter(gates.in_force(pages.label_text, pages.requested_date))
    assert kept.count() == want.count() > 0
