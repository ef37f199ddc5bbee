"""Streams with timers: equal to the batch in any order of arrival, state let go, restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import weblog
from tidemark.session import scratch_path
from tidemark.streaming import captures
from tidemark.streaming.events import read_stream

START = dt.datetime(2024, 5, 1)
SCHEMA = "capture_id long, ts timestamp, method string, url string, event_id long"


def log(seed, count=120, captures_=6):
    """Events of captures of about a minute each, one of them hot, one without a complete page."""
    rnd = random.Random(seed)
    rows = []
    for c in range(captures_):
        at = START + dt.timedelta(seconds=40 * c)
        for i in range(count * (8 if c == 0 else 1)):
            at += dt.timedelta(milliseconds=rnd.choice([1, 40, 300, 1900, 2000, 2300]) // (8 if c == 0 else 1))
            rows.append((c, at, "Network.x", f"u{rnd.randint(0, 9)}", len(rows)))
            if c and i == 20:
                rows.append((c, at + dt.timedelta(seconds=rnd.choice([0, 3])), "Page.loadEventFired", None, len(rows)))
    return rows


def files(spark, rows, folder, parts, seed):
    rows = rows[:]
    random.Random(seed).shuffle(rows)
    for i in range(parts):
        spark.createDataFrame(rows[i::parts], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def ahead(spark, folder, seconds=10**6):
    row = (None, START + dt.timedelta(seconds=seconds), "Network.x", None, None)
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def stream(spark, folder):
    return read_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def run(spark, found, out, state):
    query = captures.append_files(found, out, state)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("complete", ["none", "page"])
def test_idle_point_in_any_order(spark, complete):
    condition = None if complete == "none" else F.col("method") == "Page.loadEventFired"
    rows = log(1)
    want = weblog.network_idle(spark.createDataFrame(rows, SCHEMA), complete=condition)
    assert want.count() == 6 and 0 < want.filter("por_tope").count() < 6 or complete == "none"
    folder, out = scratch_path(spark, "log"), scratch_path(spark, "quiet")
    files(spark, rows, folder, 5, seed=3)
    ahead(spark, folder)
    found = captures.network_idle(stream(spark, folder), complete=condition, late="1 hour", forget_seconds=600)
    query = run(spark, found, out, scratch_path(spark, "state"))
    assert as_rows(spark.read.parquet(out)) == as_rows(want)
    # The watermark is past everything: no capture is remembered.
    assert query.lastProgress.stateOperators[0].numRowsTotal == 0


def test_state_is_bounded_by_open_captures(spark):
    """Captures one after the other: at no time are more than the last ones in the state."""
    folder = scratch_path(spark, "log")
    for c in range(12):
        rows = [(c, START + dt.timedelta(seconds=100 * c + i), "Network.x", f"u{i % 3}", i) for i in range(5)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    for made in (
        lambda s: captures.network_idle(s, late="1 second", forget_seconds=60),
        lambda s: captures.first_per_url(s.drop("method"), idle_seconds=60, late="1 second"),
    ):
        query = run(spark, made(stream(spark, folder)), scratch_path(spark, "o"), scratch_path(spark, "s"))
        held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
        assert len(held) >= 12 and max(held) <= 24


def test_restart_goes_on(spark):
    rows = sorted(log(2), key=lambda r: r[1])
    want = weblog.network_idle(spark.createDataFrame(rows, SCHEMA))
    folder, out, state = (scratch_path(spark, x) for x in ("log", "quiet", "state"))
    for at, part in enumerate((rows[:700], rows[700:1000], rows[1000:])):
        files(spark, part, folder, 2, seed=at)
        if at == 2:
            ahead(spark, folder)
        run(spark, captures.network_idle(stream(spark, folder), late="10 minutes"), out, state)
    assert as_rows(spark.read.parquet(out)) == as_rows(want)


def test_events_after_a_capture_is_forgotten_open_it_anew(spark):
    folder, out, state = (scratch_path(spark, x) for x in ("log", "quiet", "state"))

    def at(seconds):
        return START + dt.timedelta(seconds=seconds)

    batches = [
        [(1, at(0), "Network.x", "u", 1), (None, at(30), None, None, None)],
        # Late for the point that is already given, but within what is remembered.
        [(1, at(35), "Network.x", "u", 2), (None, at(500), None, None, None)],
        [(1, at(505), "Network.x", "u", 3), (None, at(5000), None, None, None)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        run(spark, captures.network_idle(stream(spark, folder), late="1 second", forget_seconds=60), out, state)
    assert [(r.inicio, r.reposo) for r in spark.read.parquet(out).orderBy("inicio").collect()] == [(at(0), at(2)), (at(505), at(507))]


def visits(rows, idle):
    """First event per URL of each visit, walked in plain Python."""
    out, by_capture = [], {}
    for r in sorted(rows, key=lambda r: r[1]):
        if r[0] is not None:
            by_capture.setdefault(r[0], []).append(r)
    for own in by_capture.values():
        last, seen = None, set()
        for c, ts, _, url, event in own:
            if last is not None and (ts - last).total_seconds() >= idle:
                seen = set()
            last = ts
            if url not in seen:
                seen.add(url)
                out.append((c, url, ts, min(e for _, t, _, u, e in own if t == ts and u == url)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("idle", [2, 60])
def test_first_per_url_in_any_order(spark, idle):
    rows = [(*r[:2], r[2], None if r[4] % 50 == 7 else r[3], r[4]) for r in log(4)]
    folder, out = scratch_path(spark, "log"), scratch_path(spark, "firsts")
    files(spark, rows, folder, 4, seed=5)
    ahead(spark, folder)
    found = captures.first_per_url(stream(spark, folder).drop("method"), idle_seconds=idle, late="1 hour")
    query = run(spark, found, out, scratch_path(spark, "state"))
    assert as_rows(spark.read.parquet(out).select("capture_id", "url", "ts", "event_id")) == visits(rows, idle)
    assert query.lastProgress.stateOperators[0].numRowsTotal == 0
