"""Streams with timers: messages to the state per capture and batch, and batches per drop, do not grow with the events."""

import random
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.plans import stream_queries
from tidemark.session import scratch_path
from tidemark.streaming import captures, timers


class State:
    """A value or list of one capture, which counts what it is asked."""

    def __init__(self, asked):
        self.asked, self.value, self.items = asked, None, []

    def __getattr__(self, name):
        self.asked[name] += 1
        return {
            "get": lambda: iter(self.items) if self.items else self.value, "exists": lambda: self.value is not None,
            "update": lambda v: setattr(self, "value", v), "appendList": self.items.extend,
            "put": lambda v: setattr(self, "items", list(v)), "clear": lambda: self.__init__(self.asked),
        }[name]


class Handle:
    def __init__(self):
        self.asked, self.timers = Counter(), []

    def getValueState(self, *_):
        return State(self.asked)

    getListState = getValueState

    def __getattr__(self, name):
        self.asked[name] += 1
        return {"listTimers": lambda: list(self.timers), "registerTimer": self.timers.append, "deleteTimer": self.timers.remove}[name]


def run(processor, batches):
    """Rows given, and messages, of one capture over batches; at last the watermark is past everything."""
    handle, out = Handle(), []
    processor.init(handle)
    for rows in batches:
        list(processor.handleInputRows((1,), iter(rows), None))
    asked = handle.asked.total()
    while handle.timers:
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda: handle.timers[0])
        out += processor.handleExpiredTimer((1,), now, None)
        handle.timers.pop(0)
    return [tuple(r) for r in out], asked


def event(url, at):
    return SimpleNamespace(url=url, desde=at, hasta=at, fila=f"{at:09}", completa=False)


def test_urls_of_a_capture_cost_no_messages():
    batches = [[event(f"u{i}", 1_000_000 * b + i) for i in range(500)] for b in range(4)]
    out, asked = run(timers.FirstPerUrl(10_000_000), batches)
    assert len(out) == 500 and asked <= 4 * 4


def test_idle_point_asks_for_no_timers():
    batches = [[event("u", 1_000_000 * b + i) for i in range(50)] for b in range(8)]
    out, asked = run(timers.IdlePoint(2_000_000, 10**9, 10**7, False), batches)
    assert len(out) == 1 and out[0][2] == 7_000_049 + 2_000_000 and asked <= 8 * 2 + 2


@pytest.mark.parametrize("held", [1, 3, 1024])
def test_many_urls_go_to_the_list(monkeypatch, held):
    monkeypatch.setattr(timers, "HELD", held)
    rnd, idle = random.Random(held), 5000
    events = [event(f"u{rnd.randint(0, 40)}" if rnd.random() < 0.9 else None, rnd.randint(0, 400) * 1000 + i) for i in range(600)]
    want, last, seen = [], None, set()
    for e in sorted(events, key=lambda e: e.desde):
        if last is not None and e.desde - last >= idle:
            seen = set()
        last = e.desde
        if e.url not in seen:
            seen.add(e.url)
            want.append((1, e.url, e.desde, e.fila))
    out, _ = run(timers.FirstPerUrl(idle), [events[i::5] for i in range(5)])
    assert sorted(out, key=repr) == sorted(want, key=repr)


def test_batches_do_not_grow_with_the_files_written(spark):
    rows = spark.range(4000, numPartitions=12).select(
        (F.col("id") % 5).alias("user_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 600).cast("timestamp_ntz").alias("ts"),
        F.lit("u").alias("url"), F.col("id").alias("event_id"),
    )
    arriving = stream_queries.in_drops(spark, rows, scratch_path(spark, "files"))
    found = captures.first_per_url(arriving, "user_id", idle_seconds=86400, late="9 days")
    out = scratch_path(spark, "out")
    query = captures.append_files(found, out, scratch_path(spark, "state"))
    query.awaitTermination()
    assert sum(p.numInputRows > 0 for p in query.recentProgress) <= 5
    assert spark.read.parquet(out).count() == 5
