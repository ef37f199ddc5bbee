"""Versioned merges: any order of batches, batches run again, ties and NULLs give one table."""

import itertools
from datetime import date

from tidemark.operators import merge
from tidemark.session import scratch_path
from tidemark.sources import accumulated

KEYS = ["fecha", "banco"]
SCHEMA = "fecha date, banco string, bucket string, valor double, llegada long"
JAN, FEB = date(2025, 1, 31), date(2025, 2, 1)

BATCHES = [
    [(JAN, "A", "x", 1.0, 5), (JAN, "A", "y", 2.0, 5), (FEB, "B", "x", 1.0, 1), (None, None, "x", 7.0, 1)],
    # Older for A, a later version of B without one of its buckets, the same NULL key as a blank one.
    [(JAN, "A", "x", 9.0, 4), (FEB, "B", "z", 3.0, 2), (None, "", "x", 8.0, 2)],
    # A tie with the first batch for A, with other values; an unknown arrival.
    [(JAN, "A", "x", 4.0, 5), (JAN, "A", "y", 4.0, 5), (FEB, "B", "x", 6.0, None), (FEB, "C", "x", 6.0, None)],
]


def frames(spark):
    return [spark.createDataFrame(b, SCHEMA) for b in BATCHES]


def rows(df):
    return sorted(((r.fecha, r.banco or None, r.bucket, r.valor, r.llegada) for r in df.collect()), key=repr)


def test_any_order_gives_one_table(spark):
    tables = []
    for order in itertools.permutations(frames(spark)):
        now = None
        for batch in order:
            now = merge.upsert_versions(now, batch, KEYS, "llegada")
        tables.append(rows(now))
    assert all(t == tables[0] for t in tables)
    kept = {(r[0], r[1], r[2]): (r[3], r[4]) for r in tables[0]}
    assert kept[FEB, "B", "z"] == (3.0, 2) and (FEB, "B", "x") not in kept and kept[FEB, "C", "x"] == (6.0, None)
    assert kept[None, None, "x"] == (8.0, 2)
    # One of the two versions of A, whole.
    assert {kept[JAN, "A", "x"][0], kept[JAN, "A", "y"][0]} in ({1.0, 2.0}, {4.0})


def test_stored_table_skips_batches_it_has(spark):
    tables = []
    for order in ((0, 1, 2), (2, 1, 0), (1, 2, 0)):
        path, given = scratch_path(spark, "acc"), frames(spark)
        for at, which in enumerate(order):
            assert accumulated.write_accumulated(given[which], path, KEYS, "llegada", "s", at) == "written"
            assert accumulated.write_accumulated(given[0], path, KEYS, "llegada", "s", at) == "skipped"
        # Another stream counts its batches for itself; an empty batch is counted too.
        assert accumulated.write_accumulated(given[0].limit(0), path, KEYS, "llegada", "t", 0) == "no_rows"
        assert accumulated.merged_batches(spark, path) == {"s": 2, "t": 0}
        tables.append(rows(accumulated.read_accumulated(spark, path)))
    assert tables[0] == tables[1] == tables[2]


def test_new_columns_and_repeats(spark):
    first = spark.createDataFrame([(JAN, "A", 1.0, 1)] * 2, "fecha date, banco string, valor double, llegada long")
    extra = spark.createDataFrame([(JAN, "B", 2.0, 1, "n")], "fecha date, banco string, valor double, llegada long, nota string")
    made = merge.upsert_versions(first, extra, KEYS, "llegada")
    assert sorted((r.banco, r.nota) for r in made.collect()) == [("A", None), ("A", None), ("B", "n")]
    again = merge.upsert_versions(made, first, KEYS, "llegada")
    assert again.count() == 3
    assert merge.upsert_versions(None, first.limit(0), KEYS, "llegada").count() == 0
