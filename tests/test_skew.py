"""Hot keys are found whatever tasks they are in, and joins that split them give the same rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import references, skew


def test_sketch_keeps_what_is_frequent():
    rng = np.random.default_rng(1)
    values = np.concatenate([np.full(3000, 7), np.full(1200, 8), rng.integers(100, 100_000, 20_000)])
    rng.shuffle(values)
    sketch = skew.Sketch(40)
    for part in np.array_split(values, 17):
        sketch.add(part)
        assert len(sketch.values) <= 40
    held = dict(zip(sketch.values.tolist(), sketch.counts.tolist()))
    for value, true in ((7, 3000), (8, 1200)):
        assert true - len(values) / 40 <= held[value] <= true


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_gives_the_same_rows(spark, how):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["hot", "warm", None] + [f"u{j}" for j in range(300)]) if i % 3 else "hot", "x") for i in range(6000)]
    left = spark.createDataFrame(rows, "id long, url string, h string").repartition(7)
    right = spark.createDataFrame([("hot", "/l/hot")] + [(f"u{j}", f"/l/{j}") for j in range(0, 300, 2)], "url string, local string")
    hot = spark.createDataFrame([("hot",)], "url string").select(F.xxhash64("url").alias("h")).first().h
    assert skew.hot_hashes(left, ["url"], share=0.05) == [hot]
    split = skew.join_unique(left, right, ["url"], how, share=0.05)
    plain = left.join(right, ["url"], how)
    assert split.columns == plain.columns and split.exceptAll(plain).count() == 0 == plain.exceptAll(split).count()


def test_split_join_of_empty_sides(spark):
    left = spark.createDataFrame([(1, "a")] * 5, "id long, url string")
    right = spark.createDataFrame([("a", "x")], "url string, local string")
    assert skew.join_unique(left.limit(0), right, ["url"]).count() == 0
    assert skew.join_unique(left, right.limit(0), ["url"]).count() == 0
    assert skew.join_unique(left, right, ["url"]).count() == 5
    with pytest.raises(ValueError):
        skew.join_unique(left, right, ["url"], "full")


def test_one_url_in_every_page(spark):
    """The URL of every page is not in the shuffled part, and pages are rewritten as without the split."""
    pages = spark.createDataFrame(
        [(i, "https://h/p", f"<head></head><a href='/all'></a><a href='/u{i}'></a>") for i in range(400)], "page_id long, url string, html string"
    )
    local = spark.createDataFrame([("https://h/all", "/l/all")] + [(f"https://h/u{i}", f"/l/{i}") for i in range(0, 400, 2)], "url string, local string")
    plain, split = (references.rewrite(pages, local, split_hot=s) for s in (False, True))
    assert split.exceptAll(plain).count() == 0 == plain.exceptAll(split).count()
    found = references.resolve(references.page_refs(pages, ["page_id", "url"]).withColumnRenamed("url", "base"), "base")
    gone, same = (references.missing_refs(found, local, ["page_id"], split_hot=s) for s in (True, False))
    assert gone.collect() == same.collect() and gone.count() == 200
    assert "BroadcastHashJoin" in gone._jdf.queryExecution().executedPlan().toString()
