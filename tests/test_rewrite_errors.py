"""A document that cannot be rewritten is reported, and the others are rewritten."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import references, weblog


def failing(text, *rest):
    if "bad" in text:
        raise ValueError("no end of list")
    if "mute" in text:
        raise KeyError
    return text.upper()


def test_checked_keeps_the_text_and_says_why():
    assert references.checked(failing, "ok", {}) == {"text": "OK", "error": None}
    assert references.checked(failing, "bad", {}) == {"text": "bad", "error": "no end of list"}
    assert references.checked(failing, "mute", {}) == {"text": "mute", "error": "KeyError"}
    assert references.checked(failing, None, {}) == {"text": None, "error": None}


def fails_on_bad():
    """What the rewriting step gives where a sheet is bad."""
    return F.struct(F.col("css").alias("text"), F.when(F.col("css").contains("bad"), "no end of list").alias("error"))


def test_warnings_of_all_three_stages(spark):
    sheets = spark.createDataFrame([(1, "u1", "a{b:url(/x)}"), (1, "u2", "bad"), (2, "u3", None)], "capture_id long, url string, css string")
    local = spark.createDataFrame([(1, "https://h/x", "/l/x")], "capture_id long, url string, local string")
    based = sheets.withColumn("base", F.concat(F.lit("https://h/"), "url"))
    plain = references.rewrite_css(based.withColumnRenamed("url", "sheet"), local, "sheet", "base", scope=["capture_id"], errors="error")
    plain = plain.withColumnRenamed("sheet", "url")
    got = {r.url: (r.css, r.error) for r in plain.collect()}
    assert got == {"u1": ('a{b:url("/l/x")}', None), "u2": ("bad", None), "u3": (None, None)}
    assert weblog.rewrite_warnings(plain).count() == 0
    broken = references._put(sheets.filter("css IS NOT NULL").withColumn("mapa", F.lit(1)), fails_on_bad(), "css", "error")
    body = spark.createDataFrame([(1, "u9", "r9", None)], "capture_id long, url string, request_id string, bytes int")
    missing = spark.createDataFrame([(1, "https://h/y")], "capture_id long, url string")
    all_of = weblog.body_warnings(body).unionByName(weblog.rewrite_warnings(broken)).unionByName(weblog.missing_css_warnings(missing))
    assert {(r.stage, r.message, r.url) for r in all_of.collect()} == {
        ("get_response_body", "No body captured", "u9"), ("rewrite_css", "no end of list", "u2"),
        ("rewrite_css_missing", "No local mapping found", "https://h/y"),
    }
    with pytest.raises(Exception, match="no end of list"):
        references._put(sheets.filter("css IS NOT NULL").withColumn("mapa", F.lit(1)), fails_on_bad(), "css", None).collect()


def test_few_documents_are_python_objects_at_once():
    """A batch of any length is rewritten some documents at a time, in order, with a missing map as an empty one."""
    import pyarrow as pa

    n = references.DOCUMENTS_AT_ONCE * 2 + 5
    texts = pa.array([f"t{i}" for i in range(n - 1)] + [None])
    maps = pa.array([[("a", "b")], None] * n, pa.map_(pa.string(), pa.string())).slice(0, n)
    parts = list(references._checked_slices(lambda t, known: f"{t}{known.get('a', '')}", (texts, maps)))
    assert max(map(len, parts)) == references.DOCUMENTS_AT_ONCE
    made = [r["text"] for p in parts for r in p.to_pylist()]
    assert made[:2] == ["t0b", "t1"] and made[-1] is None and len(made) == n
