"""Quality rules: figures of each text, and lines that too many documents of a host share.

1. One Arrow pass reads every whole text once. It gives the figures of the basic rules and, for each
   line, a hash of its normalised form with its number of words. The result is a narrow table in the
   shared folder.
2. Documents are counted per host and line: first made distinct by (host, line, text), then counted, both
   with map-side combine, so that a line of very many documents is no hot key.
3. Lines above the limits count as taken out of every document but the first of their host, and a document
   that has too few words left is rejected. ``without_common_lines`` gives the texts without them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.batches import map_batches
from tidemark.llm.columns import apart
from tidemark.session import materialise

SYMBOLS = re.compile(r"[#*$%&|<>]")
#: Basic rules.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: A line is boilerplate if more than this many documents of its host have it and more than this share of them.
LINE_DOCUMENTS = 20
LINE_SHARE_PERCENT = 2
#: A document is depleted if a smaller share of its words is left.
LEAST_LEFT_PERCENT = 20

SCHEMA = (
    "doc_id long, host string, digest binary, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<struct<line:binary,words:long>>"
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window which the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : shift + n - 2] |= twice
    return int(covered.sum())


def figures(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines) of one whole text."""
    raw = (text or "").encode()
    words = raw.split()
    lines, seen, again = [], set(), 0
    for line in raw.split(b"\n"):
        own = line.lower().split()
        if own:
            again += line in seen
            seen.add(line)
            lines.append({"line": xxhash.xxh3_128_digest(b" ".join(own)), "words": len(own)})
    chars = len(text or "") - sum(raw.count(c) for c in b" \t\n\v\f\r")
    return len(words), chars, len(SYMBOLS.findall(text or "")), again, repeated_words(words), lines


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """The narrow table of step 1; NULL texts have no words and no lines."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(2).to_pylist()
        rows = list(zip(*map(figures, texts)))
        digest = [xxhash.xxh3_128_digest(t or "") for t in texts]
        kind = pa.list_(pa.struct([("line", pa.binary()), ("words", pa.int64())]))
        counts = [pa.array(x, pa.int64()) for x in rows[:5]]
        names = ["doc_id", "host", "digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"]
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(digest), *counts, pa.array(rows[5], kind)], names
        )

    return map_batches(docs.select("doc_id", F.col(host).alias("host"), "text"), run, SCHEMA)


def base_failed() -> F.Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def common_lines(table: DataFrame) -> DataFrame:
    """(host, line, first): lines above both limits, with the least ``doc_id`` that has them.

    Texts that are equal count as one document, so that a copied document is not taken for boilerplate.
    A NULL host is a host of its own.
    """
    lines = table.select("host", "digest", "doc_id", F.explode("lines").alias("l"))
    each = lines.groupBy("host", F.col("l.line").alias("line"), "digest").agg(F.min("doc_id").alias("first"))
    counted = each.groupBy("host", "line").agg(F.count("*").alias("n"), F.min("first").alias("first"))
    hosts = table.select("host", "digest").distinct().groupBy("host").agg(F.count("*").alias("all"))
    hosts = hosts.withColumnRenamed("host", "of")
    return (
        counted.where(F.col("n") > LINE_DOCUMENTS)
        .join(hosts, F.col("host").eqNullSafe(F.col("of")))
        .where(100 * F.col("n") > LINE_SHARE_PERCENT * F.col("all"))
        .select("host", "line", "first")
    )


def judged(docs: DataFrame, host: str = "source") -> DataFrame:
    """Figures and verdict of every row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, words_left, kept. NULL and empty texts fail the basic rules; repeated rows stay repeated.
    """
    table = materialise(measured(docs, host), "figures").withColumn("key", F.xxhash64("doc_id", "host", "digest"))
    lines = table.select("key", "doc_id", "host", F.explode("lines").alias("l"))
    lines = lines.select("key", "doc_id", "host", F.col("l.line").alias("line"), F.col("l.words").alias("words"))
    lines = lines.groupBy("key", "doc_id", "host", "line").agg(F.sum("words").alias("words"))
    common = common_lines(table).select(F.col("host").alias("of"), F.col("line").alias("its"), "first")
    found = lines.join(common, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("its")))
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("first"))).groupBy("key").agg(F.sum("words").alias("gone"))
    # Equal rows share a key, and the words of all of them were added up.
    copies = F.col("copies")
    times = table.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1").withColumnRenamed("key", "own")
    gone = gone.join(times, F.col("key") == F.col("own"), "left").select(
        F.col("key").alias("own"), (F.col("gone") / F.coalesce(copies, F.lit(1))).cast("long").alias("gone")
    )
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    return table.drop("lines", "digest").join(gone, F.col("key") == F.col("own"), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), left.alias("words_left"),
        (~base_failed() & (100 * left >= LEAST_LEFT_PERCENT * F.col("n_words"))).alias("kept"),
    )


def passing(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, as they are. Rows that share a ``doc_id`` go only if all of them fail.
    Other columns may have any name.
    """
    given = apart(docs, "doc_id", "text", host)
    good = judged(given, host).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return given.join(good, F.col("doc_id").eqNullSafe(F.col("__kept")), "left_semi").toDF(*docs.columns)


def without_common_lines(docs: DataFrame, host: str = "source") -> DataFrame:
    """``docs`` without the lines above the limits, in all documents but the first of their host; other lines, blank
    ones too, stay as they are. ``n_chars`` is renewed if there is one. NULL texts stay NULL. Other columns may have any name.
    """
    given_names = docs.columns
    docs = apart(docs, "doc_id", "text", "n_chars", host)
    table = materialise(measured(docs, host), "figures")
    common = common_lines(table).select(F.col("host").alias("of"), F.col("line").alias("its"), "first")
    lines = table.select("doc_id", "host", F.explode("lines.line").alias("line")).distinct()
    found = lines.join(common, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("its")))
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("first"))).groupBy("doc_id", "host").agg(
        F.collect_set("line").alias("__gone")
    ).select(F.col("doc_id").alias("__doc"), F.col("host").alias("__host"), "__gone")
    met = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__doc")) & F.col(host).eqNullSafe(F.col("__host")), "left")
    names = docs.columns

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        columns = dict(zip([*names, "__gone"], part.columns))
        texts, gone_of = columns["text"].to_pylist(), columns.pop("__gone").to_pylist()
        for i, gone in enumerate(gone_of):
            if gone and texts[i] is not None:
                all_gone, lines = set(gone), texts[i].split("\n")
                own = [line.encode().lower().split() for line in lines]
                texts[i] = "\n".join(
                    line for line, w in zip(lines, own) if not w or xxhash.xxh3_128_digest(b" ".join(w)) not in all_gone
                )
        columns["text"] = pa.array(texts, pa.string())
        if "n_chars" in columns:
            chars = zip(columns["n_chars"].to_pylist(), texts, gone_of)
            columns["n_chars"] = pa.array([len(t) if g and t is not None else n for n, t, g in chars], columns["n_chars"].type)
        return pa.RecordBatch.from_arrays(list(columns.values()), names)

    return map_batches(met.select(*names, "__gone"), run, docs.schema).toDF(*given_names)
