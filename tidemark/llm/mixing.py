"""Mixing sources to target weights, cut at each source's exact budget.

Every document gets a hash-random key. The key space is cut into equal ranges; within a source and
range the documents are sorted by key. Prefix sums of the sizes are taken inside the ranges and over the
totals of the ranges, so that a source with any share of all rows is summed by many tasks. A source's
budget is a number of whole epochs and a rest, which is cut where the prefix sum reaches it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.batches import WORD
from tidemark.llm.columns import apart
from tidemark.session import materialise

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Hex digits of a key that name its range: 4,096 ranges of the key space for each source, which is
#: also the bound of the rows of a source in the sum over ranges.
RANGE_DIGITS = 3
SEED = "17:"


def size_of(text: Column) -> Column:
    """Number of words of a whole text; NULL: 0. Words are counted by their first characters."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key() -> Column:
    """64 hash bits of the document id as hex, so that keys sort alike everywhere."""
    return F.substring(F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 16)


def targets(sources: DataFrame) -> DataFrame:
    """``sources(source, source_size)`` with weight and target.

    Sources come by code point, NULL last, and weigh 5, 2, 1, repeating. A source is full at three
    times its size; the level that the others reach per unit of weight is where the full ones (those with the least
    size per weight) and the level times the rest's weight make up the total: the first source, by size per
    weight, that the level of the others does not fill. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, WEIGHTS))
    weighed = sources.withColumn(
        "weight", F.element_at(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("double")
    )
    cap = MOST_EPOCHS * F.col("source_size").cast("double")
    by_fill = Window.orderBy(F.col("fill"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        weighed.withColumn("cap", cap)
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("weight_left"))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("fill"), F.col("level"))).over(everything))
    )
    return level.select(
        "source", "source_size", "weight", F.least(F.col("cap"), F.col("level") * F.col("weight")).alias("target")
    )


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row of ``docs``.

    A document with NULL text has size 0 and is taken with 0 words. NULL sources are one source.
    Repeated rows are taken each for itself. Reruns give the same rows.
    """
    slim = materialise(
        docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), random_key().alias("key")),
        "sizes",
    )
    ranged = slim.withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    per_range = ranged.groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    per_source = per_range.groupBy("source").agg(F.sum("in_range").alias("source_size"))
    aims = targets(per_source).select(F.col("source").alias("of"), "source_size", "target")
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        per_range.withColumn("ahead", F.coalesce(F.sum("in_range").over(ahead), F.lit(0)))
        .join(aims, F.col("source").eqNullSafe(F.col("of")))
        .select(F.col("source").alias("of"), F.col("range").alias("at"), "ahead", "source_size", "target")
    )
    within = (
        Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = ranged.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("at"))
    )
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    cut = F.least(F.greatest(rest - F.col("ahead") - F.col("inside"), F.lit(0)), F.col("size"))
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", (epochs * F.col("size") + cut).alias("taken")
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself, columns as in ``docs``: a row for each epoch a document is taken whole, and the
    document at the cut once more with its first words up to the budget (its text ends with the last of
    them, ``n_chars`` is renewed if there is one). Documents with no word are in no mix.

    Repeated rows are numbered within their (doc_id, source, size), each with a share of its own. Other columns
    may have any name.
    """
    names = docs.columns
    docs = apart(docs, "doc_id", "source", "text", "n_chars")
    key = F.xxhash64("doc_id", "source", "size")
    plan = mixed_sizes(docs).withColumn("own", key).groupBy("own").agg(
        F.max("taken").alias("most"), F.sort_array(F.collect_list("taken"), asc=False).alias("takes")
    )
    copies = Window.partitionBy("__key").orderBy("text")
    sized = docs.withColumn("__size", size_of(F.col("text")))
    keyed = sized.withColumn("__key", F.xxhash64("doc_id", "source", "__size")).withColumn(
        "__copy", F.row_number().over(copies)
    )
    met = keyed.join(plan.where("most > 0"), F.col("__key") == F.col("own"))
    met = met.withColumn("__taken", F.element_at("takes", F.col("__copy"))).where("__taken > 0")
    whole = F.floor(F.col("__taken") / F.col("__size")).cast("int")
    rest = (F.col("__taken") % F.col("__size")).cast("int")
    shares = F.concat(
        F.array_repeat(F.lit(-1), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>"))
    )
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"[\\x20\\x09-\\x0D]*{WORD}"), F.lit(0)), 1, F.col("__share")), "")
    taken = met.withColumn("__share", F.explode(shares))
    taken = taken.withColumn("text", F.when(F.col("__share") < 0, F.col("text")).otherwise(head))
    if "n_chars" in docs.columns:
        taken = taken.withColumn(
            "n_chars", F.when(F.col("__share") < 0, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
        )
    return taken.select(*docs.columns).toDF(*names)
