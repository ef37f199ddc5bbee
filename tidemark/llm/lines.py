"""Line deduplication over a corpus: equal lines, and lines one word apart, by deletion neighbourhoods.

Expressions only.

1. Every line becomes a narrow row of hashes: of the whole line, and of its first and its last words. Of equal
   lines the earliest is found with a map-side aggregate.
2. Two lines one word apart have their first or their last words in common, up to half of a line. A distinct line that
   shares neither with another one is settled; only the rest is fetched from the texts.
3. These emit the hash of the line and of its variants with one word deleted, with the place of the deletion, on the side
   that is not known to be shared. Lines that differ in a word share the variant without it at the same place; a
   line that has a word more shares a variant with the other line itself. Each is held against the earliest line
   of its group; a group is never paired.
4. A line and the earliest one it met are verified by their edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.columns import apart
from tidemark.session import materialise

#: Lines of fewer words are only removed if they are equal to an earlier one.
LEAST_WORDS = 8
NO_ID = -(1 << 63)
SPACES = " \t\r\f\v"


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def word_count(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def half(n: Column) -> Column:
    """The greatest power of two up to half of n."""
    return F.pow(F.lit(2), F.floor(F.log2(n / 2))).cast("int")


def side_keys(line: Column, n: Column) -> Column:
    """(last, key) of the first and the last words of a line, as many as a line of this or one word less shares."""

    def both(k: Column) -> Column:
        def key(last: bool, words: Column) -> Column:
            return F.struct(F.lit(last).alias("last"), F.xxhash64(F.lit(last), k, words).alias("key"))

        return F.array(
            key(False, F.call_function("substring_index", line, F.lit(" "), k)),
            key(True, F.call_function("substring_index", line, F.lit(" "), -k)),
        )

    here, less = half(n), half(n - 1)
    return F.when(here == less, both(here)).otherwise(F.concat(both(here), both(less)))


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc, no, h, g, keys) of every line; h and g are hashes of the trimmed line, NULL if it is blank."""
    own = F.coalesce("doc_id", F.lit(NO_ID)).alias("doc")
    lines = docs.select(own, F.posexplode(F.split("text", "\n", -1)).alias("no", "line"))
    plain = lines.select("doc", "no", trimmed(F.col("line")).alias("line"))
    counted = plain.withColumn("n", word_count(F.col("line")))
    return counted.select(
        "doc", "no",
        F.when(F.col("line") != "", F.xxhash64("line")).alias("h"),
        F.when(F.col("line") != "", F.xxhash64(F.lit("again"), "line")).alias("g"),
        F.when(F.col("n") >= LEAST_WORDS, side_keys(F.col("line"), F.col("n"))).alias("keys"),
    )


def prepared(lines: DataFrame) -> DataFrame:
    """``lines(line, ...)`` with words and block hashes in its place, to be written before use.

    A sequence is hashed by blocks of the root of its length: ``plain`` has those of the line without its last word,
    ``moved`` those of the line without its first.
    """
    words = F.split("line", " ", -1)
    block = F.ceil(F.sqrt(F.size(words) - 1)).cast("int")
    numbers = F.sequence(F.lit(0), F.ceil((F.size(words) - 1) / block).cast("int") - 1)

    def hashes(shift: int) -> Column:
        return F.transform(numbers, lambda b: F.xxhash64(F.slice(words, b * block + shift, block)))

    return lines.select("*", words.alias("words"), hashes(1).alias("plain"), hashes(2).alias("moved")).drop("line")


def variants(lines: DataFrame) -> DataFrame:
    """(v, at, doc, no) of ``lines``, as ``prepared`` has them: the line (at -1) and the line without word ``at``.

    ``first`` and ``last`` say which end is shared with another line; words of a shared end are only deleted
    if both are. A variant's hash is put together from blocks before the deletion, the block around it, and
    blocks moved by one after it: about twice the root of the length for each, instead of the length.
    """
    words, n = F.col("words"), F.size("words")
    start = F.when(F.col("last"), F.lit(0)).otherwise(half(n - 1))
    end = F.when(F.col("first"), n - 1).otherwise(n - 1 - half(n - 1))

    whole_block = F.ceil(F.sqrt(n)).cast("int")
    whole_numbers = F.sequence(F.lit(0), F.ceil(n / whole_block).cast("int") - 1)
    whole = F.xxhash64(F.transform(whole_numbers, lambda b: F.xxhash64(F.slice(words, b * whole_block + 1, whole_block))))

    block = F.ceil(F.sqrt(n - 1)).cast("int")
    count = F.size("plain")

    def without(i: Column) -> Column:
        b = F.floor(i / block).cast("int")
        inside = i - b * block
        around = F.concat(F.slice(words, b * block + 1, inside), F.slice(words, i + 2, F.greatest(block - inside, F.lit(0))))
        after = F.slice(F.col("moved"), b + 2, F.greatest(count - b - 1, F.lit(0)))
        joined = F.concat(F.slice(F.col("plain"), 1, b), F.array(F.xxhash64(around)), after)
        return F.when(b < count, F.xxhash64(joined)).otherwise(F.xxhash64(F.col("plain")))

    hashes = F.concat(F.array(whole), F.transform(F.sequence(start, end), without))
    spread = lines.select("doc", "no", start.alias("start"), F.posexplode(hashes).alias("place", "v"))
    at = F.when(F.col("place") == 0, F.lit(-1)).otherwise(F.col("start") + F.col("place") - 1)
    return spread.select("v", at.alias("at"), "doc", "no")


def within_one(a: Column, b: Column) -> Column:
    """Whether the word edit distance of two sequences is at most one: common beginning and end leave one word."""
    most = F.greatest(F.size(a), F.size(b))

    def common(x: Column, y: Column) -> Column:
        differs = F.array_position(F.zip_with(x, y, lambda p, q: ~p.eqNullSafe(q)), F.lit(True))
        return F.when(differs == 0, F.size(x)).otherwise(differs - 1)

    return (F.abs(F.size(a) - F.size(b)) <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= most - 1)


def earliest_alike(made: DataFrame) -> DataFrame:
    """(doc, no, partner) of the lines in ``made``, as ``variants`` has them, that share a variant with an earlier one.

    Lines meet if they have a variant without a word at the same place, or if one is a variant of the other. The
    earliest of a group is a map-side aggregate that is joined back, so that a variant of very many lines is
    split over tasks. Variants that only one line has are left out first.
    """
    place = F.struct("doc", "no")
    shared = made.groupBy("v").agg(
        F.min("doc").alias("a"), F.max("doc").alias("b"), F.min("no").alias("c"), F.max("no").alias("d")
    ).where("a <> b OR c <> d").select("v")
    met = materialise(made.join(shared, "v"), "shared")
    at_place = met.groupBy("v", "at").agg(F.min(place).alias("alike"))
    anywhere = at_place.groupBy("v").agg(
        F.min(F.when(F.col("at") < 0, F.col("alike"))).alias("itself"),
        F.min(F.when(F.col("at") >= 0, F.col("alike"))).alias("shorter"),
    )
    partner = F.when(F.col("at") < 0, F.col("shorter")).otherwise(F.least("alike", "itself"))
    earliest = at_place.join(anywhere, "v").select("v", "at", partner.alias("partner"))
    return met.join(earliest, ["v", "at"]).where(F.col("partner") < place).select("doc", "no", "partner").distinct()


def near_lines(docs: DataFrame, rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """(doc, no) of the distinct lines that have an earlier line one word apart."""
    keyed = rows.where("keys IS NOT NULL").select("h", F.explode("keys").alias("k")).select("h", "k.last", "k.key")
    shared = keyed.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high").select("key")
    hits = keyed.join(shared, "key").groupBy("h").agg(
        F.bool_or(~F.col("last")).alias("first"), F.bool_or("last").alias("last")
    )
    wanted = (
        firsts.join(hits, "h")
        .groupBy(F.col("place.doc").alias("doc"))
        .agg(F.collect_list(F.struct(F.col("place.no").alias("no"), "h", "first", "last")).alias("wanted"))
    )
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text").join(wanted, "doc")
    split = texts.select("doc", F.split("text", "\n", -1).alias("lines"), "wanted")
    taken = split.select("doc", F.explode(F.transform("wanted", lambda w: F.struct(
        w["no"].alias("no"), w["h"].alias("h"), w["first"].alias("first"), w["last"].alias("last"),
        trimmed(F.try_element_at("lines", w["no"] + 1)).alias("line"),
    ))).alias("l"))
    found = taken.select("doc", "l.no", "l.h", "l.first", "l.last", "l.line").where(F.col("h") == F.xxhash64("line"))
    lines = materialise(prepared(found), "lines")
    place = F.struct("doc", "no")
    links = earliest_alike(variants(lines))
    other = lines.select(place.alias("partner"), F.col("words").alias("other"))
    pairs = links.join(lines.select("doc", "no", "words"), ["doc", "no"]).join(other, "partner")
    return pairs.where(within_one(F.col("words"), F.col("other"))).select("doc", "no").distinct()


def without_repeats(docs: DataFrame) -> DataFrame:
    """``cleaned(docs)`` with ``n_lines`` (lines of the whole text) and ``n_removed`` beside its columns.

    Given columns of these two names, in any case, give way to them.
    """
    counts = ("n_lines", "n_removed")
    old = [f"__old_{i}" for i, c in enumerate(docs.columns) if c.lower() in counts]
    given = docs.toDF(*(f"__old_{i}" if c.lower() in counts else c for i, c in enumerate(docs.columns))).drop(*old)
    return compared(given).toDF(*given.columns, *counts)


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that are equal to an earlier line or one word apart from one; ``n_chars`` renewed
    if there is one. Other columns stay as they are and may have any name.

    Earlier means in a document with a smaller ``doc_id`` (NULL before all) or earlier in the same one, whether or not
    that line stays. White space at the ends of a line does not count; words are what single spaces separate.
    Blank lines stay. Lines of fewer than LEAST_WORDS words go only if they are equal. NULL texts stay NULL and
    have no lines. Rows that share a ``doc_id`` are one document: their lines at one place are one occurrence.
    """
    made = compared(docs)
    return made.select(*made.columns[:-2]).toDF(*docs.columns)


def compared(docs: DataFrame) -> DataFrame:
    """The rows of ``cleaned``, other columns under other names, with (__all, __removed): counts of lines."""
    docs = apart(docs, "doc_id", "text", "n_chars")
    rows = materialise(line_rows(docs), "rows")
    place = F.struct("doc", "no")
    firsts = materialise(rows.where("h IS NOT NULL").groupBy("h", "g").agg(F.min(place).alias("place")).select("h", "place"), "firsts")
    near = near_lines(docs, rows, firsts).select("doc", "no", F.lit(True).alias("gone"))
    stay = firsts.select("place.doc", "place.no").union(rows.where("h IS NULL").select("doc", "no"))
    judged = stay.withColumn("gone", F.lit(False)).union(near).groupBy(F.col("doc").alias("__doc")).agg(
        F.collect_set(F.when(~F.col("gone"), F.col("no"))).alias("stay"), F.collect_set(F.when(F.col("gone"), F.col("no"))).alias("gone")
    )
    judged = judged.select("__doc", F.sort_array(F.array_except("stay", "gone")).alias("__stay"))
    met = docs.withColumn("__own", F.coalesce("doc_id", F.lit(NO_ID))).join(judged, F.col("__own") == F.col("__doc"), "left")
    met = met.withColumn("__lines", F.split("text", "\n", -1))
    # Rows that share an id may have fewer lines than the longest of them, and no line at all may stay.
    stay = F.filter(F.coalesce("__stay", F.array().cast("array<int>")), lambda i: i < F.size("__lines"))
    met = met.withColumn("__kept", stay)
    text = F.array_join(F.transform("__kept", lambda i: F.element_at("__lines", i + 1)), "\n")
    changed = F.col("text").isNotNull() & (F.size("__kept") < F.size("__lines"))
    met = met.withColumn("__text", F.when(changed, text).otherwise(F.col("text")))
    out = [F.col("__text").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    if "n_chars" in docs.columns:
        renewed = F.when(changed, F.length("__text")).otherwise(F.col("n_chars"))
        out[docs.columns.index("n_chars")] = renewed.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    total = F.when(F.col("text").isNotNull(), F.size("__lines")).otherwise(0).cast("long")
    removed = F.when(F.col("text").isNotNull(), F.size("__lines") - F.size("__kept")).otherwise(0).cast("long")
    return met.select(*out, total.alias("__all"), removed.alias("__removed"))
