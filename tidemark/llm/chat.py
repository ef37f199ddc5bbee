"""Conversations as training texts: sorted turns, merged by role, with a loss mask, and read back.

    <s>[SYS]…[/SYS][INST]…[NEXT]…[/INST][OUT]…[/OUT][ROLE]name[NAME]…[/ROLE]</s>

Adjacent turns of one role are one block; ``[NEXT]`` stands between their texts. A control string inside
a text gets a backslash after its bracket (one more if it has some already), which reading back takes
away again. The loss mask has a span for every assistant text, without its marks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: Marks of the roles that have their own; any other role is a [ROLE] block with its name.
MARKS = {"system": "SYS", "user": "INST", "assistant": "OUT"}
START, END = "<s>", "</s>"
NAMES = "s>|/s>|(?:/?(?:SYS|INST|OUT|ROLE)|NEXT|NAME)\\]"
CONTROL = rf"([<\[])(\\*)({NAMES})"
ESCAPED = rf"([<\[])\\(\\*)({NAMES})"
BLOCK = r"(?s)\[(SYS|INST|OUT|ROLE)\](.*?)\[/\1\]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def mark_of(role: Column) -> Column:
    found = F.lit("ROLE")
    for name, mark in MARKS.items():
        found = F.when(role == name, F.lit(mark)).otherwise(found)
    return found


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often the result names it, also for each element of an array."""
    return F.transform(F.array(value), use)[0]


def merged(turns: Column) -> Column:
    """Array of (role, texts): adjacent turns of one role together, in order.

    A block starts where the role differs from that of the turn before, and reaches to the next start.
    """

    def blocks(starts: Column) -> Column:
        def block(start: Column, i: Column) -> Column:
            end = F.coalesce(F.try_element_at(starts, i + 2), F.size(turns) + 1)
            own = F.slice(turns, start, end - start)
            return F.struct(
                F.element_at(turns, start)["role"].alias("role"), F.transform(own, lambda t: t["text"]).alias("texts")
            )

        return F.transform(starts, block)

    def starts_block(i: Column) -> Column:
        return (i == 1) | (F.element_at(turns, i)["role"] != F.element_at(turns, F.greatest(i - 1, F.lit(1)))["role"])

    return bound(F.filter(F.sequence(F.lit(1), F.size(turns)), starts_block), blocks)


def pieces(blocks: Column) -> Column:
    """Array of (before, text, after, loss), one for each text: what stands one after the other in the formatted text."""

    def block(b: Column) -> Column:
        mark, count = mark_of(b["role"]), F.size(b["texts"])
        name = F.when(mark == "ROLE", F.concat(escaped(b["role"]), F.lit("[NAME]"))).otherwise(F.lit(""))
        ends = F.struct(
            F.concat(F.lit("["), mark, F.lit("]"), name).alias("opened"), F.concat(F.lit("[/"), mark, F.lit("]")).alias("closed")
        )

        def piece(text: Column, i: Column, mark: Column) -> Column:
            return F.struct(
                F.when(i == 0, mark["opened"]).otherwise(F.lit("")).alias("before"),
                escaped(text).alias("text"),
                F.when(i + 1 < count, F.lit("[NEXT]")).otherwise(mark["closed"]).alias("after"),
                (b["role"] == "assistant").alias("loss"),
            )

        return bound(ends, lambda mark: F.transform(b["texts"], lambda t, i: piece(t, i, mark)))

    return F.flatten(F.transform(blocks, block))


def sums_before(values: Column) -> Column:
    """For every value of an array the sum of those before it.

    Sums are taken inside slices as long as the root of the array, and over the slices, so that no long array is
    copied for each of its values.
    """

    def running(part: Column) -> Column:
        none = F.array(F.lit(0).cast("long"))
        return F.aggregate(part, none, lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)))

    def joined(all_values: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(all_values))), F.lit(1)).cast("int")
        starts = F.sequence(F.lit(1), F.greatest(F.size(all_values), F.lit(1)), width)
        return bound(F.transform(starts, lambda at: running(F.slice(all_values, at, width))), over_slices)

    def over_slices(slices: Column) -> Column:
        ahead = running(F.transform(slices, lambda sums: F.element_at(sums, -1)))

        def shifted(sums: Column, start: Column) -> Column:
            # The last sum of a slice is that of all its values and stands before the next slice.
            return F.transform(F.slice(sums, 1, F.size(sums) - 1), lambda x: x + start)

        return F.flatten(F.zip_with(slices, F.slice(ahead, 1, F.size(slices)), shifted))

    return bound(values, joined)


def spans(parts: Column) -> Column:
    """Spans of the parts under the loss mask: start from 0 and length, in code points and in bytes of UTF-8."""

    def lengths(measure: Callable[[Column], Column]) -> Column:
        def total(p: Column) -> Column:
            return (measure(p["before"]) + measure(p["text"]) + measure(p["after"])).cast("long")

        return sums_before(F.transform(parts, total))

    places = F.zip_with(
        lengths(F.length), lengths(F.octet_length), lambda c, b: F.struct(c.alias("chars"), b.alias("bytes"))
    )

    def span(p: Column, place: Column) -> Column:
        return F.struct(
            (place["chars"] + F.length(p["before"]) + len(START)).alias("start"),
            F.length(p["text"]).cast("long").alias("chars"),
            (place["bytes"] + F.octet_length(p["before"]) + len(START)).alias("start_byte"),
            F.octet_length(p["text"]).cast("long").alias("bytes"),
        )

    marked = F.zip_with(parts, places, lambda p, place: F.when(p["loss"], span(p, place)))
    return F.filter(marked, lambda s: s.isNotNull())


def format_chats(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of ``rows(conv_id, turn, role, text)``; further columns are left out.

    Turns come by ``turn`` (NULL first), then role and text, so ties and repeated rows have one order. NULL
    texts and roles are empty. A conversation is one text and so one row, as long as its turns make it; NULL
    is a conversation of its own. One shuffle, by conversation; the work in a conversation grows with its turns.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    parts = turns.select("conv_id", pieces(merged(F.col("turns"))).alias("parts"))
    return parts.select(
        "conv_id",
        F.concat(
            F.lit(START), F.array_join(F.transform("parts", lambda p: F.concat(p["before"], p["text"], p["after"])), ""), F.lit(END)
        ).alias("formatted"),
        spans(F.col("parts")).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text), one for each turn that was formatted, from the formatted text alone."""
    blocks = F.arrays_zip(
        F.regexp_extract_all(formatted, F.lit(BLOCK), F.lit(1)).alias("mark"),
        F.regexp_extract_all(formatted, F.lit(BLOCK), F.lit(2)).alias("body"),
    )

    def block(b: Column) -> Column:
        named = F.split(b["body"], r"\[NAME\]", -1)
        role, body = unescaped(F.element_at(named, 1)), F.element_at(named, -1)
        for name, mark in MARKS.items():
            role = F.when(b["mark"] == mark, F.lit(name)).otherwise(role)
            body = F.when(b["mark"] == mark, b["body"]).otherwise(body)
        return F.struct(role.alias("role"), F.split(body, r"\[NEXT\]", -1).alias("texts"))

    def turns(b: Column) -> Column:
        return F.transform(b["texts"], lambda t: F.struct(b["role"].alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(F.transform(blocks, block), turns))


def loss_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped span by span, nothing between. Spans are cut by their bytes."""

    def cut(raw: Column) -> Column:
        def text(s: Column) -> Column:
            return unescaped(F.substring(raw, (s["start_byte"] + 1).cast("int"), s["bytes"].cast("int")).cast("string"))

        return F.array_join(F.transform(loss_spans, text), "")

    return bound(formatted.cast("binary"), cut)
