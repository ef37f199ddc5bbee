"""References of pages and style sheets as column expressions.

A pass over the text gives attributes, one its style blocks; both are read as arrays of short pieces. Time grows
with the text, but for lines with very many calls that open a quote and never close it. White space is what HTML calls so.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.markup import PLACES, REFRESH, SET, STYLE

SPACE = " \t\n\r\x0b\f"
NO_NAME_BEFORE, NO_NAME_AFTER = r"(?<![\p{L}\p{N}_-])", r"(?![\p{L}\p{N}_-])"
# First letters are looked at before anything else: most places of a page are ruled out by them.
FIRST = "".join(sorted({x for name in PLACES for x in (name[0], name[0].upper())}))
ATTRIBUTE = rf"(?=[{FIRST}])(?i){NO_NAME_BEFORE}(?:{'|'.join(PLACES)})\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+')"
BLOCK_END = rf"(?i)</style{NO_NAME_AFTER}"
BLOCK_TEXT = rf"(?is)<style{NO_NAME_AFTER}[^>]*+>(.*+)"
#: A call up to its bracket; else to the end of a line on which no call is closed, so that those are not tried again
#: (but for one whose value begins on the next line).
CALL = r"(?i)url\(\s*+(?:\"[^\n]*?\"\s*+\)|'[^\n]*?'\s*+\)|[^)\n]*+\s*+\)|[^)\n]*?(?=url\([^\S\n]*+\n|\n|\z))"


def of_kind(place: str) -> list[str]:
    return [name for name, kind in PLACES.items() if kind == place]


def none() -> Column:
    return F.array().cast("array<string>")


def trimmed(text: Column, marks: str = SPACE) -> Column:
    return F.btrim(text, F.lit(marks))


def inner(text: Column) -> Column:
    """Without the first and last character."""
    return text.substr(F.lit(2), F.length(text) - 2)


def sheet_values(css: Column) -> Column:
    """Raw value of every ``url(...)``; a value does not run over the end of a line."""
    closed = F.filter(F.regexp_extract_all(css, F.lit(CALL), F.lit(0)), lambda call: call.endswith(")"))

    def value(held: Column) -> Column:
        first = held.substr(1, 1)
        quoted = (F.length(held) > 1) & first.isin("\"", "'") & held.endswith(first)
        return trimmed(trimmed(F.when(quoted, inner(held)).otherwise(held)), "\"'")

    held = F.transform(closed, lambda call: trimmed(call.substr(F.lit(5), F.length(call) - 5)))
    return F.transform(held, value)


def set_values(value: Column) -> Column:
    """First word of every item of a list with commas."""
    words = F.transform(F.split(value, ","), lambda item: F.regexp_extract(item, r"\S+", 0))
    return F.filter(words, lambda word: word != "")


def refresh_values(value: Column) -> Column:
    """The address in ``seconds; url=address``."""
    halves = F.split(value, ";", 2)
    sides = F.split(F.get(halves, F.lit(1)), "=", 2)
    address = F.get(sides, F.lit(1))
    timed = trimmed(F.get(halves, F.lit(0))).rlike("^[0-9]+$")
    told = timed & (F.lower(trimmed(F.get(sides, F.lit(0)))) == "url") & address.isNotNull()
    return F.when(told, F.array(F.ltrim(address, F.lit(SPACE)))).otherwise(none())


def attributes(html: Column) -> Column:
    """``name, value`` of the attributes that can hold references, in page order."""

    def cut(token: Column) -> Column:
        sides = F.split(token, "=", 2)
        return F.struct(
            F.lower(trimmed(sides[0])).alias("name"), inner(F.ltrim(sides[1], F.lit(SPACE))).alias("value")
        )

    return F.transform(F.regexp_extract_all(html, F.lit(ATTRIBUTE), F.lit(0)), cut)


def attribute_values(name: Column, value: Column) -> Column:
    return (
        F.when(name.isin(of_kind(STYLE)), sheet_values(value))
        .when(value.contains("\n"), none())
        .when(name.isin(of_kind(SET)), set_values(value))
        .when(name.isin(of_kind(REFRESH)), refresh_values(value))
        .otherwise(F.array(value))
    )


def style_blocks(html: Column) -> Column:
    """Text of every closed style block; what is not closed is no block."""
    pieces = F.split(html, BLOCK_END)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda piece: F.regexp_extract(piece, BLOCK_TEXT, 1))


def tagged(kind: Column, values: Column) -> Column:
    return F.transform(values, lambda raw: F.struct(kind.alias("kind"), raw.alias("raw")))


def numbered(found: Column) -> Column:
    return F.transform(
        found, lambda x, i: F.struct(x["kind"].alias("kind"), i.alias("pos"), x["raw"].alias("raw"))
    )


def page_references(html: Column) -> Column:
    """``kind, pos, raw`` of every reference of a page: those of attributes, then those of style blocks."""
    of_attributes = F.transform(
        attributes(html), lambda a: tagged(a["name"], attribute_values(a["name"], a["value"]))
    )
    of_blocks = F.transform(style_blocks(html), lambda block: tagged(F.lit("style_block"), sheet_values(block)))
    return numbered(F.flatten(F.concat(of_attributes, of_blocks)))


def sheet_references(css: Column) -> Column:
    """The same for the ``url(...)`` values of a style sheet."""
    return numbered(tagged(F.lit("css"), sheet_values(css)))
