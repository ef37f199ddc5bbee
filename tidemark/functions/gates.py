"""Predicates that decide whether a captured response or page is used."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import calendar, clean, fixed

TABLE_ID_PATTERN = "(?i)<table(?:\\s[^>]*?)?\\sid\\s*=\\s*[\"']([^\"']*)[\"']"


def latin1(content: Column) -> Column:
    """Response bytes as text."""
    return F.decode(content, "ISO-8859-1")


def payload_ok(content: Column, text: Column | None = None) -> Column:
    """Long enough, not an HTML challenge page, and holding the date heading."""
    text = content if text is None else text
    start = F.lower(F.substring(F.ltrim(text, F.lit("\r\n \t")), 1, 5))
    return (
        (F.octet_length(content) >= fixed.MIN_PAYLOAD_BYTES)
        & (start != "<html")
        & text.contains(fixed.PAYLOAD_MARK)
    )


def is_blocked(html: Column) -> Column:
    return html.contains(fixed.BLOCK_MARK)


def table_ids(html: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(html, F.lit(TABLE_ID_PATTERN), F.lit(1)))


def table_hits(html: Column, expected: list[str]) -> Column:
    """How many of the expected table ids the page holds."""
    wanted = F.array(*[F.lit(i) for i in expected])
    return F.size(F.array_intersect(table_ids(html), wanted))


def effective_date(label: Column) -> Column:
    """The last dd/mm/yyyy in the label, as text; NULL without one."""
    dates = F.regexp_extract_all(label, F.lit(r"\b(\d{2}/\d{2}/\d{4})\b"), F.lit(1))
    return F.try_element_at(dates, F.lit(-1))


def in_force(label: Column, requested: Column) -> Column:
    """A label without a date passes."""
    effective = effective_date(label)
    return effective.isNull() | (effective == calendar.format_dmy(requested))


def foreign_confirmed(label: Column, requested: Column) -> Column:
    same_day = effective_date(label) == calendar.format_dmy(requested)
    return F.coalesce(label.contains(fixed.FOREIGN_MARK) & same_day, F.lit(False))


def http_ok(status: Column) -> Column:
    return F.coalesce(status < 400, F.lit(False))


def any_text(cells: Column) -> Column:
    """At least one cell of the row is not blank."""
    return F.exists(cells, lambda c: clean.strip(c) != "")


def selected(code: Column, codes: list[str]) -> Column:
    if not codes:
        raise ValueError("choose at least one currency")
    return code.isin(codes)


def person_kept(person: Column, natural: bool = True, legal: bool = True) -> Column:
    dropped = [p for p, kept in ((fixed.NATURAL, natural), (fixed.LEGAL, legal)) if not kept]
    return ~person.isin(dropped) if dropped else F.lit(True)
