"""Puts other references in the place of those of a page or style sheet.

One walk over the text gives slots: the stretch of text to replace, what kind of place it is, the
reference in it, and the text around it once it is replaced. Runs inside tasks, one page at a time.
Listing is done by expressions (``refs``); tests hold both against each other.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

# A name, an equals sign and an opening quote; names are taken whole and never given back.
QUOTED = re.compile(r"(?<![\w-])([\w-]++)\s*+=\s*+([\"'])")
STYLE_EDGE = re.compile(r"<(/?)style(?![\w-])", re.I)
CALL = re.compile(r"url\(\s*+", re.I)
LINE_END = re.compile("\n")
BRACKET = re.compile(r"\)")
CLOSE = {quote: re.compile(quote + r"\s*+\)") for quote in "\"'"}
TAG_REST = re.compile(r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+>?+")
META = re.compile(r"<meta(?![\w-])", re.I)
HEAD = re.compile(r"<head(?![\w-])", re.I)

WHOLE, SET, STYLE, REFRESH = "whole", "set", "style", "refresh"
PLACES = {
    "src": WHOLE, "href": WHOLE, "data-src": WHOLE, "poster": WHOLE,
    "srcset": SET, "style": STYLE, "content": REFRESH,
}


class Slot(NamedTuple):
    start: int
    end: int
    kind: str
    raw: str
    frame: str = "{}"


def ahead(pattern: re.Pattern[str], text: str, end: int) -> Callable[[int], re.Match[str] | None]:
    """The next match at or after places that only grow: the text is searched once."""
    last: list[re.Match[str] | None] = [pattern.search(text, 0, end)]

    def find(at: int) -> re.Match[str] | None:
        if last[0] is not None and last[0].start() < at:
            last[0] = pattern.search(text, at, end)
        return last[0]

    return find


def sheet_slots(text: str, start: int, end: int, kind: str = "css") -> Iterator[Slot]:
    """Every ``url(...)`` between two places; it may not run over the end of a line."""
    if start or end < len(text):
        part = text[start:end]
        inside = sheet_slots(part, 0, len(part), kind)
        yield from (s._replace(start=s.start + start, end=s.end + start) for s in inside)
        return
    next_line, next_bracket = ahead(LINE_END, text, end), ahead(BRACKET, text, end)
    next_close = {quote: ahead(p, text, end) for quote, p in CLOSE.items()}
    at = 0
    while call := CALL.search(text, at):
        at = call.end()
        line = next_line(at)
        stop = line.start() if line else end
        quote = text[at : at + 1]
        # The quote that a closing bracket follows; others belong to the value.
        close = next_close[quote](at + 1) if quote in next_close else None
        if close and close.start() < stop:
            raw, at = text[at + 1 : close.start()], close.end()
        else:
            bracket = next_bracket(at)
            if bracket is None:
                return
            if stop < bracket.start() and past_space(text, stop) != bracket.start():
                continue
            raw, at = text[at : bracket.start()], bracket.end()
        yield Slot(call.start(), at, kind, raw.strip().strip("\"'"), 'url("{}")')


def set_slots(text: str, start: int, end: int) -> Iterator[Slot]:
    """First word of every item of a list with commas."""
    at = start
    while at < end:
        comma = text.find(",", at, end)
        stop = end if comma < 0 else comma
        item = text[at:stop]
        words = item.split(None, 1)
        if words:
            first = at + len(item) - len(item.lstrip())
            yield Slot(first, first + len(words[0]), "srcset", words[0])
        at = stop + 1


def refresh_slot(text: str, start: int, end: int) -> Iterator[Slot]:
    """The address in ``seconds; url=address``."""
    seconds, _, rest = text[start:end].partition(";")
    word, equals, address = rest.partition("=")
    if equals and seconds.strip().isdigit() and word.strip().lower() == "url":
        raw = address.lstrip()
        yield Slot(end - len(raw), end, "content", raw)


def quoted_values(text: str, start: int, end: int) -> Iterator[tuple[str, int, int]]:
    """Lower-case name and value range of ``name="value"``, for the names asked about.

    A value of another name is not skipped: it may hold such a pair itself.
    """
    at = start
    while opening := QUOTED.search(text, at, end):
        at = opening.end()
        close = text.find(opening[2], at, end)
        if close < 0:
            continue
        name = opening[1].lower()
        yield name, at, close
        if name in PLACES:
            at = close + 1


def page_slots(html: str) -> Iterator[Slot]:
    """Slots of attributes in page order, then those of style blocks."""
    for name, start, end in quoted_values(html, 0, len(html)):
        place = PLACES.get(name)
        if place == STYLE:
            yield from sheet_slots(html, start, end, "style")
        elif place is None or "\n" in html[start:end]:
            continue
        elif place == WHOLE:
            yield Slot(start, end, name, html[start:end])
        elif place == SET:
            yield from set_slots(html, start, end)
        else:
            yield from refresh_slot(html, start, end)
    opened = None
    for edge in STYLE_EDGE.finditer(html):
        if edge[1] and opened is not None:
            yield from sheet_slots(html, opened, edge.start(), "style_block")
            opened = None
        elif not edge[1] and opened is None:
            bracket = html.find(">", edge.end())
            opened = None if bracket < 0 else bracket + 1


def tag_end(html: str, start: int) -> int:
    """Just past a tag's closing bracket; brackets inside quoted values do not count."""
    return TAG_REST.match(html, start).end()


def past_space(html: str, at: int) -> int:
    while at < len(html) and html[at].isspace():
        at += 1
    return at


def replaced(text: str, edits: list[tuple[int, int, str]]) -> str:
    """Edits in text order; one that begins inside another is left out."""
    out, at = [], 0
    for start, end, new in sorted(edits, key=lambda e: (e[0], -e[1])):
        if start >= at:
            out += (text[at:start], new)
            at = end
    return "".join([*out, text[at:]])


def known_edits(slots: Iterator[Slot], local: Callable[[str], str | None]) -> list[tuple[int, int, str]]:
    return [(s.start, s.end, s.frame.format(path)) for s in slots if (path := local(s.raw))]


def rewrite_css(css: str, local: dict[str, str]) -> str:
    return replaced(css, known_edits(sheet_slots(css, 0, len(css)), local.get))


def rewrite_page(html: str, local: dict[str, str], host: str) -> str:
    """Known references replaced, others as they are; a base tag put first in the head.

    Tags that set a content-security policy are taken out.
    """
    edits = []
    end = 0
    while meta := META.search(html, end):
        end = tag_end(html, meta.end())
        for name, a, b in quoted_values(html, meta.end(), end):
            if name == "http-equiv" and html[a:b].strip().lower() == "content-security-policy":
                edits.append((meta.start(), past_space(html, end), ""))
                break
    edits += known_edits(page_slots(html), local.get)
    head = HEAD.search(html)
    at = past_space(html, tag_end(html, head.end())) if head else 0
    body = replaced(html[at:], [(a - at, b - at, new) for a, b, new in edits if a >= at])
    front = replaced(html[:at], [e for e in edits if e[1] <= at])
    return f'{front}<base href="/{host}/">\n{body}'
