"""Reads the tables of one page. Runs inside tasks, one page at a time.

Only what table extraction needs is tracked: tables with their ids, classes and enclosing
divs, rows with their section, cells with text and spans. A row or cell belongs to every
table (or row) it lies inside, so a nested table also shows up in the rows around it. Each
is kept once: what lies inside a node is a range of the page's rows, cells and text pieces,
as everything is numbered in page order. The scan is linear however deep tables nest.

A page is split into its tags and the texts between them. Where its tables, rows and cells
are depends on the tags alone, so a layout that was met before is not worked out again.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from html import unescape
from itertools import accumulate, groupby, islice
from operator import itemgetter
from typing import NamedTuple

from tidemark.functions import fixed

# Everything in angle brackets. What tags say is kept if they may be tracked ones or are bare names.
TOKEN = re.compile(
    r"<(?:((?-i:/?[a-rt-zA-RT-Z][a-zA-Z0-9]*+(?=>))"
    r"|/?(?:t(?:[dhr]|able|head|body|foot)|div)(?![a-zA-Z0-9:-])(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|(?:/|(?!script(?u:\b)|style(?u:\b)))[a-zA-Z][a-zA-Z0-9:-]*+(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+>"
    r"|!--[^-]*+(?:-(?!->)[^-]*+)*+(?:-->)?"
    r"|script(?u:\b)[^>]*>.*?(?:</script(?u:\s)*>|\Z)"
    r"|style(?u:\b)[^>]*>.*?(?:</style(?u:\s)*>|\Z)"
    r"|![^>]*>)",
    re.S | re.I | re.A,
)
HEAD = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)(.*)", re.S | re.A)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SECTIONS = ("thead", "tbody", "tfoot")
CELLS = ("td", "th")
TRACKED = frozenset((*SECTIONS, *CELLS, "table", "tr", "div"))


NO_ATTRIBUTES: dict[str, str] = {}
# What stands between a tag's brackets, and what it says: closing, name if it is tracked, attributes. Pages of one
# site repeat a few of them; the number kept is bounded.
HEADS_KEPT, HEAD_LENGTH = 4096, 256
heads_met: dict[str, tuple[bool, str, dict[str, str]]] = {}
# Layouts of pages, by all their tags. The number kept is bounded, and so are the tags of one.
LAYOUTS_KEPT, TAGS_OF_ONE = 64, 4096
layouts_met: dict[tuple[str | None, ...], Layout] = {}


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if "=" in text:
        for name, double, single, bare in ATTRIBUTE.findall(text):
            found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def head_of(inside: str) -> tuple[bool, str, dict[str, str]]:
    known = heads_met.get(inside)
    if known is None:
        close, tag, raw = HEAD.fullmatch(inside).groups()
        tag = tag.lower()
        if tag not in TRACKED:
            known = False, "", NO_ATTRIBUTES
        else:
            known = bool(close), tag, NO_ATTRIBUTES if close else attributes(raw)
        if len(inside) <= HEAD_LENGTH:
            if len(heads_met) >= HEADS_KEPT:
                heads_met.clear()
            heads_met[inside] = known
    return known


def span(value: str) -> int:
    return int(value) if value.strip().isdigit() else 1


class Node:
    """A table, section or div: the ranges of what was met between its start and its end."""

    def __init__(self, kind: str, page: Layout):
        self.kind = kind
        self.since = page.counts()
        self.until = self.since

    def range(self, what: int) -> range:
        return range(self.since[what], self.until[what])


ROWS, CELLS_AT, TABLES, DATA, SEEN, HEADS, BODIES = range(7)


class Table(Node):
    def __init__(self, page: Layout, attrs: dict[str, str], depth: int, divs: list[str]):
        super().__init__("table", page)
        self.number = len(page.tables)
        self.id = attrs.get("id")
        self.css = attrs.get("class", "")
        self.depth = depth
        self.divs = divs
        self.rows_around = len(page.open_rows)
        self.own_rows = 0


class Row:
    """A row: the cells met between its start and its end."""

    __slots__ = ("kind", "number", "first", "last", "css", "table", "at", "own_cells")

    def __init__(self, page: Layout, css: str, table: Table | None):
        self.kind = "tr"
        self.number = len(page.rows)
        self.first = self.last = len(page.cells)
        self.css = css
        self.table = table
        self.at = 0 if table is None else table.own_rows
        self.own_cells = 0
        if table is not None:
            table.own_rows += 1


class Cell:
    """A cell: the pieces of text met between its start and its end."""

    __slots__ = ("kind", "first", "last", "row", "at", "css", "rowspan", "colspan")

    def __init__(self, page: Layout, tag: str, attrs: dict[str, str], row: Row | None):
        self.kind = tag
        self.first = self.last = len(page.inside)
        self.row = row
        self.css = ""
        self.at, self.rowspan, self.colspan = 0, 1, 1
        if attrs:
            self.css = attrs.get("class", "")
            self.rowspan = span(attrs["rowspan"]) if "rowspan" in attrs else 1
            self.colspan = span(attrs["colspan"]) if "colspan" in attrs else 1
        if row is not None:
            self.at = row.own_cells
            row.own_cells += 1


class Layout:
    """Tables of a page in document order, as its tags place them."""

    def __init__(self, tags: Sequence[str | None]):
        self.tables: list[Table] = []
        self.rows: list[Row] = []
        self.cells: list[Cell] = []
        # Where the texts inside cells are in the split page.
        self.inside: list[int] = []
        self.heads: list[Node] = []
        self.bodies: list[Node] = []
        # Data cells, and how often they are seen from the rows they lie inside.
        self.n_data = 0
        self.n_seen = 0
        self.open: list[Node | Row | Cell] = []
        self.open_tables: list[Table] = []
        self.open_rows: list[Row] = []
        self.open_cells = 0
        self.divs: list[str] = []
        self.read(tags)
        while self.open:
            self.close_top()
        self.texts = picker(self.inside)
        self.ranges = [(cell.first, cell.last) for cell in self.cells]
        # Cells lie inside each other so often that blank texts must not be met from every one of them.
        self.deep = sum(last - first for first, last in self.ranges) > 8 * len(self.inside)
        self.readings: dict[tuple, Reading] = {}

    def read(self, tags: Sequence[str | None]) -> None:
        """Every tag in turn. Cells and rows that begin and end as usual are dealt with here, others by the rules."""
        opened, cells, inside, open_rows = self.open, self.cells, self.inside, self.open_rows
        for at, said in enumerate(tags):
            if self.open_cells:
                inside.append(2 * at)
            if said is None:
                continue
            close, tag, attrs = head_of(said)
            if not tag:
                continue
            top = opened[-1] if opened else None
            if close:
                if top is None or top.kind != tag:
                    self.end(tag)
                elif tag in CELLS:
                    opened.pop()
                    top.last = len(inside)
                    self.open_cells -= 1
                elif tag == "tr":
                    opened.pop()
                    top.last = len(cells)
                    open_rows.pop()
                else:
                    self.close_top()
            elif tag in CELLS and top is not None and top.kind == "tr":
                self.open_cell(tag, attrs, top)
            else:
                self.start(tag, attrs)
        if self.open_cells:
            inside.append(2 * len(tags))

    def open_cell(self, tag: str, attrs: dict[str, str], row: Row | None) -> None:
        cell = Cell(self, tag, attrs, row)
        self.cells.append(cell)
        if tag == "td":
            self.n_data += 1
            self.n_seen += len(self.open_rows)
        self.open_cells += 1
        self.open.append(cell)

    def counts(self) -> tuple[int, ...]:
        return (
            len(self.rows), len(self.cells), len(self.tables), self.n_data, self.n_seen,
            len(self.heads), len(self.bodies),
        )

    def push(self, node: Node | Row | Cell) -> None:
        self.open.append(node)

    def close_top(self) -> None:
        node = self.open.pop()
        kind = node.kind
        if kind in CELLS:
            node.last = len(self.inside)
            self.open_cells -= 1
        elif kind == "tr":
            node.last = len(self.cells)
            self.open_rows.pop()
        else:
            node.until = self.counts()
            if kind == "table":
                self.open_tables.pop()
            elif kind == "div":
                self.divs.pop()

    def close_down_to(self, kinds: tuple[str, ...], stop: tuple[str, ...]) -> None:
        """Close the innermost open node of these kinds, unless ``stop`` comes first."""
        for depth in range(len(self.open) - 1, -1, -1):
            kind = self.open[depth].kind
            if kind in kinds:
                while len(self.open) > depth:
                    self.close_top()
                return
            if kind in stop:
                return

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        top = self.open[-1].kind if self.open else ""
        if tag in CELLS:
            if top != "tr":
                self.close_down_to(CELLS, ("table", "tr"))
            self.open_cell(tag, attrs, self.open_rows[-1] if self.open_rows else None)
        elif tag == "tr":
            if top != "table" and top not in SECTIONS:
                self.close_down_to(("tr",), ("table", *SECTIONS))
            table = self.open_tables[-1] if self.open_tables else None
            row = Row(self, attrs.get("class", ""), table)
            self.rows.append(row)
            self.open_rows.append(row)
            self.push(row)
        elif tag == "div":
            self.divs.append(attrs.get("id", ""))
            self.push(Node("div", self))
        elif tag == "table":
            divs = [name for name in self.divs if name]
            table = Table(self, attrs, len(self.open_tables), divs)
            self.tables.append(table)
            self.open_tables.append(table)
            self.push(table)
        else:
            self.close_down_to(SECTIONS, ("table",))
            section = Node(tag, self)
            if tag == "thead":
                self.heads.append(section)
            elif tag == "tbody":
                self.bodies.append(section)
            self.push(section)

    def end(self, tag: str) -> None:
        if self.open and self.open[-1].kind == tag:
            self.close_top()
        elif tag == "div":
            self.close_down_to(("div",), ("table", "tr", *CELLS, *SECTIONS))
        elif tag == "table":
            self.close_down_to(("table",), ())
        else:
            self.close_down_to((tag,), ("table",))

    def n_td(self, table: Table) -> int:
        """Data cells of all rows inside a table; a nested one counts in every row around it."""
        return len(table.range(SEEN)) - table.rows_around * len(table.range(DATA))

    def first_section(self, table: Table, what: int) -> range | None:
        """Rows of the first thead or tbody met anywhere inside a table."""
        inside = table.range(what)
        nodes = self.heads if what == HEADS else self.bodies
        return nodes[inside.start].range(ROWS) if inside else None


def picker(places: Sequence[int]) -> Callable[[Sequence[str]], Sequence[str]]:
    """Picks the values at some places of a list."""
    if len(places) > 1:
        return itemgetter(*places)
    return lambda values: [values[at] for at in places]


def layout_of(tags: tuple[str | None, ...]) -> Layout:
    layout = layouts_met.get(tags)
    if layout is None:
        layout = Layout(tags)
        if len(tags) <= TAGS_OF_ONE:
            if len(layouts_met) >= LAYOUTS_KEPT:
                layouts_met.clear()
            layouts_met[tags] = layout
    return layout


class PageTables:
    """The layout of a page and the text of its cells."""

    def __init__(self, html: str):
        parts = TOKEN.split(html)
        self.layout = layout = layout_of(tuple(parts[1::2]))
        self.tables, self.rows, self.cells = layout.tables, layout.rows, layout.cells
        self.pieces = [(unescape(t) if "&" in t else t).strip() for t in layout.texts(parts)]
        self.ranges = layout.ranges
        if layout.deep:
            before = [0, *accumulate(map(bool, self.pieces))]
            self.ranges = [(before[first], before[last]) for first, last in layout.ranges]
            self.pieces = list(filter(None, self.pieces))

    def texts(self) -> list[str]:
        """The whole text of every cell; it holds that of the tables inside the cell."""
        pieces = self.pieces
        return [pieces[a] if b - a == 1 else "".join(pieces[a:b]) for a, b in self.ranges]

    def lines(self, texts: list[str]) -> list[str]:
        """The first line of the first text in every cell that is not blank."""
        return [
            text if b - a == 1 and "\n" not in text else self.first_line(a, b)
            for text, (a, b) in zip(texts, self.ranges)
        ]

    def first_line(self, first: int, last: int) -> str:
        pieces = self.pieces
        while first < last and not pieces[first]:
            first += 1
        piece = pieces[first] if first < last else ""
        return piece.split("\n", 1)[0].strip() if "\n" in piece else piece


Heading = tuple[tuple[tuple[int, int, int], ...], ...]


def heading_of(layout: Layout, rows: range) -> Heading:
    """Number, rows and columns of every cell in the rows of a heading."""
    return tuple(
        tuple((n, layout.cells[n].rowspan, layout.cells[n].colspan) for n in range(layout.rows[r].first, layout.rows[r].last))
        for r in rows
    )


def spanned_names(heading: Heading, texts: Sequence[str]) -> list[str]:
    """Column names of a spanned heading, the labels above a column joined by " - ".

    The width is that of the first row. A blank cell takes no place: the next cell of its
    row moves up into it. Every row is a list of columns that its own labels, and those
    reaching down from rows above, fill from the left.
    """
    if not heading:
        return []
    width = sum(colspan for _, _, colspan in heading[0])
    grid: list[list[str | None]] = [[None] * width for _ in heading]
    for r, line in enumerate(grid):
        cursor = 0
        for number, rowspan, colspan in heading[r]:
            label = texts[number]
            while cursor < width and line[cursor] is not None:
                cursor += 1
            if cursor == width:
                break
            if label:
                across = range(cursor, min(cursor + colspan, width))
                for below in grid[r : r + rowspan]:
                    for column in across:
                        below[column] = below[column] or label
    columns = zip(*grid) if width else ()
    return [
        " - ".join(label for label, _ in groupby(filter(None, labels))) or f"col_{i}"
        for i, labels in enumerate(columns)
    ]


def scan(html: str | None) -> PageTables | None:
    return PageTables(html) if html and "<table" in html.lower() else None


def read_tables(page: Layout, ids: list[str], grids: list[str]) -> set[int]:
    """Numbers of the tables somebody reads rows of.

    The first one of the page, the first with each known id, those in a grid's div, and the
    largest nested table of each.
    """
    wanted = {0} if page.tables else set()
    known = set(ids)
    for table in page.tables:
        if table.id in known:
            known.discard(table.id)
            wanted.add(table.number)
        elif any(name in grids for name in table.divs):
            wanted.add(table.number)
    for number in sorted(wanted):
        nested = page.tables[number + 1 : page.tables[number].until[TABLES]]
        if nested:
            wanted.add(max(nested, key=lambda t: (page.n_td(t), -t.number)).number)
    return wanted


class Reading(NamedTuple):
    """What a reader gives of all pages of a layout, the texts left open, and the cells these are in."""

    fixed: list[tuple]
    headings: list[Heading] = []
    classed: Callable[[Sequence[str]], Sequence[str]] | None = None
    th: Callable[[Sequence[str]], Sequence[str]] | None = None
    td: Callable[[Sequence[str]], Sequence[str]] | None = None
    names_met: dict[tuple[str, ...], list[str]] | None = None


NAMES_KEPT = 16


def tables_of_layout(layout: Layout, ids: tuple[str, ...], grids: tuple[str, ...], every: bool) -> Reading:
    wanted = set(range(len(layout.tables))) if every else read_tables(layout, list(ids), list(grids))
    out, headings = [], []
    all_classed: list[int] = []
    all_th: list[int] = []
    all_td: list[int] = []
    for table in layout.tables:
        head = layout.first_section(table, HEADS)
        body = layout.first_section(table, BODIES)
        rows, classed, names = None, None, None
        if table.number in wanted:
            in_grid = any(name in grids for name in table.divs)
            if head is not None:
                heading = heading_of(layout, head)
                headings.append(heading)
                names = [None] * (sum(colspan for _, _, colspan in heading[0]) if heading else 0)
            labels = [
                n for n in table.range(CELLS_AT)
                if layout.cells[n].kind == "td" and layout.cells[n].css
                and fixed.ROW_LABEL_CLASS in layout.cells[n].css.split()
            ]
            all_classed += labels
            classed = [(layout.cells[n].css, None) for n in labels]
            rows = []
            for r in table.range(ROWS):
                row = layout.rows[r]
                data = [n for n in range(row.first, row.last) if layout.cells[n].kind == "td"]
                all_td += data
                in_head = head is not None and r in head
                th = []
                if in_grid and in_head:
                    th = [n for n in range(row.first, row.last) if layout.cells[n].kind == "th"]
                    all_th += th
                rows.append(
                    (
                        in_head,
                        body is not None and r in body,
                        row.css,
                        [None] * len(th),
                        [None] * len(data),
                        [None] * len(data),
                        len(data),
                    )
                )
        out.append(
            (
                table.number,
                table.id,
                table.css,
                table.until[TABLES] - 1,
                table.divs,
                head is not None,
                body is not None,
                layout.n_td(table),
                names,
                classed,
                rows,
            )
        )
    return Reading(out, headings, picker(all_classed), picker(all_th), picker(all_td), {})


def names_of(reading: Reading, texts: Sequence[str]) -> list[str]:
    """Column names of all headings that are read, one after the other; pages of a layout mostly repeat them."""
    if not reading.headings:
        return []
    labels = tuple(texts[n] for heading in reading.headings for row in heading for n, _, _ in row)
    names = reading.names_met.get(labels)
    if names is None:
        names = [name for heading in reading.headings for name in spanned_names(heading, texts)]
        if len(reading.names_met) >= NAMES_KEPT:
            reading.names_met.clear()
        reading.names_met[labels] = names
    return names


NOTHING = Reading([])
TABLE_IDS = tuple(row[0] for row in fixed.LOGICAL_TABLES)


def table_texts(
    html: str | None, ids: tuple[str, ...] = TABLE_IDS, grids: tuple[str, ...] = (fixed.GRID_ID,), every: bool = False
) -> tuple[Reading, Sequence[Sequence[str]]]:
    """What the tables of a page are, and the texts that fill them: column names, label cells, heading cells, data
    cells and the first lines of these."""
    page = scan(html)
    if page is None:
        return NOTHING, ((), (), (), (), ())
    layout = page.layout
    options = (ids, grids, every)
    reading = layout.readings.get(options)
    if reading is None:
        reading = layout.readings[options] = tables_of_layout(layout, *options)
    texts = page.texts()
    lines = page.lines(texts)
    return reading, (names_of(reading, texts), reading.classed(texts), reading.th(texts), reading.td(texts), reading.td(lines))


def page_tables(
    html: str | None,
    ids: tuple[str, ...] = TABLE_IDS,
    grids: tuple[str, ...] = (fixed.GRID_ID,),
    every: bool = False,
) -> list[tuple]:
    """Tables as nested tuples, in the field order of ``operators.tables.TABLES_TYPE``.

    A row has the whole text and the first line of every cell. The tables of ``read_tables`` have rows, with
    ``every`` all tables: the text of a nested table is in the cells around it too, so these rows are as long as
    the page times the depth of its tables, and a page of very many tables inside each other takes long.
    """
    reading, texts = table_texts(html, ids, grids, every)
    names, classed, th, td, lines = map(iter, texts)

    def filled(places: list | None, given: Iterator[str]) -> list[str] | None:
        return None if places is None else list(islice(given, len(places)))

    return [
        (
            *table,
            filled(columns, names),
            None if labels is None else [(css, next(classed)) for css, _ in labels],
            None if rows is None else [
                (*row, filled(heads, th), filled(cells, td), filled(firsts, lines), n)
                for *row, heads, cells, firsts, n in rows
            ],
        )
        for *table, columns, labels, rows in reading.fixed
    ]


CELL_TEXT = 7


def cells_of_layout(layout: Layout) -> Reading:
    out, placed = [], []
    sections = [(layout.first_section(t, HEADS), layout.first_section(t, BODIES)) for t in layout.tables]
    for number, cell in enumerate(layout.cells):
        row = cell.row
        if row is None or row.table is None:
            continue
        table, r = row.table, row.number
        head, body = sections[table.number]
        section = "thead" if head and r in head else "tbody" if body and r in body else None
        placed.append(number)
        out.append(
            (
                table.number, table.id, table.depth, row.at, section, cell.at, cell.kind,
                None, cell.rowspan, cell.colspan, cell.css,
            )
        )
    return Reading(out, td=picker(placed))


def cell_texts(html: str | None) -> tuple[Reading, Sequence[str]]:
    """What the cells of a page are, and the text of each."""
    page = scan(html)
    if page is None:
        return NOTHING, ()
    readings = page.layout.readings
    reading = readings.get(())
    if reading is None:
        reading = readings[()] = cells_of_layout(page.layout)
    return reading, reading.td(page.texts())


def page_cells(html: str | None) -> list[tuple]:
    """Every cell once, under the row and table it stands in, in the field order of
    ``operators.tables.CELL_TYPE``. Its text holds that of the tables inside it."""
    reading, texts = cell_texts(html)
    return [(*cell[:CELL_TEXT], text, *cell[CELL_TEXT + 1 :]) for cell, text in zip(reading.fixed, texts)]


def read_pages(reader: str, pages: Iterable[str | None], options: tuple) -> list:
    """Some pages in turn. What is read of them is a tree that goes when it is no longer named, so the search for
    reference cycles, which walks all objects there are again and again, waits until the pages are read."""
    read = {"page_tables": page_tables, "page_cells": page_cells, "table_texts": table_texts, "cell_texts": cell_texts}[reader]
    searched = gc.isenabled()
    gc.disable()
    try:
        return [read(page, *options) for page in pages]
    finally:
        if searched:
            gc.enable()
