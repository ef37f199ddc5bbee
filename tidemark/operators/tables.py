"""Table extraction from captured pages.

``page_tables`` is the only Python step: it turns the HTML of a page into one array of
tables. Everything after it is column expressions over that array, so a page is never
taken apart and shuffled back together; rows are exploded at the very end.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import calendar, clean, fixed

ROW = (
    "struct<in_head:boolean,in_body:boolean,css:string,"
    "th:array<string>,td:array<string>,lines:array<string>,n:int>"
)
TABLES_TYPE = (
    "array<struct<table_no:int,table_id:string,css:string,last_inside:int,"
    "div_ids:array<string>,has_head:boolean,has_body:boolean,n_td:int,"
    "header_names:array<string>,classed:array<struct<css:string,text:string>>,"
    f"rows:array<{ROW}>>>"
)
CELL_TYPE = (
    "array<struct<table_no:int,table_id:string,depth:int,row:int,section:string,col:int,"
    "tag:string,text:string,rowspan:int,colspan:int,css:string>>"
)

# Output batches stay small, however large the pages are.
PAGES_PER_BATCH = 256
CELLS_PER_BATCH = 16_384


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind.fields])
    return {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}[kind.simpleString()]


def _column(values: list, kind: pa.DataType) -> pa.Array:
    """Lists and tuples as an Arrow array, made column by column: building it value by value takes longer than the scan."""
    if pa.types.is_list(kind):
        lengths = [0 if v is None else len(v) for v in values]
        offsets: list[int | None] = [0, *accumulate(lengths)]
        for at, v in enumerate(values):
            if v is None:
                offsets[at] = None
        inner = [x for v in values if v for x in v]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _column(inner, kind.value_type))
    if pa.types.is_struct(kind):
        columns = zip(*values) if values else [() for _ in kind]
        return pa.StructArray.from_arrays([_column(list(c), f.type) for c, f in zip(columns, kind)], fields=list(kind))
    return pa.array(values, kind)


def _with_texts(array: pa.Array, texts: dict[str, list[str]]) -> pa.Array:
    """The array with the values of some fields of its structs, all fields of one name in turn, put in."""
    if pa.types.is_list(array.type):
        inner = _with_texts(array.values, texts)
        return pa.ListArray.from_arrays(array.offsets, inner, mask=array.is_null() if array.null_count else None)
    if not pa.types.is_struct(array.type):
        return array
    parts = []
    for at, field in enumerate(array.type):
        part = array.field(at)
        if field.name in texts:
            given = pa.array(texts[field.name], pa.string())
            if pa.types.is_list(field.type):
                if len(given) != len(part.values):
                    raise ValueError(f"{len(given)} texts for {len(part.values)} places of {field.name}")
                mask = part.is_null() if part.null_count else None
                part = pa.ListArray.from_arrays(part.offsets, given, mask=mask)
            else:
                part = given
        elif pa.types.is_list(field.type) and pa.types.is_struct(field.type.value_type):
            part = _with_texts(part, texts)
        parts.append(part)
    return pa.StructArray.from_arrays(parts, fields=list(array.type))


def _distinct(found: list[tuple]) -> tuple[list[list[tuple]], list[int]]:
    """What is the same in all pages of a layout, once, and which of them every page has."""
    numbers: dict[int, int] = {}
    fixed_parts, which = [], []
    for reading, _ in found:
        number = numbers.setdefault(id(reading), len(fixed_parts))
        if number == len(fixed_parts):
            fixed_parts.append(reading.fixed)
        which.append(number)
    return fixed_parts, which


# Where the texts of ``table_scan.table_texts`` go.
TEXT_FIELDS = ("header_names", "text", "th", "td", "lines")


def _tables_column(found: list[tuple], kind: pa.DataType) -> pa.Array:
    fixed_parts, which = _distinct(found)
    places = _column(fixed_parts, kind).take(pa.array(which, pa.int32()))
    texts = {name: [t for _, given in found for t in given[at]] for at, name in enumerate(TEXT_FIELDS)}
    return _with_texts(places, texts)


def _page_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PAGES_PER_BATCH):
            yield batch.slice(at, PAGES_PER_BATCH)


def _type_of(kind: str) -> T.DataType:
    return T._parse_datatype_string(f"t {kind}").fields[0].dataType


def _with_page(captures: DataFrame, names: list[str], html_col: str) -> DataFrame:
    """Pages without any table stay out of the transfer to Python."""
    page = F.when(F.lower(html_col).contains("<table"), F.col(html_col)).alias(html_col)
    return captures.select(*names, page)


def page_tables(
    captures: DataFrame,
    html_col: str = "html",
    out: str = "tables",
    ids: tuple[str, ...] = tuple(row[0] for row in fixed.LOGICAL_TABLES),
    grids: tuple[str, ...] = (fixed.GRID_ID,),
    every: bool = False,
) -> DataFrame:
    """Replace the HTML column by the array of its tables; other columns pass through.

    Rows are read, every cell whole, for the page's first table, those with a known id, those in a grid's div, and the
    largest table inside each; the others have NULL rows. ``every=True`` reads the rows of all tables: longer by the
    depth to which tables stand inside each other, so it is for pages known to be flat. ``html_cells`` gives all cells too.
    """
    kept = [f for f in captures.schema.fields if f.name not in (html_col, out)]
    names = [f.name for f in kept]
    found_type = _type_of(TABLES_TYPE)
    arrow_type = _arrow(found_type)
    options = (tuple(ids), tuple(grids), every)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tidemark.functions import table_scan

        for part in _page_parts(batches):
            pages = part.column(part.schema.get_field_index(html_col)).to_pylist()
            found = _tables_column(table_scan.read_pages("table_texts", pages, options), arrow_type)
            columns = [part.column(part.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, found], names=[*names, out])

    schema = T.StructType([*kept, T.StructField(out, found_type)])
    return _with_page(captures, names, html_col).mapInArrow(scan, schema)


def html_cells(
    captures: DataFrame, keep: list[str], html_col: str = "html", fields: list[str] | None = None
) -> DataFrame:
    """Long cell table: every cell once, under the table and row it stands in.

    ``fields`` names the columns that are wanted of a cell, all of them by default.
    """
    all_fields = _type_of(CELL_TYPE).elementType.fields
    wanted = [f for f in all_fields if fields is None or f.name in fields]
    places = [all_fields.index(f) for f in wanted]
    arrow_types = [_arrow(f.dataType) for f in wanted]
    # Names of their own, as a page's column may be named like one of a cell.
    kept = [T.StructField(f"_k{i}", captures.schema[n].dataType) for i, n in enumerate(keep)]
    schema = T.StructType([*kept, *wanted])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tidemark.functions import table_scan

        for part in _page_parts(batches):
            pages = part.column(len(kept)).to_pylist()
            found = table_scan.read_pages("cell_texts", pages, ())
            fixed_parts, which = _distinct(found)
            cells = [cell for cells in fixed_parts for cell in cells]
            columns = list(zip(*cells)) if cells else [()] * len(all_fields)
            given = {
                at: pa.array(columns[at], kind)
                for at, kind in zip(places, arrow_types) if at != table_scan.CELL_TEXT
            }
            starts = np.cumsum([0, *map(len, fixed_parts)])
            lengths = np.array([len(texts) for _, texts in found], dtype=np.int64)
            firsts = np.cumsum(lengths) - lengths
            n_cells = int(lengths.sum())
            page_of = np.repeat(np.arange(len(found)), lengths)
            cell_of = np.arange(n_cells) + np.repeat(starts[which] - firsts, lengths)
            texts = [text for _, page_texts in found for text in page_texts]
            for at in range(0, n_cells, CELLS_PER_BATCH):
                some = slice(at, at + CELLS_PER_BATCH)
                rows, cells_at = pa.array(page_of[some]), pa.array(cell_of[some])
                arrays = [part.column(i).take(rows) for i in range(len(kept))]
                for place in places:
                    if place == table_scan.CELL_TEXT:
                        arrays.append(pa.array(texts[some], pa.string()))
                    else:
                        arrays.append(given[place].take(cells_at))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    named = captures.select(*[F.col(n).alias(k.name) for n, k in zip(keep, kept)], F.col(html_col).alias("_page"))
    cells = _with_page(named, [k.name for k in kept], "_page").mapInArrow(scan, schema)
    return cells.select(
        *[F.col(k.name).alias(n) for n, k in zip(keep, kept)],
        *[f"`{n}`" for n in (fields if fields is not None else [f.name for f in wanted])],
    )


def flat_rows(pages: DataFrame, keep: list[str]) -> DataFrame:
    """Quotes in the first table of a response: ``fecha, moneda, compra, venta, fila``.

    The heading row is skipped, and so are rows with fewer than four cells or a bad date.
    """
    rows = F.try_element_at("tables", F.lit(1))["rows"]
    body = F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))
    values = pages.select(*keep, F.posexplode(body).alias("fila", "r")).select(
        *keep, "fila", F.col("r.td").alias("v")
    )
    cell = [F.try_element_at("v", F.lit(i)) for i in range(1, 5)]
    return (
        values.filter(F.size("v") >= 4)
        .select(
            *keep,
            "fila",
            calendar.parse_dmy(clean.strip(cell[0])).alias("fecha"),
            clean.normalise_currency(cell[1]).alias("moneda"),
            clean.clean_amount(cell[2]).alias("compra"),
            clean.clean_amount(cell[3]).alias("venta"),
        )
        .filter(F.col("fecha").isNotNull())
    )


def has_class(css: Column, name: str) -> Column:
    return F.array_contains(F.split(css, r"\s+"), name)


def class_grid(
    pages: DataFrame,
    keep: list[str],
    grid_id: str = fixed.GRID_ID,
    grid_class: str = fixed.GRID_CLASS,
    row_classes: list[str] = fixed.GRID_ROW_CLASSES,
) -> DataFrame:
    """Rows of the grid inside a div: ``fila``, its headings ``titulos`` and cells ``valores``.

    Rows whose cell count differs from the number of headings, and blank rows, are left out.
    """
    grids = F.filter(
        "tables",
        lambda t: F.array_contains(t["div_ids"], grid_id) & has_class(t["css"], grid_class),
    )
    grid = pages.select(*keep, F.try_element_at(grids, F.lit(1)).alias("g")).filter("g.has_head")
    heads = F.flatten(F.transform(F.filter("g.rows", lambda r: r["in_head"]), lambda r: r["th"]))

    def is_data(row: Column) -> Column:
        found = F.lit(False)
        for name in row_classes:
            found = found | row["css"].contains(name)
        return found

    rows = grid.select(
        *keep,
        F.filter(heads, lambda h: h != "").alias("titulos"),
        F.posexplode(F.filter("g.rows", is_data)).alias("fila", "r"),
    ).filter((F.size("titulos") > 0) & (F.col("r.n") == F.size("titulos")))
    values = rows.select(*keep, "fila", "titulos", F.col("r.td").alias("valores"))
    return values.filter(F.exists("valores", lambda v: v != ""))


def grid_value(name: str) -> Column:
    """Cell under a heading; of two equal headings the later one counts."""
    place = F.size("titulos") - F.array_position(F.reverse("titulos"), name).cast("int")
    return F.get("valores", F.when(place < F.size("titulos"), place))


def grid_fields(grid: DataFrame, keep: list[str]) -> DataFrame:
    """``campos``: heading -> text of every grid row, as a map."""
    last = F.transform(
        "titulos", lambda h, i: F.array_position(F.reverse("titulos"), h) == F.size("titulos") - i
    )
    pairs = F.filter(
        F.arrays_zip(F.col("titulos").alias("k"), F.col("valores").alias("x"), last.alias("u")),
        lambda p: p["u"],
    )
    entries = F.transform(pairs, lambda p: F.struct(p["k"], p["x"]))
    return grid.select(*keep, "fila", F.map_from_entries(entries).alias("campos"))


def grid_quotes(
    grid: DataFrame, keep: list[str], columns: tuple[str, str, str] = fixed.GRID_COLUMNS
) -> DataFrame:
    """Currency, buy and sell columns of a grid as a quote."""
    name, buy, sell = (grid_value(c) for c in columns)
    return grid.select(
        *keep,
        "fila",
        clean.normalise_currency(F.coalesce(name, F.lit("")), exact=True).alias("moneda"),
        clean.clean_amount(buy).alias("compra"),
        clean.clean_amount(sell).alias("venta"),
    )


def largest_nested(tables: Column, outer: Column) -> Column:
    """The nested table with most cells, the first of equals; the outer one without any."""
    nested = F.filter(
        tables, lambda t: (t["table_no"] > outer["table_no"]) & (t["table_no"] <= outer["last_inside"])
    )
    best = F.array_max(F.transform(nested, lambda t: F.struct(t["n_td"], -t["table_no"])))
    number = F.coalesce(-best.getField("col2"), outer["table_no"])
    return F.get(tables, number)


def body_rows(table: Column) -> Column:
    """Non-blank body rows, each as the first lines of its cells."""
    head_rows = F.size(F.filter(table["rows"], lambda r: r["in_head"]))
    after_head = F.slice(table["rows"], head_rows + 1, F.greatest(F.size(table["rows"]) - head_rows, F.lit(0)))
    rows = F.when(
        table["has_body"], F.filter(table["rows"], lambda r: r["in_body"])
    ).otherwise(after_head)
    return F.filter(
        F.transform(rows, lambda r: r["lines"]), lambda cells: F.exists(cells, lambda c: c != "")
    )


def row_labels(outer: Column) -> Column:
    """Label cells of the outer table, in page order; single-cell rows when it has none."""
    labels = F.transform(
        F.filter(
            outer["classed"], lambda c: (c["text"] != "") & has_class(c["css"], fixed.ROW_LABEL_CLASS)
        ),
        lambda c: c["text"],
    )
    single = F.filter(outer["rows"], lambda r: (r["n"] == 1) & (F.get(r["td"], F.lit(0)) != ""))
    return F.when(F.size(labels) > 0, labels).otherwise(
        F.transform(single, lambda r: F.get(r["td"], F.lit(0)))
    )


def align(df: DataFrame, names: str = "columnas", rows: str = "filas") -> DataFrame:
    """Make heading and rows the same length.

    One cell fewer than names: an entity (or blank) first name is dropped. One cell more:
    the first name and the first cell of every row are dropped. Rows are then cut or
    padded with blanks.
    """
    widest = F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))
    first = F.lower(F.trim(F.get(F.col(names), F.lit(0))))
    entity = first == ""
    for word in fixed.ENTITY_HEADER_WORDS:
        entity = entity | first.contains(word)
    measured = df.withColumn("_sobra", widest - F.size(names)).withColumn("_entidad", entity)
    drop_name = ((F.col("_sobra") == -1) & F.col("_entidad")) | (F.col("_sobra") == 1)
    drop_cell = F.col("_sobra") == 1
    tail = F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(0)))
    fitted = measured.withColumn("_corta", (F.size(names) > 0) & drop_name)
    fitted = fitted.withColumn("_corre", (F.size(names) > 0) & drop_cell)
    fitted = fitted.withColumn(names, F.when(F.col("_corta"), tail).otherwise(F.col(names)))
    width = F.size(names)

    def fit(row: Column) -> Column:
        kept = F.when(
            F.col("_corre"), F.slice(row, 2, F.greatest(F.size(row) - 1, F.lit(0)))
        ).otherwise(row)
        padded = F.concat(kept, F.array_repeat(F.lit(""), F.greatest(width - F.size(kept), F.lit(0))))
        return F.slice(padded, 1, width)

    return fitted.withColumn(rows, F.transform(rows, fit)).drop(
        "_sobra", "_entidad", "_corta", "_corre"
    )


def logical_tables(
    pages: DataFrame,
    keep: list[str],
    id_map: list[tuple] = fixed.LOGICAL_TABLES,
) -> DataFrame:
    """Deposit tables of a page, one row per known table id.

    Adds ``tabla, tipo_moneda, por_persona, columnas, filas, bancos``: the column names
    after alignment, the body rows and the label of each row. Labels are used only when
    there is one for every row; otherwise every bank is blank.
    """
    known = F.array(
        *[
            F.struct(
                F.lit(i).alias("id"), F.lit(name).alias("tabla"),
                F.lit(currency).alias("tipo_moneda"), F.lit(person).alias("por_persona"),
            )
            for i, name, currency, person in id_map
        ]
    )
    ids = F.transform("tables", lambda t: t["table_id"])
    located = F.filter(
        F.transform(known, lambda k: F.struct(k.alias("k"), F.array_position(ids, k["id"]).alias("n"))),
        lambda m: m["n"] > 0,
    )
    outer = pages.select(*keep, "tables", F.explode(located).alias("m")).select(
        *keep, "tables", "m.k.*", F.get("tables", F.col("m.n").cast("int") - 1).alias("afuera")
    )
    inner = outer.select(
        *keep, "tabla", "tipo_moneda", "por_persona", "afuera",
        largest_nested(F.col("tables"), F.col("afuera")).alias("adentro"),
    )
    read = inner.select(
        *keep, "tabla", "tipo_moneda", "por_persona",
        F.col("adentro.header_names").alias("nombres"),
        body_rows(F.col("adentro")).alias("filas"),
        row_labels(F.col("afuera")).alias("etiquetas"),
    )
    widest = F.coalesce(F.array_max(F.transform("filas", F.size)), F.lit(0))
    numbered = F.when(
        widest > 0, F.transform(F.sequence(F.lit(0), widest - 1), lambda i: F.concat(F.lit("col_"), i))
    ).otherwise(F.array().cast("array<string>"))
    named = read.withColumn(
        "columnas",
        F.when(F.coalesce(F.size("nombres"), F.lit(0)) > 0, F.col("nombres")).otherwise(numbered),
    ).drop("nombres")
    n_rows = F.size("filas")
    banks = F.when(F.size("etiquetas") == n_rows, F.col("etiquetas")).otherwise(
        F.array_repeat(F.lit(""), n_rows)
    )
    return align(named).withColumn("bancos", banks).drop("etiquetas")


def table_rows(tables: DataFrame, keep: list[str]) -> DataFrame:
    """One row per bank: ``banco`` and the cell texts in the order of ``columnas``."""
    zipped = F.transform(
        "filas", lambda r, i: F.struct(F.get("bancos", i).alias("banco"), r.alias("celdas"))
    )
    return tables.select(
        *keep, "tabla", "tipo_moneda", "por_persona", "columnas",
        F.posexplode(zipped).alias("fila", "r"),
    ).select(*keep, "tabla", "tipo_moneda", "por_persona", "columnas", "fila", "r.*")


def extraction_report(tables: DataFrame, keep: list[str]) -> DataFrame:
    """Rows and columns (the bank included) of every table read."""
    return tables.select(
        *keep, "tabla", F.size("filas").alias("n_filas"), (F.size("columnas") + 1).alias("n_columnas")
    )
