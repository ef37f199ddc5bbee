"""Table reading: headings, alignment and labels, with their known quirks."""

import gc

import pytest
from pyspark.sql import functions as F

from tidemark.functions import fixed, table_scan
from tidemark.operators import reshape, tables


def names_of(head):
    return table_scan.page_tables(f"<table><thead>{head}</thead></table>")[0][8]


@pytest.mark.parametrize(
    "head, want",
    [
        ("<tr><th>A</th><th colspan=2>B</th></tr><tr><th>x</th><th>y</th><th>z</th></tr>",
         ["A - x", "B - y", "B - z"]),
        ("<tr><th rowspan=2>A</th><th colspan='2'>B</th></tr><tr><th>x</th><th>y</th></tr>",
         ["A", "B - x", "B - y"]),
        # A blank cell widens the heading but holds no place: names move left.
        ("<tr><th></th><th>A</th><th>B</th></tr>", ["A", "B", "col_2"]),
        ("<tr><th>A</th></tr><tr><th>x</th><th>y</th></tr>", ["A - x"]),
        ("<tr><th>A</th><th>B</th></tr><tr><th>A</th><th>C</th></tr>", ["A", "B - C"]),
        ("", []),
    ],
)
def test_spanned_names(head, want):
    assert names_of(head) == want


def test_no_heading_gives_none():
    assert table_scan.page_tables("<table><tr><td>1</td></tr></table>")[0][8] is None


def test_scan_nesting_text_and_noise():
    html = (
        "<!-- <table><tr><td>no</td></tr></table> --><script>var t='<table>';</script>"
        "<div id='d'><table id=o class='k m'><tr><td>a <b>b</b>\nc<table id='i'><tr><td>x &amp; y"
        "<td>&nbsp;z&nbsp;</table></td><td rowspan=2>q<br>r</td></tr></table></div><table></table>"
    )
    outer, inner, empty = table_scan.page_tables(html)
    assert (outer[1], outer[2], outer[4]) == ("o", "k m", ["d"])
    assert (outer[3], inner[3], empty[3]) == (1, 1, 2) and empty[10] in (None, [])
    # The row around lists the nested cells too; text of a cell holds the nested text.
    assert outer[10][0][4] == ["abcx & yz", "x & y", "z", "qr"]
    assert inner[10][0][4] == ["x & y", "z"]
    assert outer[10][0][5][-1] == "q"
    assert outer[7] == 4 + 2 and inner[7] == 2


def test_first_body_section_only():
    html = "<table><tbody><tr><td>1</td></tr></tbody><tbody><tr><td>2</td></tr></tbody></table>"
    assert [r[1] for r in table_scan.page_tables(html)[0][10]] == [True, False]


def test_deep_nesting_is_linear():
    """Thousands of tables inside each other, all of them kept."""
    import time

    began = time.monotonic()
    found = table_scan.PageTables("<table><tr><td>x" * 20_000)
    assert len(found.tables) == len(found.cells) == 20_000
    assert found.tables[0].until[table_scan.DATA] == 20_000
    tables_of = table_scan.page_tables("<table><tr><td>x" * 800)
    assert [t[7] for t in tables_of] == [n * (n + 1) // 2 for n in range(800, 0, -1)]
    assert len(table_scan.page_cells("<table><tr><td>x" * 1600)) == 1600
    assert time.monotonic() - began < 20


def test_cells_once_each():
    cells = table_scan.page_cells("<table id=o><tr><td>a<table><tr><td>x<td>y</table><td>b</table>")
    assert [(c[0], c[3], c[5], c[7]) for c in cells] == [(0, 0, 0, "axy"), (1, 0, 0, "x"), (1, 0, 1, "y"), (0, 0, 1, "b")]


def aligned(spark, names, rows):
    df = spark.createDataFrame([(names, rows)], "columnas array<string>, filas array<array<string>>")
    out = tables.align(df).first()
    return out.columnas, [list(r) for r in out.filas]


@pytest.mark.parametrize(
    "names, rows, want_names, want_rows",
    [
        (["Empresa", "A", "B"], [["1", "2"]], ["A", "B"], [["1", "2"]]),
        (["", "A", "B"], [["1", "2"]], ["A", "B"], [["1", "2"]]),
        (["Otro", "A", "B"], [["1", "2"]], ["Otro", "A", "B"], [["1", "2", ""]]),
        # One cell too many: first name and first cells go, and one more cell is cut.
        (["A", "B"], [["x", "1", "2"], ["y", "3"]], ["B"], [["1"], ["3"]]),
        (["A", "B"], [["1", "2", "3", "4"], ["5"]], ["A", "B"], [["1", "2"], ["5", ""]]),
        (["A"], [], ["A"], []),
    ],
)
def test_align(spark, names, rows, want_names, want_rows):
    assert aligned(spark, names, rows) == (want_names, want_rows)


def mapping(spark, names):
    df = spark.createDataFrame([(names,)], "columnas array<string>")
    row = reshape.map_columns(df).first()
    return {m.destino: (m.origen, m.tipo) for m in row.mapa}


def test_exact_name_for_term_deposits(spark):
    got = mapping(spark, ["Banco", "Depósitos a Plazo - Hasta 30 días", "DEPOSITOS A PLAZO"])
    assert got["Depósitos a Plazo"] == ("DEPOSITOS A PLAZO", "keyword")
    assert got["Hasta 30 días"] == ("Depósitos a Plazo - Hasta 30 días", "keyword")


def test_positional_fallback_and_shared_source(spark):
    got = mapping(spark, ["Banco", "CTS ahorro", "uno", "dos"])
    assert got["Depósitos de Ahorro"] == got["Depósitos CTS"] == ("CTS ahorro", "keyword")
    assert got["Hasta 30 días"] == ("uno", "positional")
    assert got["31-90 días"] == ("dos", "positional")
    assert got["91-180 días"] == (None, None)


def test_canonical_names_map_to_themselves(spark):
    got = mapping(spark, reshape.TARGETS)
    assert got == {t: (t, "keyword") for t in reshape.TARGETS}


def test_person_halves(spark):
    df = spark.createDataFrame(
        [(["a", "b", "Más de 360 días x"], [["1", "2", "3"]])],
        "columnas array<string>, filas array<array<string>>",
    )
    got = {r.tipo_persona: (r.columnas, r.indices) for r in reshape.split_person(df).collect()}
    assert got == {
        "Natural": (["a"], [0]), "Jurídica": (["b", "Más de 360 días x"], [1, 2]),
    }
    one = spark.createDataFrame(
        [(["Natural - A", "otra"], [["1", "2"]])], "columnas array<string>, filas array<array<string>>"
    )
    assert [r.tipo_persona for r in reshape.split_person(one).collect()] == ["Natural"]


def test_grid_quirks(spark):
    html = (
        f"<div id='{fixed.GRID_ID}'><table class='rgMasterTable'><thead><tr><th>M</th><th> </th><th>M</th></tr>"
        "</thead><tr class='xrgRowx'><td>1</td><td>2</td></tr><tr class='rgRow'><td>1</td></tr></table></div>"
    )
    pages = tables.page_tables(spark.createDataFrame([(1, html), (2, "<p>")], "id int, html string"))
    grid = tables.class_grid(pages, ["id"])
    assert [r.campos for r in tables.grid_fields(grid, ["id"]).collect()] == [{"M": "2"}]
    assert grid.select(tables.grid_value("M").alias("v")).first().v == "2"
    assert grid.select(tables.grid_value("N").alias("v")).first().v is None


def test_deposit_pages_end_to_end(spark):
    from datetime import date

    from tidemark.sources import captures

    def page(table_id):
        return (
            f"<table id='{table_id}'><tr><td class='rpgRowHeaderField'>B</td><td><table><thead><tr>"
            "<th>Ahorro</th></tr></thead><tbody><tr><td>1.5</td></tr></tbody></table></td></tr></table>"
        )

    day = date(2025, 1, 2)
    foreign_ok, foreign_late = "Moneda Extranjera al 02/01/2025", "Moneda Extranjera al 31/12/2024"
    rows = [
        (day, "al 02/01/2025", page(fixed.NATIONAL_IDS[0]), foreign_ok, page(fixed.FOREIGN_IDS[0])),
        (day, None, page(fixed.NATIONAL_IDS[0]), foreign_late, page(fixed.FOREIGN_IDS[0])),
        (day, "al 31/12/2024", page(fixed.NATIONAL_IDS[0]), foreign_ok, page(fixed.FOREIGN_IDS[0])),
    ]
    df = spark.createDataFrame(
        rows, "requested_date date, label_text string, html string, label_foreign string, html_foreign string"
    )
    general, person = captures.deposit_rates(df)
    found = general.filter(F.col("bucket") == "Depósitos de Ahorro").collect()
    assert sorted((r.tipo_moneda, r.banco, r.valor) for r in found) == [
        (fixed.FOREIGN, "B", 1.5), (fixed.NATIONAL, "B", 1.5), (fixed.NATIONAL, "B", 1.5),
    ]
    assert person.count() == 0


def test_every_cell_of_every_table(spark):
    """Rows wider than any reader needs, in tables nobody names, come back whole."""
    wide = "".join(f"<td>c{i}<br>x</td>" for i in range(9))
    html = f"<table><tr><td>a</td></tr></table><table><tr>{wide}</tr><tr><td><table><tr>{wide}</tr></table></td></tr></table>"
    pages = tables.page_tables(spark.createDataFrame([(1, html)], "id int, html string"), every=True).first().tables
    assert [len(t.rows) for t in pages] == [1, 3, 1]
    for row in (pages[1].rows[0], pages[2].rows[0]):
        assert row.lines == [f"c{i}" for i in range(9)] and len(row.td) == row.n == 9
    few = tables.page_tables(spark.createDataFrame([(1, html)], "id int, html string")).first().tables
    assert few[1].rows is None and few[0].rows[0].td == ["a"]


def test_equal_tags_are_read_once_and_few_are_kept(monkeypatch):
    """Pages repeat their tags: attributes are parsed once for each different one, and what is kept is bounded."""
    parsed = []
    original = table_scan.attributes
    monkeypatch.setattr(table_scan, "attributes", lambda text: parsed.append(text) or original(text))
    html = "<table>" + "<tr class='zz'><td class=\"a>b\" rowspan=2>x</td></tr>" * 500 + "</table>"
    rows = table_scan.page_tables(html)[0][10]
    assert len(rows) == 500 and rows[499][2] == "zz" and rows[499][4] == ["x"]
    assert parsed.count(" class='zz'") == 1
    many = "<table>" + "".join(f"<tr class='n{i}'><td>{i}</td></tr>" for i in range(table_scan.HEADS_KEPT + 500)) + "</table>"
    assert [r[2] for r in table_scan.page_tables(many)[0][10]][-1] == f"n{table_scan.HEADS_KEPT + 499}"
    assert len(table_scan.heads_met) <= table_scan.HEADS_KEPT


def test_no_cycle_search_while_pages_are_read(monkeypatch):
    """It took a fifth of the scan; nothing that is read of a page needs it."""
    page = "<table><thead><tr><th>a</th></tr></thead><tbody><tr><td>1<br>2</td><td><table><tr><td>x\ny</td></tr></table></td></tr></tbody></table>"
    want = [table_scan.page_tables(page)] * 3
    searched = []
    scan = table_scan.scan
    monkeypatch.setattr(table_scan, "scan", lambda html: searched.append(gc.isenabled()) or scan(html))
    assert table_scan.read_pages("page_tables", [page] * 3, ()) == want
    assert searched == [False] * 3 and gc.isenabled()
    # No cycle is left behind either: counts free a page at once.
    gc.collect()
    gc.disable()
    try:
        scan(page)
        table_scan.page_cells(page)
        assert gc.collect() == 0
    finally:
        gc.enable()


def test_a_layout_is_worked_out_once(monkeypatch):
    """Pages that differ in their texts only share the places of their cells; blank texts and new headings are their own."""
    page = "<table><thead><tr><th>{0}</th><th>b</th></tr></thead><tr><td>{1}<br>{2}</td><td class='rpgRowHeaderField'>{3}</td></tr></table>"
    some = [("a", "1", "2", "3"), ("", "&nbsp;", "x\ny", ""), ("c", "", "", "&amp;"), ("a", "1", "2", "3")]
    pages = [page.format(*texts) for texts in some]
    made = []
    layout = table_scan.Layout
    monkeypatch.setattr(table_scan, "Layout", lambda tags: made.append(tags) or layout(tags))
    monkeypatch.setattr(table_scan, "layouts_met", {})
    found = [table_scan.page_tables(p)[0] for p in pages]
    assert len(made) == 1
    assert [t[8] for t in found] == [["a", "b"], ["b", "col_1"], ["c", "b"], ["a", "b"]]
    assert [t[9] for t in found] == [[("rpgRowHeaderField", x)] for x in ("3", "", "&", "3")]
    assert [t[10][1][4:6] for t in found] == [
        (["12", "3"], ["1", "3"]), (["x\ny", ""], ["x", ""]), (["", "&"], ["", "&"]), (["12", "3"], ["1", "3"]),
    ]
    for i in range(table_scan.LAYOUTS_KEPT + 5):
        table_scan.page_cells("<table><tr>" + "<td>x" * i)
    assert len(table_scan.layouts_met) <= table_scan.LAYOUTS_KEPT


def test_no_table_but_in_a_comment():
    assert table_scan.page_tables("<!-- <table> --><p>") == [] == table_scan.page_cells("<!-- <table> --><p>")


def test_cells_of_some_fields_and_of_many_pages(spark):
    """Pages of several layouts in one batch, more cells than one batch gives out, a page's column named like a cell's."""
    wide = "<table id=w><tr>" + "".join(f"<td rowspan={n}>{n}</td>" for n in range(20_000)) + "</tr></table>"
    pages = [(1, "<table><tr><th>a</th></tr></table>"), (2, wide), (3, None), (4, "<p>"), (5, "<table><tr><td>b<td>c</table>")]
    df = spark.createDataFrame(pages, "row int, html string").coalesce(1)
    cells = tables.html_cells(df.withColumnRenamed("row", "table_id"), ["table_id"])
    got = cells.toDF("page", *cells.columns[1:]).select("page", "table_id", "tag", "col", "rowspan", "text").collect()
    assert got == (
        [(1, None, "th", 0, 1, "a")] + [(2, "w", "td", n, n, str(n)) for n in range(20_000)]
        + [(5, None, "td", 0, 1, "b"), (5, None, "td", 1, 1, "c")]
    )
    few = tables.html_cells(df, ["row"], fields=["text", "col"])
    assert few.columns == ["row", "text", "col"]
    assert few.filter("row <> 2").collect() == [(1, "a", 0), (5, "b", 0), (5, "c", 1)]


def test_blank_texts_inside_many_cells_are_met_once():
    import time

    began = time.monotonic()
    assert len(table_scan.page_cells("<table><tr><td> \n" * 20_000)) == 20_000
    row = "<tr>" + "<td><br>a<br>b</td>" * 20_000
    assert table_scan.page_tables("<table>" + row)[0][10][0][4:6] == (["ab"] * 20_000, ["a"] * 20_000)
    assert time.monotonic() - began < 10


def test_equal_spare_names_and_rows_after_the_heading(spark):
    df = spark.createDataFrame([([fixed.BANK, "x", "x", "CTS", None],)], "columnas array<string>")
    mapped = reshape.map_columns(df).first().mapa
    assert [(m.origen, m.tipo) for m in mapped] == [
        (fixed.BANK, "keyword"), ("x", "positional"), ("x", "positional"), (None, None), *[(None, None)] * 4, ("CTS", "keyword"),
    ]
    html = "<table><thead><tr><th>h</th></tr></thead><tr><td>1</td></tr><tr><td>2</td></tr></table>"
    pages = tables.page_tables(spark.createDataFrame([(1, html)], "id int, html string"))
    assert pages.select(tables.body_rows(F.get("tables", F.lit(0))).alias("r")).first().r == [["1"], ["2"]]
