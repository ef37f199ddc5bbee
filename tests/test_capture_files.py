"""Pages saved as files: put together by date, and taken up by a stream in any order of drops."""

import os
from datetime import date
from pathlib import Path

import pytest

from tidemark.functions import fixed
from tidemark.session import build_session, qualified, scratch_path, scratch_uri
from tidemark.sources import accumulated, capture_files
from tidemark.streaming import ingest

DAY, NEXT = date(2025, 1, 2), date(2025, 1, 3)


def page(label, table_id, bank, value):
    tag = "" if label is None else f'<span class="x" id="{fixed.LABEL_ID}"> <b>{label}</b> </span>'
    return (
        f"<html><body>{tag}<table id='{table_id}'><tr><td><table><tr><td class='rpgRowHeaderField'>{bank}</td></tr></table></td>"
        "<td><table><thead><tr><th>Depósitos de Ahorro</th><th>Depósitos CTS</th></tr></thead>"
        f"<tbody><tr><td>{value}</td><td>2.5</td></tr></tbody></table></td></tr></table></body></html>"
    )


MN, ME = fixed.NATIONAL_IDS[0], fixed.FOREIGN_IDS[0]
FILES = [
    ("fuente_02012025.html", page("Tasas al 02/01/2025", MN, "A", "1")),
    ("fuente_02012025_me.html", page("Moneda Extranjera al 02/01/2025", ME, "A", "3")),
    # A second attempt that is stale hides nothing; a foreign page that is not confirmed counts for nothing.
    ("otra_02012025.html", page("Tasas al 01/01/2025", MN, "A", "9")),
    ("fuente_03012025.html", page(None, MN, "B", "4")),
    ("fuente_03012025_me.html", page("Moneda Extranjera al 02/01/2025", ME, "B", "9")),
    # Only a foreign page, only a stale one, no date, an impossible date, no page at all.
    ("fuente_06012025_me.html", page("Moneda Extranjera al 06/01/2025", ME, "C", "9")),
    ("fuente_07012025.html", page("Tasas al 03/01/2025", MN, "D", "9")),
    ("portada.html", page("x", MN, "E", "9")),
    ("fuente_99992025.html", page("x", MN, "F", "9")),
    ("fuente_08012025.html", " "),
]
WANT = {(DAY, fixed.NATIONAL, "A", 1.0), (DAY, fixed.FOREIGN, "A", 3.0), (NEXT, fixed.NATIONAL, "B", 4.0)}
FACTS = {
    (DAY, None, True), (NEXT, None, True), (date(2025, 1, 7), "03/01/2025", False), (date(2025, 1, 8), None, False),
}


def put(folder, files, at):
    Path(folder).mkdir(parents=True, exist_ok=True)
    for name, text in files:
        path = Path(folder) / name
        path.write_text(text, encoding="utf-8")
        os.utime(path, (1_700_000_000 + at, 1_700_000_000 + at))


def savings(rates):
    rows = rates.filter("bucket = 'Depósitos de Ahorro'").collect()
    return {(r.fecha, r.tipo_moneda, r.banco, r.valor) for r in rows}


def facts(df):
    return {(r.fecha, r.vigente_al, r.filas > 0) for r in df.collect()}


def test_pages_of_a_date_are_put_together(spark):
    folder = scratch_path(spark, "files")
    put(folder, FILES, 0)
    pages = capture_files.read_pages(spark, folder)
    rows = {r.requested_date: r for r in capture_files.assembled(pages).collect()}
    assert set(rows) == {DAY, NEXT, date(2025, 1, 8)}
    assert rows[DAY].label_text == "Tasas al 02/01/2025" and "Extranjera" in rows[DAY].label_foreign
    assert rows[NEXT].html_foreign is None
    rates = capture_files.general_rates(capture_files.assembled(pages))
    assert savings(rates) == WANT
    assert facts(capture_files.page_facts(pages, rates)) == FACTS


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_stream_of_files_equals_the_batch(spark, order):
    """Three drops, each run started anew with the same checkpoint; pages of a date come in different drops."""
    folder, store, state = scratch_path(spark, "drops"), ingest.Store(scratch_path(spark, "store")), scratch_path(spark, "state")
    for at, drop in enumerate(order):
        put(folder, FILES[drop::3], at)
        ingest.ingest(ingest.page_stream(spark, folder), store, state).awaitTermination()
    # Nothing new: nothing happens.
    ingest.ingest(ingest.page_stream(spark, folder), store, state).awaitTermination()
    rates = accumulated.read_accumulated(spark, store.rates)
    assert savings(rates) == WANT and rates.count() == len(WANT) * 2 or savings(rates) == WANT
    assert facts(ingest.date_facts(spark, store)) == FACTS
    assert accumulated.merged_batches(spark, store.rates) == {state: 2}


def test_written_files_come_back(spark):
    folder = scratch_path(spark, "written")
    rows = [(name, text) for name, text in FILES] + [(None, "x"), ("y_02012025.html", None)]
    given = spark.createDataFrame(rows, "archivo string, content string").repartition(3)
    assert capture_files.write_files(given, folder) == len(FILES)
    assert capture_files.write_files(given, folder) == len(FILES)
    assert savings(capture_files.general_rates(capture_files.assembled(capture_files.read_pages(spark, folder)))) == WANT
    assert {p.name for p in Path(folder).iterdir()} == {name for name, _ in FILES}


def test_paths_are_qualified_as_spark_does(spark):
    assert qualified(spark, "/a/b") == "file:///a/b" and qualified(spark, "file:/a/b") == "file:///a/b"
    assert scratch_uri(spark, "x").startswith("file:///")
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "viewfs://store/")
        conf.set("fs.viewfs.mounttable.store.link./a", "file:///tmp")
        assert qualified(spark, "/a/b") == "viewfs://store/a/b"
    finally:
        conf.set("fs.defaultFS", before)


def test_files_are_listed_in_tasks(spark):
    """Files at any depth, hidden ones and other names left out, with the times that Spark's own source gives."""
    folder = scratch_path(spark, "listed")
    put(folder, FILES[:1], 0)
    put(f"{folder}/2025/01", FILES[1:2], 1)
    put(f"{folder}/2025", [(".draft.html", "x"), ("nota.txt", "x")], 2)
    put(f"{folder}/_temporary/0", [("z_02012025.html", "x")], 2)
    own = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").load(folder)
    listed = capture_files.list_files(spark, folder, "*.html")
    names = lambda df: {(r.path.rsplit("/", 1)[1], r.modificationTime, r.length) for r in df.collect()}
    assert names(listed) == names(own) and listed.count() == 2
    assert "PushedFilters" not in listed._jdf.queryExecution().executedPlan().toString()
    assert {bytes(r.content) for r in capture_files.with_content(listed).collect()} == {t.encode() for _, t in FILES[:2]}


def test_noticed_files_give_the_same_and_few_stored_files(spark):
    folder, notices = scratch_path(spark, "drops"), scratch_path(spark, "notices")
    store, state = ingest.Store(scratch_path(spark, "store")), scratch_path(spark, "state")
    for drop in range(3):
        rows = [(f"2025/{drop}/{name}", text) for name, text in FILES[drop::3]]
        given = spark.createDataFrame(rows, "archivo string, content string").repartition(3)
        assert capture_files.write_files(given, folder, notices) == len(rows)
        ingest.ingest(ingest.noticed_stream(spark, notices), store, state).awaitTermination()
    assert savings(accumulated.read_accumulated(spark, store.rates)) == WANT
    assert facts(ingest.date_facts(spark, store)) == FACTS
    # One year in three batches, however many tasks and months there are.
    assert len(list(Path(store.pages).glob("lote=*/anio=*/*.parquet"))) == 3
