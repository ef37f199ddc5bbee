"""Upsert rules, the accumulated table and exports."""

import json
from datetime import date
from pathlib import Path

import pytest

from tidemark.functions import clean
from tidemark.operators import ledger, merge
from tidemark.session import scratch_path
from tidemark.sources import accumulated

KEYS = merge.GENERAL_KEYS
SCHEMA = "fecha date, tipo_moneda string, banco string, v double"
D1, D2, D3 = date(2025, 1, 31), date(2025, 2, 1), date(2025, 3, 1)


def rows_of(df, *cols):
    return sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect())))


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def test_null_and_blank_keys_are_one_key(spark):
    old = frame(spark, [(D1, "MN", None, 1.0), (D1, "MN", "", 2.0), (D1, "MN", "A", 3.0), (None, "MN", "A", 4.0)])
    new = frame(spark, [(D1, "MN", "", 9.0), (None, "MN", "A", 8.0)])
    out = merge.upsert(old, new, KEYS)
    assert sorted(r.v for r in out.collect()) == [3.0, 8.0, 9.0]


def test_text_dates_match_dates_and_batch_keeps_repeats(spark):
    old = frame(spark, [(D1, "MN", "A", 1.0), (D2, "MN", "A", 2.0)])
    new = frame(spark, [("31/1/2025", "MN", "A", 7.0), ("31/01/2025", "MN", "A", 8.0)],
                "fecha string, tipo_moneda string, banco string, v double")
    out = merge.upsert(old, new, KEYS)
    assert rows_of(out, "fecha", "v") == sorted(map(repr, [(D2, 2.0), (D1, 7.0), (D1, 8.0)]))


def test_extra_and_missing_columns(spark):
    old = frame(spark, [(D1, "MN", "A", 1.0)])
    extra = frame(spark, [(D2, "MN", "A", 1.0, "x")], SCHEMA + ", nota string")
    assert merge.upsert(old, extra, KEYS).columns == ["fecha", "tipo_moneda", "banco", "v", "nota"]
    # Key column missing on one side: plain append, nothing is replaced.
    keyless = frame(spark, [(D1, "MN", 5.0)], "fecha date, tipo_moneda string, v double")
    assert merge.upsert(old, keyless, KEYS).count() == 2


def test_ordered_puts_missing_dates_last(spark):
    df = frame(spark, [(None, "MN", "A", 1.0), (D2, "MN", "B", 2.0), (D2, "MN", "A", 3.0), (D1, "MN", "A", 4.0)])
    assert [r.v for r in merge.ordered(df, KEYS).collect()] == [4.0, 3.0, 2.0, 1.0]


def test_accumulated_table(spark):
    path = scratch_path(spark, "acc")
    assert accumulated.read_accumulated(spark, path) is None
    first = frame(spark, [(D1, "MN", "A", 1.0), (D3, "MN", "A", 3.0), (None, "MN", "A", 0.0)])
    assert accumulated.write_accumulated(first.limit(0), path, KEYS) == "no_rows"
    assert accumulated.write_accumulated(first, path, KEYS) == "written"
    untouched = accumulated.month_folders(spark, path)["2025-03"]
    batch = frame(spark, [(D1, "MN", "A", 5.0), (D2, "MN", "A", 2.0), (None, "MN", "A", 6.0)])
    for _ in range(2):  # again after a cut-off run: the same table
        assert accumulated.write_accumulated(batch, path, KEYS) == "written"
        got = accumulated.read_accumulated(spark, path)
        assert sorted(r.v for r in got.collect()) == [2.0, 3.0, 5.0, 6.0]
    assert accumulated.month_folders(spark, path)["2025-03"] == untouched
    accumulated.remove_old_versions(spark, path)
    assert sorted(r.v for r in accumulated.read_accumulated(spark, path).collect()) == [2.0, 3.0, 5.0, 6.0]


def test_merge_cut_off_before_it_is_published(spark, monkeypatch):
    path = scratch_path(spark, "acc")
    accumulated.write_accumulated(frame(spark, [(D1, "MN", "A", 1.0), (D3, "MN", "A", 3.0)]), path, KEYS)
    batch = frame(spark, [(D1, "MN", "A", 5.0), (D2, "MN", "A", 2.0)])

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as cut, pytest.raises(RuntimeError):
        cut.setattr(accumulated, "_publish", stop)
        accumulated.write_accumulated(batch, path, KEYS)
    # A list that was begun and not finished does not count either.
    Path(path, "indice", "2").mkdir()
    assert sorted(r.v for r in accumulated.read_accumulated(spark, path).collect()) == [1.0, 3.0]
    accumulated.write_accumulated(batch, path, KEYS)
    assert sorted(r.v for r in accumulated.read_accumulated(spark, path).collect()) == [2.0, 3.0, 5.0]


def test_accumulated_table_takes_a_new_column(spark):
    path = scratch_path(spark, "acc")
    accumulated.write_accumulated(frame(spark, [(D1, "MN", "A", 1.0), (D3, "MN", "A", 3.0)]), path, KEYS)
    extra = frame(spark, [(D1, "MN", "B", 2.0, "x")], SCHEMA + ", nota string")
    accumulated.write_accumulated(extra, path, KEYS)
    later = frame(spark, [(D1, "MN", "C", 5.0), (D3, "MN", "A", 4.0)])
    accumulated.write_accumulated(later, path, KEYS)
    got = {(r.fecha, r.banco): (r.v, r.nota) for r in accumulated.read_accumulated(spark, path).collect()}
    assert got == {
        (D1, "A"): (1.0, None), (D1, "B"): (2.0, "x"), (D1, "C"): (5.0, None), (D3, "A"): (4.0, None),
    }


def test_latest_per_key_with_one_hot_key(spark):
    df = spark.range(5000).selectExpr(
        "if(id % 3 > 0, 'hot', cast(id as string)) AS k", "id AS llegada", "id * 2 AS v"
    )
    out = merge.latest_per_key(df, ["k"], "llegada")
    assert out.count() == 1 + 1667
    assert out.filter("k = 'hot'").first().v == 4999 * 2


def test_exports(spark):
    folder = scratch_path(spark, "out")
    df = frame(spark, [(D1, "MN", "Ñandú", None), (date(2024, 12, 31), "MN", "B", 1.0)])
    path = accumulated.export_series(df, folder, "weighted", date(2024, 12, 31), D1)
    assert path.endswith("/TipoCambioPonderado_31122024_31012025")
    assert {p.name for p in Path(path).glob("anio=*")} == {"anio=2024", "anio=2025"}
    assert accumulated.export_name("general", D1, D2) == "TPF_General_31012025-01022025"
    lines = f"{folder}/lines"
    accumulated.write_json_lines(df, lines)
    text = "".join(p.read_text(encoding="utf-8") for p in Path(lines).glob("*.json"))
    assert "Ñandú" in text and len(text.strip().split("\n")) == 2
    assert json.loads([t for t in text.split("\n") if "Ñandú" in t][0])["v"] is None


def test_date_status_order(spark):
    spine = frame(spark, [(date(2025, 4, d),) for d in (17, 18, 19, 21, 22, 23, 24)], "fecha date")
    facts = frame(
        spark,
        [(date(2025, 4, 21), True, "x", 1), (date(2025, 4, 22), False, "18/04/2025", 1),
         (date(2025, 4, 23), False, None, 0), (date(2025, 4, 24), False, None, 3),
         (date(2025, 4, 18), True, None, 1)],
        "fecha date, fallo boolean, vigente_al string, filas long",
    )
    out = [(r.fecha.day, r.estado) for r in ledger.date_status(spine, facts).orderBy("fecha").collect()]
    assert out == [
        (17, "feriado"), (18, "feriado"), (19, "fin de semana"), (21, "error"),
        (22, "no vigente"), (23, "sin datos"), (24, "ok"),
    ]


def test_amounts(spark):
    df = spark.createDataFrame(
        [("1,234.5678",), (" ",), (" - ",), ("S/M",), ("nan",), ("1e3",), (".5",), ("1,",), (None,)], "t string"
    )
    got = [r[0] for r in df.select(clean.clean_amount(df.t)).collect()]
    assert got == [1234.5678, None, None, None, None, 1000.0, 0.5, 1.0, None]
    pairs = [tuple(r[0]) for r in df.select(clean.clean_rate(df.t)).collect()]
    assert pairs[3] == (None, "S/M") and pairs[4] == (None, "nan") and pairs[2] == (None, None)
