"""Seeds and fills: fixed small cases, and a day-by-day walk as brute force."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import calendar as cal
from tidemark.operators import series

SCHEMA = "fecha date, codigo string, moneda string, compra double, venta double, ord long"
START, END = date(2025, 3, 3), date(2025, 3, 20)


def quotes(spark, rows):
    return spark.createDataFrame([(d, "C", m, c, v, o) for d, m, c, v, o in rows], SCHEMA)


def seed_of(spark, history, **kw):
    found = series.find_seeds(quotes(spark, [(d, "A", c, v, 0) for d, c, v in history]), START, **kw)
    rows = found.collect()
    return (rows[0]["compra"], rows[0]["venta"]) if rows else None


def ago(n):
    return START - timedelta(days=n)


@pytest.mark.parametrize(
    "history, want",
    [
        ([(ago(5), 1.0, 2.0), (ago(2), None, 3.0)], (1.0, 3.0)),  # newer venta is met first
        ([(ago(5), 1.0, None), (ago(9), 7.0, 8.0)], (1.0, None)),  # older venta is not reached
        ([(ago(5), 1.0, 2.0)], (1.0, 2.0)),
        ([(ago(4), None, 2.0)], (None, 2.0)),  # no compra at all: the walk goes on
        ([(ago(46), 1.0, 2.0)], (1.0, 2.0)),
        ([(ago(47), 1.0, 2.0)], None),
        ([(ago(0), 1.0, 2.0)], None),
    ],
)
def test_seed_range_variant(spark, history, want):
    assert seed_of(spark, history) == want


def test_seed_day_variant(spark):
    saturday = date(2025, 3, 1)
    assert seed_of(spark, [(saturday, 5.0, 6.0), (ago(5), 1.0, 2.0)],
                   lookback_days=45, skip_weekends=True) == (1.0, 2.0)
    # Day 45 back is in, day 46 is not; a holiday is read like any day.
    assert seed_of(spark, [(ago(45), 1.0, 2.0)], lookback_days=45, skip_weekends=True) is not None
    assert seed_of(spark, [(ago(46), 1.0, 2.0)], lookback_days=45, skip_weekends=True) is None


def test_needs_seed(spark):
    rows = quotes(spark, [
        (START, "A", None, 1.0, 0), (ago(-1), "A", 2.0, 1.0, 1),
        (ago(-3), "B", None, 1.0, 2),  # first reported row counts, even after the start
        (START, "C", 1.0, None, 3),
    ])
    chosen = spark.createDataFrame([("A",), ("C",), ("D",)], "moneda string")
    present = {r.moneda for r in series.needs_seed(rows, START, END).collect()}
    every = {r.moneda for r in series.needs_seed(rows, START, END, chosen).collect()}
    assert present == {"A", "B"}
    assert every == {"A", "D"}


def walk(rows, lookback, skip_weekends):
    """Independent day-by-day fill."""
    out = {}
    for name in {m for d, m, *_ in rows if START <= d <= END}:
        own = {d: (c, v) for d, m, c, v, _ in rows if m == name}
        inside = sorted(d for d in own if START <= d <= END)
        base = [None, None]
        if own[inside[0]][0] is None:
            for back in range(1, lookback + 1):
                day = ago(back)
                if day not in own or (skip_weekends and day.weekday() >= 5):
                    continue
                for i in (0, 1):
                    if base[i] is None:
                        base[i] = own[day][i]
                if base[0] is not None:
                    break
            if base[0] is None:
                base = [None, None]
        for i in (0, 1):
            days = [START + timedelta(days=n) for n in range((END - START).days + 1)]
            value, column = base[i], []
            for day in days:
                got = own.get(day, (None, None))[i]
                value = value if got is None else got
                column.append(value)
            first = next((v for v in column if v is not None), None)
            column = [first if v is None else v for v in column]
            for day, v in zip(days, column):
                out.setdefault((name, day), [None, None])[i] = v
    return out


@pytest.mark.parametrize("seed, skip", [(1, False), (2, True), (3, False), (4, True)])
def test_fill_with_seeds_equals_walk(spark, seed, skip):
    rng = random.Random(seed)
    lookback = 45 if skip else 46
    rows = [
        (ago(n), name, rng.choice([None, rng.random()]), rng.choice([None, rng.random()]), i)
        for i, name in enumerate("ABCDEFGH")
        for n in rng.sample(range(-17, 60), rng.randint(1, 12))
    ]
    got = series.fill_with_seeds(quotes(spark, rows), START, END, lookback, skip)
    assert {(r.moneda, r.fecha): [r.compra, r.venta] for r in got.collect()} == walk(rows, lookback, skip)


def test_seed_table_gives_the_same_as_one_pass(spark):
    rows = quotes(spark, [
        (ago(3), "A", 1.5, None, 0), (ago(-2), "A", None, 4.0, 1), (ago(-5), "A", 9.0, None, 2),
        (ago(2), "B", 7.0, 7.0, 3), (START, "B", 1.0, 1.0, 4), (ago(1), "Z", 1.0, 1.0, 5),
    ])
    wanted = series.needs_seed(rows, START, END)
    seeds = series.find_seeds(rows, START).join(wanted, "moneda", "left_semi")
    joined = series.fill(rows, START, END, seeds)
    direct = series.fill_with_seeds(rows, START, END)
    assert sorted(joined.collect()) == sorted(direct.collect())
    assert {r.moneda for r in direct.select("moneda").distinct().collect()} == {"A", "B"}


def test_fill_properties(spark):
    rows = quotes(spark, [(ago(-n), m, float(n), None, n) for m in "AB" for n in (0, 4, 9)])
    filled = series.fill(rows, START, END)
    days = (END - START).days + 1
    assert filled.count() == 2 * days
    again = series.fill(filled, START, END)
    assert sorted(map(str, again.collect())) == sorted(map(str, filled.collect()))
    kept = filled.join(rows.select("fecha", "moneda", F.col("compra").alias("x")), ["fecha", "moneda"])
    assert kept.filter("compra = x").count() == 6
    assert filled.filter("venta IS NOT NULL").count() == 0  # nothing to fill from stays empty
    gaps = series.densify(rows, START, END)
    assert gaps.count() == 2 * days and gaps.filter("compra IS NOT NULL").count() == 6


def test_two_quotes_for_one_day_fail(spark):
    rows = quotes(spark, [(START, "A", 1.0, 1.0, 0), (START, "A", 2.0, 2.0, 1)])
    with pytest.raises(Exception, match="two quotes for one day"):
        series.fill(rows, START, END).count()


def test_hot_currency_and_order(spark):
    """One currency with nearly all days next to many with one row each."""
    rows = [(START + timedelta(days=n), "HOT", float(n), 1.0, n) for n in range(18)]
    rows += [(START, f"M{n:03d}", 1.0, 1.0, 100 + n) for n in range(200)]
    out = series.ordered(series.fill(quotes(spark, rows), START, END)).collect()
    assert len(out) == 201 * 18
    assert [r.moneda for r in out[:3]] == ["HOT", "M000", "M001"]


def test_calendar(spark):
    with pytest.raises(ValueError):
        cal.date_spine(spark, END, START)
    spine = cal.date_spine(spark, date(2025, 1, 1), date(2025, 12, 31))
    assert spine.count() == 365
    table_days = cal.holiday_table(spark, 2025, 2025)
    assert table_days.count() == 16
    by_table = cal.business_days(spine, custom_holidays=table_days)
    by_rule = cal.business_days(spine)
    assert sorted(by_table.collect()) == sorted(by_rule.collect())
    assert date(2025, 4, 18) not in {r.fecha for r in by_rule.collect()}
