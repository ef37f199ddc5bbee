"""As-of join against a plain walk, with hot entities, ties, NULLs and look-back bounds."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join

START = dt.datetime(2024, 1, 1)
VALUES = "moneda string, ts timestamp, n int, compra double, venta double"
PROBES = "id long, moneda string, cuando timestamp, n string"


def rows(seed=1):
    rnd = random.Random(seed)
    names = ["hot"] * 6 + ["a", "b", None, "sin"]

    def moment():
        return None if rnd.random() < 0.03 else START + dt.timedelta(hours=rnd.randint(0, 400))

    values = [
        (rnd.choice(names[:9]), moment(), i, rnd.choice([None, float(rnd.randint(1, 99))]), rnd.choice([None, float(i)]))
        for i in range(600)
    ]
    probes = [(i, rnd.choice(names), moment(), "x") for i in range(300)] + [(1, "hot", START, "x")] * 2
    return values, probes


def brute(values, probes, strict, lookback):
    out = []
    for id_, name, when, n in probes:
        found = []
        for m in (3, 4):
            best = [
                (v[1], v[2], v[m]) for v in values
                if v[0] == name and v[1] is not None and v[m] is not None and when is not None
                and (v[1] < when if strict else v[1] <= when)
            ]
            top = max(best, default=None)
            if top and lookback is not None and (when - top[0]).total_seconds() > lookback:
                top = None
            found += [top[2], top[0]] if top else [None, None]
        out.append((id_, name, when, n, *found))
    return sorted(out, key=repr)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("block, lookback", [("day", None), ("month", 36 * 3600), ("hour", 1)])
def test_asof_against_a_walk(spark, strict, block, lookback):
    values, probes = rows()
    made = asof_join(
        spark.createDataFrame(probes, PROBES).repartition(3), spark.createDataFrame(values, VALUES).repartition(3),
        ["moneda"], "cuando", "ts", ["compra", "venta"], block=block, lookback_seconds=lookback, strict=strict, tie=["n"],
    )
    assert made.columns == ["id", "moneda", "cuando", "n", "compra", "compra_desde", "venta", "venta_desde"]
    assert sorted((tuple(r) for r in made.collect()), key=repr) == brute(values, probes, strict, lookback)


def test_asof_of_empty_sides_and_clashes(spark):
    values, probes = rows()
    v, p = spark.createDataFrame(values, VALUES), spark.createDataFrame(probes, PROBES)
    args = (["moneda"], "cuando", "ts", ["compra"])
    assert asof_join(p.limit(0), v, *args).count() == 0
    alone = asof_join(p, v.limit(0), *args)
    assert alone.count() == len(probes) and alone.filter("compra IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        asof_join(p.withColumn("compra", F.lit(1)), v, *args)


def test_a_hot_entity_is_many_groups(spark):
    """No window runs over a whole entity's rows: all are by entity and block, or over one row per block."""
    values, probes = rows()
    made = asof_join(
        spark.createDataFrame(probes, PROBES), spark.createDataFrame(values, VALUES), ["moneda"], "cuando", "ts", ["compra"]
    )
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in made._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line and "windowspecdefinition" in line]
    assert len(windows) == 2 and sum("_b#" in line.split("], [")[-2] for line in windows) >= 1
