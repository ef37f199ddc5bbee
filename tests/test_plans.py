"""What the plans of the main operators must look like."""

import re

import pytest

from __spark_entry__ import queries

SF_DIR = "/root/testdata/sf0.001"
WRITES = {
    "idle_sessions_stream", "first_per_url_stream", "upsert_stream", "gated_ingest_stream",
    "accumulated_batches",
}


def plan(spark, name):
    return queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [q for q in queries() if q not in WRITES])
def test_no_cross_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_fill_reads_once_and_shuffles_days_then_currencies(spark):
    text = plan(spark, "fill_with_seeds")
    assert text.count("FileScan") == 1
    # Stand-in aggregate, per-day check, per-currency windows.
    assert len(re.findall(r"Exchange hashpartitioning\(", text)) == 3
    assert "Join" not in text


def test_extraction_does_not_shuffle_cells(spark):
    text = plan(spark, "pivot_rows_roundtrip")
    assert len(re.findall("Exchange", text)) <= 1  # spreading the small input
    assert text.count("MapInArrow") == 1


def test_date_range_reaches_the_scan(spark):
    text = plan(spark, "seed_range_46")
    assert re.search(r"DataFilters: \[[^\]]*o_orderdate", text)
    assert "o_orderpriority" not in text


def test_lookups_broadcast_only_the_fixed_dimension(spark):
    text = plan(spark, "iso_lookup_ci")
    assert "BroadcastHashJoin" in text and "LocalTableScan" in text


def test_holiday_rule_needs_no_join(spark):
    assert "Join" not in plan(spark, "business_days")


@pytest.mark.parametrize("name", ["pivot_rows_roundtrip", "canonical_projection"])
def test_column_mapping_is_not_repeated_per_measure(spark, name):
    places = [line for line in plan(spark, name).splitlines() if "AS lugares#" in line]
    assert places and not any("destino" in line for line in places)
    # Names are put in lower case once, not for every word looked for.
    assert plan(spark, name).count("lower(lambda n") + plan(spark, name).count("lower(lambda x") == 1
