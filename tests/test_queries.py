"""Every registered query against its SQL twin, whole tables of the smallest scale."""

import pytest
from oracle import compare, oracle_connection

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    result = queries()[name](spark, SF_DIR)
    sql = oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert compare(result, con, sql) is None


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["fecha", "codigo", "moneda", "compra", "venta", "ord"]
