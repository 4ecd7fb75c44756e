"""Every query against its SQL on DuckDB, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tools.compare import compare, connect

NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, duck, name):
    query, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert query(spark, sf).count() > 0
    else:
        assert compare(spark, duck, query, sql, sf) == ""


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(NAMES)


def test_entry(spark):
    result = entry.entry(spark)
    assert "congestion_level" in result.columns and result.count() > 0
