"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


WITHOUT_SQL = set(entry_points.LLM_QUERIES) - set(entry_points.LLM_SQL)


def test_every_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL == set(SQL)


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, tables, name):
    assert differences(spark, tables, SF, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[:3] == ["window_start", "window_end", "District"]
    assert frame.count() > 0
