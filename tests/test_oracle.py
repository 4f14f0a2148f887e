"""Every registered query against its SQL counterpart in DuckDB."""

import oracle_check
import pytest

import __spark_entry__ as entry_point


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect("/root/testdata/sf0.001")


def test_every_query_has_a_counterpart():
    assert set(entry_point.registered()) == set(entry_point.ORACLE)
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query(spark, duck, sf, name):
    got = entry_point.queries()[name](spark, sf).toPandas()
    want = duck.execute(entry_point.oracle_sql()[name]).df()
    assert oracle_check.difference(got, want) is None


def test_entry(spark):
    rows = entry_point.entry(spark)
    assert rows.columns == ["route_region", "total_trips"] and rows.count() == 10
