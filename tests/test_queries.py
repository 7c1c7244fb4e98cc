"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    ok, note = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert ok, note


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and set(df.columns) == {"host", "kind", "links", "targets"}


def test_every_query_has_sql():
    assert set(entry.QUERIES) <= set(entry.queries()) and set(entry.QUERIES) <= set(entry.oracle_sql())
