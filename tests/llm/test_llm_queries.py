"""The operators' queries against their SQL on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

NAMES = ["op1_near_duplicates", "op6_decontamination", "op8_substring_dedup"]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf, name):
    ok, note = compare(spark, connect(sf), name, entry.queries()[name], entry.oracle_sql()[name], sf)
    assert ok, note


def test_one_query_per_operator_and_the_pipeline():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
