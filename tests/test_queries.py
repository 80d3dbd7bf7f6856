"""Every registered query against its SQL on the smallest test tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, database  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_sql():
    assert set(entry.queries()) - set(entry.LLM_QUERIES) == set(entry.oracle_sql()) - set(entry.LLM_SQL)


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["year", "month", "source", "total_kwh", "total_cost_dollars", "avg_kwh_per_reading"]
    assert out.count() > 0


@pytest.mark.parametrize("key", sorted(set(entry.queries()) - set(entry.LLM_QUERIES)))
def test_query(spark, con, key):
    _, result = compare(spark, con, key, SF)
    assert result.startswith("ok"), result
