"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402
from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.plans.oracle import ORACLE  # noqa: E402

SF = os.environ.get("TIDEMARK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF)
    assert r["cols_ok"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["close"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["airline", "tweet_count"] and df.count() > 0
