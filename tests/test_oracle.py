"""Every registered query against its DuckDB oracle on sf0.001 (the driver checks sf0.01)."""

import pytest

import __spark_entry__ as entry  # noqa: E402
from cardmarts.testbed.queries import QUERIES
from oracle_check import compare, duck

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_dir, con, key):
    ok, msg = compare(spark, sf_dir, key, entry.queries()[key], entry.oracle_sql()[key], con)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "risk_tier" in df.columns
