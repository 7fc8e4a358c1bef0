"""Every registered query of the package on the smallest tables; those with SQL against DuckDB."""

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry
from cardmarts.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_sql(spark, sf_dir, con, key):
    ok, msg = compare(spark, sf_dir, key, QUERIES[key], ORACLE_SQL[key], con)
    assert ok, msg


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_one_row_per_document(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    if key.startswith(("op3_", "op4_")):
        assert df.count() > 0
    else:
        assert df.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
