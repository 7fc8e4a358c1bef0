"""What the layers write and shuffle: compressed landing files and tables, a narrow month shuffle."""

import os
import uuid

from cardmarts.plans import silver as S
from cardmarts.schemas import CSV_ENTITIES
from cardmarts.session import shared_dir
from cardmarts.sinks import tables as T
from cardmarts.sources.landing import read_landing
from cardmarts.testbed import entities as E
from cardmarts.testbed.landing import new_landing_root, write_landing


def new_root(spark, name):
    return shared_dir(spark, "tests", f"{name}-{uuid.uuid4().hex[:8]}")


def test_landing_csv_is_compressed_in_bounded_files(spark):
    rows = spark.range(25).selectExpr(*[f"concat('{c}', id) as {c}" for c in CSV_ENTITIES["users"].fieldNames()]).coalesce(1)
    root = new_landing_root(spark)
    path = write_landing(spark, "", root, "users", df=rows, compression="gzip", rows_per_file=10)
    names = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(names) == 3 and all(f.endswith(".csv.gz") for f in names)
    got = read_landing(spark, root, "users", E.RUN_DATE).select(*rows.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


def test_month_shuffle_carries_neither_flags_nor_audit_columns(spark, sf_dir):
    bronze = E.bronze_all(spark, sf_dir)
    args = bronze["transactions"], bronze["fraud_labels"], E.RUN_DATE
    plain, dealt = S.with_month_partition(S.build_fact_transactions(*args)), S.build_fact_transactions(*args, by_month=True)
    assert dealt.columns == plain.columns
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RebalancePartitions")
    for name in ("_dq_flags", "_silver_table"):
        assert name in above and name not in below
    free = [c for c in plain.columns if c not in ("transaction_sk", "_silver_loaded_at")]
    assert sorted(map(str, dealt.select(free).collect())) == sorted(map(str, plain.select(free).collect()))


def test_tables_are_written_with_zstd(spark):
    path = f"{new_root(spark, 'zstd')}/v=1"
    T.write_table(spark.range(9), path)
    assert all(".zstd." in f for f in os.listdir(path) if f.startswith("part-"))
