"""Frequent ids at ingest, dependency-driven runs, clustering, buckets, mergeable distinct counts, wide means."""

import random
import uuid
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from cardmarts.functions.metrics import money_avg, money_sum
from cardmarts.operators import distinct as D
from cardmarts.operators.labels import frequent_ids, hot_from_summary
from cardmarts.plans import gold as G
from cardmarts.plans import run as R
from cardmarts.session import shared_dir
from cardmarts.sinks import tables as T
from cardmarts.sinks.runlog import read_log
from cardmarts.testbed.landing import JSON_FILE_GLOB, new_landing_root, write_all_landing

RUN_DATE = "2024-01-01"


def new_root(spark, name):
    return shared_dir(spark, "tests", f"{name}-{uuid.uuid4().hex[:8]}")


def test_frequent_ids_are_observed_in_the_write(spark):
    ids = spark.range(300_000, numPartitions=6).select(
        F.when(F.col("id") % 4 == 0, "hot").when(F.col("id") % 50 == 1, F.concat(F.lit("warm"), F.col("id") % 3)).when(F.col("id") % 97 == 2, None)
        .otherwise(F.col("id").cast("string")).alias("transaction_id"))
    w = T.publish_table(spark, ids, root := new_root(spark, "frequent"), measures={"frequent_ids": frequent_ids()})
    stats = T.read_stats(spark, T.current_path(spark, root))
    assert stats["rows"] == w.rows == 300_000
    true = {r[0]: r[1] for r in ids.groupBy("transaction_id").count().collect()}
    for bound in (1_000, 10_000):
        assert hot_from_summary(stats["frequent_ids"], stats["rows"], bound) == sorted(
            k for k, n in true.items() if k is not None and n > bound)
    assert T.read_stats(spark, T.publish_table(spark, ids, root).path) is None


def test_a_fact_build_names_hot_ids_without_a_scan(spark, monkeypatch):
    lake = R.Lake(new_root(spark, "hot-lake"))
    labels = spark.createDataFrame([("1-1", "Yes", "b")] * 3, "transaction_id string, is_fraud_label string, _batch_id string")
    T.publish_table(spark, labels, lake.table_root("bronze", "fraud_labels"), measures={"frequent_ids": frequent_ids()})
    monkeypatch.setattr(R, "hot_label_ids", lambda labels: pytest.fail("looked at the labels"))
    assert R._hot_ids(spark, lake, labels, None) == []
    monkeypatch.setattr(R, "hot_from_summary", lambda s, n: hot_from_summary(s, n, hot_key_rows=2))
    assert R._hot_ids(spark, lake, labels, None) == ["1-1"]


def test_a_failing_table_stops_only_what_needs_it(spark, sf_dir, monkeypatch):
    landing = new_landing_root(spark)
    write_all_landing(spark, sf_dir, landing)
    lake = R.Lake(new_root(spark, "graph"))

    def broken(*a, **k):
        raise RuntimeError("no such dimension")

    builder, sources = R.SILVER_TABLES["dim_mcc"]
    monkeypatch.setitem(R.SILVER_TABLES, "dim_mcc", (broken, sources))
    with pytest.raises(R.RunFailed, match="no such dimension") as e:
        R.run_all(spark, lake, landing, RUN_DATE, file_glob=JSON_FILE_GLOB)
    assert set(e.value.errors) == {"silver.dim_mcc"} and e.value.skipped == ["gold.fraud_summary_by_mcc"]
    assert set(e.value.written["gold"]) == {"fraud_summary_by_state", "monthly_transaction_trends", "customer_risk_profile"}
    log = {(r.table_name, r.status) for r in read_log(spark, lake.log_path).collect()}
    assert ("dim_mcc", "FAILED") in log and ("customer_risk_profile", "SUCCESS") in log and ("fraud_summary_by_mcc", "STARTED") not in log


def scanned(spark, df) -> int:
    """Rows that the scan hands on, by its metric."""
    df.collect()
    stack, total = [df._jdf.queryExecution().executedPlan()], 0
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan"):
            total += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_clustered_files_are_skipped(spark):
    rows = spark.range(40_000).select((F.col("id") % 2).alias("m"), F.format_string("c%05d", F.xxhash64("id") % 5_000 + 5_000).alias("customer_id"), "id")
    plain, clustered = new_root(spark, "plain"), new_root(spark, "clustered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with more rows than one file takes
    try:
        T.publish_table(spark, rows, plain, partition_by=["m"])
        T.publish_table(spark, rows, clustered, partition_by=["m"], cluster_by=["customer_id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    a, b = (T.read_table(spark, r) for r in (plain, clustered))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    one = rows.first()["customer_id"]
    few, all_of = (scanned(spark, x.filter(F.col("customer_id") == one)) for x in (b, a))
    assert few < all_of / 2, (few, all_of)
    assert len(b.inputFiles()) <= 12


def test_bucketed_inputs_are_not_shuffled(spark, sf_dir):
    from cardmarts.testbed.queries import silver_tables

    silver = silver_tables(spark, sf_dir)
    schema = f"bucketed_{uuid.uuid4().hex[:8]}"
    T.create_schema(spark, schema, new_root(spark, schema))
    tables = {}
    for t in ("fact_transactions", "dim_customer", "dim_card"):
        T.save_bucketed(silver[t], f"{schema}.{t}", "customer_id", 4, new_root(spark, t))
        tables[t] = spark.table(f"{schema}.{t}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        build = lambda s: G.build_customer_risk_profile(s["fact_transactions"], s["dim_customer"], s["dim_card"], RUN_DATE).drop("_gold_loaded_at")
        df, plain = build(tables), build(silver)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
        key = [c for c in df.columns if c != "customer_sk"]
        assert df.select(key).exceptAll(plain.select(key)).isEmpty() and df.count() == plain.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_grow_with_the_input(spark, sf_dir, monkeypatch):
    from cardmarts.testbed import queries as Q

    small, large = new_root(spark, "small a%20b"), new_root(spark, "large")
    spark.range(1_000).write.parquet(small)
    spark.range(100_000).write.parquet(large)
    frames = [spark.read.parquet(small), spark.read.parquet(small).join(spark.read.parquet(large), "id")]
    few = T.bucket_count(frames, least=2, per_bytes=20_000)
    assert few > 2 and abs(T.bucket_count(frames, least=2, per_bytes=5_000) - 4 * few) <= 4
    assert T.bucket_count([spark.range(5)]) == 8 == T.bucket_count(frames)
    used, save = [], T.save_bucketed
    monkeypatch.setattr(T, "BUCKET_BYTES", 2_000)
    monkeypatch.setattr(Q, "save_bucketed", lambda df, name, key, buckets, path: used.append(buckets) or save(df, name, key, buckets, path))
    assert Q.bucketed_risk_profile(spark, sf_dir).count() > 0
    assert len(used) == 3 and len(set(used)) == 1 and used[0] > 8  # the same number for all, or they would not join without a shuffle


def test_distinct_counts_merge(spark):
    rng = random.Random(1)
    rows = [(rng.randint(1, 12), f"c{rng.randint(0, 900)}" if rng.random() < 0.95 else None) for _ in range(5_000)]
    df = spark.createDataFrame(rows, "month int, customer_id string")
    first = df.filter("month < 12")
    numbers = D.number_values(first, "customer_id").cache()
    n = numbers.count()
    assert sorted(r.number for r in numbers.collect()) == list(range(n))
    bitmaps = D.group_bitmaps(first, ["month"], "customer_id", numbers).cache()
    # one month arrives and another changes: only these are read
    extra = spark.createDataFrame([(3, "new-1"), (3, "c1"), (3, None)], "month int, customer_id string")
    late = df.filter("month = 12").unionByName(extra)
    touched = late.select("month").distinct()
    grown = D.number_values(late, "customer_id", numbers).cache()
    assert {(r.customer_id, r.number) for r in numbers.collect()} <= {(r.customer_id, r.number) for r in grown.collect()}
    assert sorted(r.number for r in grown.collect()) == list(range(grown.count()))
    fresh = D.group_bitmaps(late, ["month"], "customer_id", grown)
    now = D.replace_groups(bitmaps, fresh, ["month"], touched)
    whole = first.filter("month <> 3").unionByName(late)
    want = {r.month: r.n for r in whole.groupBy("month").agg(F.count_distinct("customer_id").alias("n")).collect()}
    assert {r.month: r.n for r in D.count_merged(now, ["month"], "n").collect()} == want
    half = now.withColumn("half", F.col("month") > 6)
    want = {r.half: r.n for r in whole.withColumn("half", F.col("month") > 6).groupBy("half").agg(F.count_distinct("customer_id").alias("n")).collect()}
    assert {r.half: r.n for r in D.count_merged(half, ["half"], "n").collect()} == want
    with pytest.raises(Exception, match="without a number"):
        D.group_bitmaps(late, ["month"], "customer_id", numbers).collect()


def test_distinct_months_equal_the_mart(spark, sf_dir):
    from cardmarts.testbed.queries import silver_tables

    fact = silver_tables(spark, sf_dir)["fact_transactions"]
    mart = G.build_monthly_transaction_trends(fact, RUN_DATE)
    numbers = D.number_values(fact, "customer_id").cache()
    got = D.count_merged(D.group_bitmaps(fact, ["txn_year", "txn_month"], "customer_id", numbers), ["txn_year", "txn_month"], "n")
    want = {(r.txn_year, r.txn_month): r.unique_customers for r in mart.collect()}
    assert {(r.txn_year, r.txn_month): r.n for r in got.collect()} == {k: v for k, v in want.items() if v}


def test_means_of_any_size(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for g in range(200):
        xs = [round(rng.uniform(-1e4, 1e4), rng.randint(0, 3)) for _ in range(rng.randint(1, 7))]
        rows += [(g, x) for x in xs]
        want[g] = float((sum(Decimal(str(x)) for x in xs) / len(xs)).quantize(Decimal("0.01"), ROUND_HALF_UP))
    rows += [(1_000, 9e23)] * 12_000 + [(1_001, None), (1_002, 1e30)] + [(1_003, -9e23), (1_003, 9e23)]
    got = {r.g: r for r in spark.createDataFrame(rows, "g int, x double").groupBy("g").agg(money_avg("x").alias("a"), money_sum("x").alias("s")).collect()}
    assert {g: got[g].a for g in want} == want
    assert got[1_000].a == 9e23 and got[1_001].a is None and got[1_002].a is None and got[1_003].a == 0


def test_monthly_trends_with_oversized_amounts(spark, sf_dir):
    from cardmarts.testbed.queries import silver_tables

    fact = silver_tables(spark, sf_dir)["fact_transactions"].withColumn("amount", F.lit(9e23))
    rows = G.build_monthly_transaction_trends(fact, RUN_DATE).collect()
    assert rows and all(r.avg_transaction_amount == 9e23 for r in rows)
