"""Concurrent writers, incremental compaction, and the run log's merge."""

import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from cardmarts.sinks import commits as C
from cardmarts.sinks import runlog as R
from cardmarts.sinks import tables as T
from cardmarts.session import shared_dir


def new_root(spark, name):
    return shared_dir(spark, "tests", f"{name}-{uuid.uuid4().hex[:8]}")


def test_an_entry_is_put_once(spark):
    root = new_root(spark, "put")
    got = [None] * 8

    def put(k):
        got[k] = C.put_if_absent(spark, f"{root}/n=1/entry", f"writer {k}", f"{root}/_unfinished")

    threads = [threading.Thread(target=put, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == [False] * 7 + [True]
    with open(f"{root}/n=1/entry") as f:
        assert f.read() == f"writer {got.index(True)}"


def test_two_publishers_both_end_in_history(spark, monkeypatch):
    root = new_root(spark, "two")
    T.publish_table(spark, spark.range(1).toDF("x"), root)
    barrier, taken = threading.Barrier(2), []
    entries = C.entries

    def together(spark, table_root):  # both writers see the same newest number
        out = entries(spark, table_root)
        if len(taken) < 2:
            taken.append(1)
            barrier.wait(60)
        return out

    monkeypatch.setattr(C, "entries", together)
    paths = {}

    def publish(n):
        paths[n] = T.publish_table(spark, spark.range(n).toDF("x"), root).path

    threads = [threading.Thread(target=publish, args=(n,)) for n in (5, 7)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    monkeypatch.undo()
    history = C.entries(spark, root)
    assert [n for n, _ in history] == [1, 2, 3]
    assert {p for _, p in history[1:]} == set(paths.values())
    assert T.read_table(spark, root).count() in (5, 7)


def test_a_copy_made_from_an_old_one_is_refused(spark):
    root = new_root(spark, "stale")
    T.publish_table(spark, spark.range(1).toDF("x"), root)
    with pytest.raises(C.ConcurrentWrite):
        C.record(spark, root, "elsewhere", after=0)
    assert len(C.entries(spark, root)) == 1


def scattered(spark, root):
    """Month 1 in many small files, month 2 in one."""
    path = f"{root}/v=first"
    for k in range(6):
        spark.range(k * 10, k * 10 + 10).withColumn("m", F.lit(1)).coalesce(1).write.mode("append").partitionBy("m").parquet(path)
    spark.range(1000, 1500).withColumn("m", F.lit(2)).coalesce(1).write.mode("append").partitionBy("m").parquet(path)
    C.record(spark, root, path)


def names(spark, root):
    return {os.path.basename(f) for f in T.read_table(spark, root).inputFiles()}


def test_compaction_rewrites_small_files_only(spark):
    root = new_root(spark, "compact")
    scattered(spark, root)
    before, rows = names(spark, root), sorted(T.read_table(spark, root).collect())
    big = {f for f in before if f in os.listdir(f"{root}/v=first/m=2")}
    w = T.compact_table(spark, root)
    after = names(spark, root)
    assert w.rows == 560 and sorted(T.read_table(spark, root).collect()) == rows
    assert len(big) == 1 and big <= after and len(after) == 2  # the other month's file keeps its name and place
    assert not os.path.exists(f"{w.path}/m=2")
    plan = T.read_table(spark, root).filter("m = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    assert T.compact_table(spark, root).path == w.path  # nothing left to join
    # the first copy's folder is still read, so it stays
    assert T.drop_old_versions(spark, root, keep=1) == []
    assert T.read_table(spark, root).count() == 560
    whole = T.compact_table(spark, root, partition_by=["m"], whole=True)
    assert sorted(T.read_table(spark, root).collect()) == rows
    assert len(T.drop_old_versions(spark, root, keep=1)) == 2 and T.current_path(spark, root) == whole.path
    with pytest.raises(ValueError):
        T.register_table(spark, "x", w.path) if os.path.exists(w.path) else (_ for _ in ()).throw(ValueError())


def test_compaction_shuffles_no_rows(spark, monkeypatch):
    """Files of one folder are joined where they are; odd partition values and more files than one stay right."""
    root = new_root(spark, "unshuffled")
    rows = spark.range(600).select("id", F.expr("case id % 4 when 0 then null when 1 then 'a b/c=d' when 2 then '01' else 'x%20' end").alias("m"))
    T._set_current(spark, root, f"{root}/v=first")
    for k in range(3):
        rows.filter(f"id % 3 = {k}").coalesce(1).write.mode("append").partitionBy("m").parquet(f"{root}/v=first")
    before = sorted(T.read_table(spark, root).collect(), key=str)
    write, plans = T.write_table, []
    monkeypatch.setattr(T, "write_table", lambda df, *a, **k: plans.append(
        df._jdf.queryExecution().executedPlan().toString() + str(k.get("rebalance"))) or write(df, *a, **k))
    for whole in (False, True):
        w = T.compact_table(spark, root, partition_by=["m"], whole=whole)
        assert w.rows == 600 and sorted(T.read_table(spark, root).collect(), key=str) == before
        assert len(names(spark, root)) == 4
    assert len(plans) == 8 and not any("Exchange" in p or "True" in p for p in plans)
    T.compact_table(spark, root, partition_by=["m"], whole=True, target_bytes=1_000)
    assert sorted(T.read_table(spark, root).collect(), key=str) == before
    assert T.compact_table(spark, root, whole=True).rows == 600  # other partition columns
    assert not T._partition_columns(T.live_files(spark, T.current_path(spark, root)).first()["folder"])
    assert sorted(T.read_table(spark, root).select("id", "m").collect(), key=str) == before


def test_compaction_starts_anew_when_rows_were_published(spark, monkeypatch):
    root = new_root(spark, "race")
    scattered(spark, root)
    record, seen = T.record, []

    def late(spark, table_root, path, after=None):
        if after is not None and not seen:
            seen.append(1)
            T.publish_table(spark, spark.range(3).withColumn("m", F.lit(9)), root, partition_by=["m"])
        return record(spark, table_root, path, after)

    monkeypatch.setattr(T, "record", late)
    w = T.compact_table(spark, root)
    assert T.read_table(spark, root).count() == 3 == w.rows  # the newer rows are not lost
    seen.clear()
    scattered(spark, new := new_root(spark, "race"))
    root = new
    with pytest.raises(C.ConcurrentWrite):
        T.compact_table(spark, root, retries=0)


def log_rows(spark, path, first, n):
    for k in range(first, first + n):
        R.log_step(spark, path, f"run-{k}", "bronze", "t", "s", "SUCCESS", "job", row_count=k)


def seen(spark, path):
    return sorted(r.row_count for r in R.read_log(spark, path).collect())


def test_log_merges_under_readers(spark):
    path = new_root(spark, "log")
    log_rows(spark, path, 0, 6)
    reader = R.read_log(spark, path)  # planned before the merge
    assert R.merge_log(spark, path, least=10) == 0
    assert R.merge_log(spark, path, least=5) == 6
    assert seen(spark, path) == list(range(6)) and reader.count() == 6
    name = R.register_log(spark, path, f"logs_{uuid.uuid4().hex[:8]}.steps")
    log_rows(spark, path, 6, 5)
    spark.catalog.refreshTable(name)
    assert seen(spark, path) == list(range(11)) and spark.table(name).count() == 11
    assert R.merge_log(spark, path, least=5, grace_s=0) == 5  # what the first segment holds is deleted
    assert seen(spark, path) == list(range(11))
    assert sum(f.endswith(".parquet") for f in os.listdir(path)) == 5


def test_log_segments_stay_few(spark, monkeypatch):
    monkeypatch.setattr(R, "TIER", 3)
    path = new_root(spark, "segments")
    for k in range(7):
        log_rows(spark, path, 2 * k, 2)
        R.merge_log(spark, path, least=2, grace_s=0)
        assert seen(spark, path) == list(range(2 * k + 2))
    R.merge_log(spark, path, least=2, grace_s=0)
    assert seen(spark, path) == list(range(14))
    assert len(os.listdir(f"{path}/_segments")) <= 4
