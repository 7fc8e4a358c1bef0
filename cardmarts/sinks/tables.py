"""Table writes, versions, registration, compaction, serving views and inventory.

Storage layout of one table::

    <table_root>/v=<version>/...      one complete copy per write
    <table_root>/_current/n=<k>/entry  one text line: the path of the k-th live copy

A write goes to a fresh version folder and only then adds a pointer with the
next number (``commits``: one writer gets a number, the other the next); the
greatest one counts. Nothing is overwritten, so readers never see a half-written
or half-deleted table, and a job that dies at any step leaves the live copy as
it was. ``drop_old_versions`` removes what is no longer live.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from collections.abc import Callable, Mapping, Sequence

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from cardmarts.sinks.commits import POINTER, ConcurrentWrite, delete, entries, put_if_absent, record
from cardmarts.sinks.compaction import MANIFEST, folder_files, has_manifest, live_files, packed, read_files


@dataclass(frozen=True)
class Written:
    path: str
    rows: int


STATS = "_stats"
BUCKET_BYTES = 8 << 20  # of input files to a bucket


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    mode: str = "overwrite",
    rebalance: bool | None = None,
    cluster_by: Sequence[str] = (),
    measures: Mapping[str, Column] | None = None,
    found: dict | None = None,
) -> int:
    """Write ``df`` and return the number of rows written, observed during the write.

    With partition columns every task would write a file for each value it
    meets, so the rows are rebalanced on them first: AQE then sizes the files
    (``advisoryPartitionSizeInBytes``), merging small parts and splitting a
    value that holds too many rows. Other writes take the parts as they come,
    without a shuffle: scan splits, or what AQE has merged after the last one.
    ``rebalance`` says otherwise.

    ``cluster_by`` deals the rows out by ranges of the partition columns and
    these, and sorts them: each file (and each of its pages) then covers a
    narrow range, and a filter on the first of these columns skips the others.
    A partition value with many rows is cut by them. ``measures`` are
    aggregates taken in the same pass; their values go to ``found``.
    """
    if cluster_by:
        keys = [*partition_by, *cluster_by]
        df, rebalance = df.repartitionByRange(*keys).sortWithinPartitions(*keys), False
    out = df.hint("rebalance", *partition_by) if (bool(partition_by) if rebalance is None else rebalance) else df
    # observed in the write (result) stage, whose task updates count once even
    # when a lost executor makes Spark rerun earlier stages
    obs = Observation()
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (measures or {}).items()])
    writer = out.write.mode(mode).format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")  # smaller files than with the default
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    got = dict(obs.get)
    if found is not None:
        found |= {k: got[k] for k in measures or {}}
    return int(got["rows"])


def new_version(label: str = "") -> str:
    return f"{label + '-' if label else ''}{uuid.uuid4().hex[:12]}"


def current_path(spark: SparkSession, table_root: str) -> str:
    """Path of the live copy of a table."""
    return _live(spark, table_root)[1]


def _live(spark: SparkSession, table_root: str) -> tuple[int, str]:
    known = entries(spark, table_root)
    if not known:
        raise FileNotFoundError(f"table not written yet: {table_root}")
    return known[-1]


def _set_current(spark: SparkSession, table_root: str, path: str) -> None:
    """Record ``path`` as the next copy."""
    record(spark, table_root, path)


def drop_old_versions(spark: SparkSession, table_root: str, keep: int = 2) -> list[str]:
    """Remove all but the newest ``keep`` recorded copies and their pointers; the removed paths.

    Run it when no reader uses the older copies. Uses the file system of the
    path, through Spark's Hadoop configuration.
    """
    if keep < 1:
        raise ValueError("at least the live copy is kept")
    known = entries(spark, table_root)
    used = {path for _, path in known[-keep:]}
    for path in list(used):
        if has_manifest(spark, path):  # a row for each version folder that its files lie in
            folders = live_files(spark, path).select(F.regexp_extract("path", r"/v=([^/]+)/", 1).alias("v")).distinct().collect()
            used |= {f"{table_root.rstrip('/')}/v={r['v']}" for r in folders}
    old = [(n, path) for n, path in known[:-keep] if path not in used]  # a folder that is still read keeps its pointer
    for number, path in old:
        delete(spark, f"{table_root.rstrip('/')}/{POINTER}/n={number}")  # the pointer first
        delete(spark, path)
    return [path for _, path in old]


def publish_table(
    spark: SparkSession,
    df: DataFrame,
    table_root: str,
    version: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    check: Callable[[], None] | None = None,
    cluster_by: Sequence[str] = (),
    measures: Mapping[str, Column] | None = None,
    rebalance: bool | None = None,
) -> Written:
    """Write a new version of a table, then make it the live copy unless ``check`` raises.

    ``rebalance=False`` writes a partitioned table without a shuffle, each task a file for every value it
    meets: for a copy that ``compact_table`` joins next.
    ``measures`` are aggregates of its rows, taken in the same pass and kept beside it (``read_stats``).
    """
    path, found = f"{table_root.rstrip('/')}/v={version or new_version()}", {}
    rows = write_table(df, path, partition_by=partition_by, fmt=fmt, rebalance=rebalance, cluster_by=cluster_by,
                       measures=measures, found=found)
    if check:
        check()
    if measures:
        put_if_absent(spark, f"{path}/{STATS}/entry", json.dumps({"rows": rows, **found}), f"{path}/{STATS}")
    _set_current(spark, table_root, path)
    return Written(path, rows)


def read_stats(spark: SparkSession, version_path: str) -> dict | None:
    """``rows`` and the measures of a version; None if it was written without."""
    try:
        lines = spark.read.text(f"{version_path}/{STATS}/entry", wholetext=True).collect()
    except AnalysisException:
        return None
    return json.loads(lines[0][0])


def read_table(spark: SparkSession, table_root: str, fmt: str = "parquet") -> DataFrame:
    """The live copy of a table (partition columns are discovered from folder names)."""
    return read_version(spark, table_root, current_path(spark, table_root), fmt)


def read_version(spark: SparkSession, table_root: str, path: str, fmt: str = "parquet") -> DataFrame:
    """One copy of a table; that of an incremental compaction through its list of files, which Spark's scan lists too."""
    if has_manifest(spark, path):
        return read_files(spark, table_root, [r["path"] for r in live_files(spark, path, fmt).select("path").collect()], fmt)
    return spark.read.format(fmt).load(path)


def compact_table(
    spark: SparkSession, table_root: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
    target_bytes: int = 128 << 20, whole: bool = False, retries: int = 3,
) -> Written:
    """Rewrite the live copy's small files as a new version; the live copy itself if there are none to join.

    Only files in bins of two or more are read (``compaction``); all others stay
    where they are and are named in the new version's manifest. The copy it was
    made from must still be the newest when it is recorded: else another job has
    published rows meanwhile, and the compaction starts anew from those, up to
    ``retries`` times. ``whole`` rewrites all files into one folder (partitioned
    by ``partition_by``), which a catalog name can point to. Rows are only
    shuffled if ``whole`` asks for other partition columns than the copy has.
    """
    for left in range(retries, -1, -1):
        number, path = _live(spark, table_root)
        new = f"{table_root.rstrip('/')}/v={new_version('compact')}"
        if whole:
            listed = live_files(spark, path, fmt).select("path", "length", "folder").collect()  # as a scan of them lists
            if listed and {_partition_columns(r["folder"]) for r in listed} == {tuple(partition_by)}:
                rows = _join_files(spark, table_root, listed, new, fmt, target_bytes)
            else:
                rows = write_table(read_version(spark, table_root, path, fmt), new, partition_by, fmt, rebalance=True)
        else:
            files = live_files(spark, path, fmt)
            chosen = packed(files, target_bytes)
            listed = chosen.select("path", "length", "folder").collect()  # names of small files, as a scan of them lists
            if not listed:
                return Written(path, read_version(spark, table_root, path, fmt).count())
            _join_files(spark, table_root, listed, new, fmt, target_bytes)
            own = folder_files(spark, new, fmt)
            files.join(chosen.select("path"), "path", "left_anti").unionByName(own).write.parquet(f"{new}/{MANIFEST}")
            rows = read_version(spark, table_root, new, fmt).count()  # from the files' footers
        try:
            record(spark, table_root, new, after=number)
            return Written(new, rows)
        except ConcurrentWrite:
            delete(spark, new)
            if not left:
                raise


def _partition_columns(folder: str) -> tuple[str, ...]:
    return tuple(x.split("=")[0] for x in folder.split("/") if x)


def _join_files(spark: SparkSession, table_root: str, files: Sequence[Row], new: str, fmt: str, target_bytes: int) -> int:
    """Rewrite files (path, length, folder) under ``new`` into files of about ``target_bytes``; the rows written.

    Rows stay in their folder, so each folder is a job of its own whose tasks read whole files: nothing is
    shuffled or sorted. Some of these jobs run at a time.
    """
    folders: dict[str, list[Row]] = {}
    for r in files:
        folders.setdefault(r["folder"], []).append(r)
    every = read_files(spark, table_root, [r["path"] for r in files], fmt)
    parts = {c for folder in folders for c in _partition_columns(folder)}
    schema = every.select(*[F.col(f"`{c}`") for c in every.columns if c not in parts]).schema

    def join(folder: str) -> int:
        own = folders[folder]
        tasks = -(-sum(r["length"] for r in own) // target_bytes)
        # without a base path the folder's columns are not read; they are in its name
        rows = spark.read.format(fmt).schema(schema).load([r["path"] for r in own]).coalesce(max(1, tasks))
        return write_table(rows, f"{new}/{folder}" if folder else new, fmt=fmt)

    with ThreadPoolExecutor(8) as pool:
        return sum(pool.map(inheritable_thread_target(spark)(join), folders))


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{loc}")


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Point a catalog name at a path (external table: dropping it keeps the files).

    A name that exists is moved to the new path, so readers always find it,
    unless its columns changed. A partitioned table only shows the partitions
    the catalog knows, so its folders are registered too. A copy made by an
    incremental compaction lies in several folders and has no one path.
    """
    if has_manifest(spark, path):
        raise ValueError(f"{path} is a list of files: register a whole copy (compact_table(..., whole=True))")
    kind = spark.read.format(fmt).load(path).schema.simpleString()
    if spark.catalog.tableExists(name):
        if spark.table(name).schema.simpleString() == kind:
            if any(c.isPartition for c in spark.catalog.listColumns(name)):
                for row in spark.sql(f"SHOW PARTITIONS {name}").collect():  # a row per month
                    spec = ", ".join("{}='{}'".format(*x.split("=", 1)) for x in row[0].split("/"))
                    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        else:
            spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def bucket_count(frames: Sequence[DataFrame], least: int = 8, per_bytes: int | None = None) -> int:
    """Buckets for tables made of ``frames``: one for each ``per_bytes`` of the files that the largest one reads, at least ``least``.

    A bucket is one task's work, so a number that does not grow with the input makes tasks that do.
    """
    most = 0
    for df in frames:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles()]
        most = max(most, sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths))
    return max(least, -(-most // (per_bytes or BUCKET_BYTES)))


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> None:
    """A catalog table at ``path`` whose rows lie in ``buckets`` hash buckets of ``key``, sorted in each.

    Tables with the same number of buckets join, and each aggregates, on ``key`` without a shuffle.
    """
    df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def create_catalog_views(spark: SparkSession, tables: Mapping[str, str], schema: str = "gold") -> list[str]:
    """One persistent view ``<schema>.vw_<name>`` per registered table (name -> catalog table)."""
    names = []
    for name, registered in tables.items():
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.vw_{name} AS SELECT * FROM {registered}")
        names.append(f"{schema}.vw_{name}")
    return names


def create_serving_views(spark: SparkSession, tables: Mapping[str, str], fmt: str = "parquet") -> list[str]:
    """One ``vw_<table>`` temp view of this session per table root, over its live copy."""
    names = []
    for name, root in tables.items():
        read_table(spark, root, fmt).createOrReplaceTempView(f"vw_{name}")
        names.append(f"vw_{name}")
    return names


def top_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows in a stated order (a top-k per task, then one small merge)."""
    if not order:
        raise ValueError("top_n needs an order so that the result is reproducible")
    return df.orderBy(*order).limit(n)


def layer_inventory(spark: SparkSession, tables: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """``(table_name, row_count)`` for every table root, as one DataFrame (one job)."""
    parts = [
        read_table(spark, root, fmt).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, root in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
