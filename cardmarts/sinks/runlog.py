"""Append-only run log: one row per step and status, merged into segments under live readers.

Every step appends a file of one row. ``merge_log`` gathers the pending rows of
many steps into one sorted segment in ``_segments``, each with the name of the
file that it came from; segments of like size are merged in turn, so their number
grows with the logarithm of the rows. Readers take segments and files together
and keep one row for each file name, so a row that is in both, or in two
segments, is read once. What has been merged is only deleted when the segment
that holds it is older than ``grace_s``: a reader that listed the old files
still finds them, and one that lists later finds the segment.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.schemas import RUN_LOG
from cardmarts.sinks.commits import delete, file_system

# Settings an orchestrator may put into the session to identify its job.
JOB_ID_CONF = "spark.cardmarts.job.id"
JOB_RUN_ID_CONF = "spark.cardmarts.job.runId"
MANUAL = "MANUAL"


def new_run_id() -> str:
    return str(uuid.uuid4())


def run_context(
    spark: SparkSession, job_id: str | None = None, job_run_id: str | None = None,
    scheduler: str = "SCHEDULER",
) -> dict[str, str]:
    """job_id, job_run_id and triggered_by: from arguments, else session settings, else MANUAL."""
    job_id = job_id or spark.conf.get(JOB_ID_CONF, None)
    job_run_id = job_run_id or spark.conf.get(JOB_RUN_ID_CONF, None)
    return {
        "job_id": job_id or MANUAL,
        "job_run_id": job_run_id or MANUAL,
        "triggered_by": scheduler if job_id else MANUAL,
    }


def log_step(
    spark: SparkSession,
    log_path: str,
    run_id: str,
    pipeline_layer: str,
    table_name: str,
    step_name: str,
    status: str,
    job_name: str,
    load_type: str = "overwrite",
    error_message: str | None = None,
    row_count: int | None = None,
    context: dict[str, str] | None = None,
) -> None:
    """Append one row, stamped with the current time, to the log at ``log_path``."""
    ctx = context or run_context(spark)
    row = {
        "run_id": run_id, "pipeline_layer": pipeline_layer, "table_name": table_name,
        "step_name": step_name, "status": status, "row_count": row_count,
        "error_message": error_message, "job_name": job_name,
        "triggered_by": ctx["triggered_by"], "load_type": load_type,
        "job_id": ctx["job_id"], "job_run_id": ctx["job_run_id"],
    }
    # one row built from literals on the JVM side (no Python rows to ship)
    cols = [
        F.current_timestamp().alias(f.name) if f.name == "logged_at"
        else F.lit(row[f.name]).cast(f.dataType).alias(f.name)
        for f in RUN_LOG.fields
    ]
    # written aside and put by a rename: appends of concurrent jobs would share, and clean up, one temporary folder
    top = log_path.rstrip("/")
    aside = f"{top}/_unfinished/{uuid.uuid4().hex}"
    spark.range(1, numPartitions=1).select(*cols).write.parquet(aside)
    folder, fs = file_system(spark, aside)
    (part,) = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".parquet")]
    target, _ = file_system(spark, f"{top}/{part.getName()}")
    if not fs.rename(part, target):
        raise OSError(f"the log row could not be put: {target}")
    fs.delete(folder, True)


SEGMENTS = "_segments"
TIER = 8  # segments of one size class that are merged


def _folder(log_path: str) -> str:
    return f"{log_path.rstrip('/')}/{SEGMENTS}"


def _pending(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(log_path).withColumn("_file", F.element_at(F.split("_metadata.file_path", "/"), -1))


def _segments(spark: SparkSession, log_path: str) -> DataFrame | None:
    """The segments' rows, each with its ``_file``."""
    try:
        return spark.read.schema(f"{_ddl()}, _file string").parquet(f"{_folder(log_path)}/segment-*")
    except AnalysisException:
        return None


def _ddl() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RUN_LOG.fields)


def _segment_files(spark: SparkSession, log_path: str) -> list[tuple[str, int, float]]:
    """(path, rows, age in seconds) of every segment; its name holds its rows."""
    p, fs = file_system(spark, _folder(log_path))
    if not fs.exists(p):
        return []
    now = time.time()
    found = [(str(s.getPath()), s.getModificationTime() / 1000) for s in fs.listStatus(p) if s.getPath().getName().startswith("segment-")]
    return [(path, int(path.rsplit("-", 2)[1]), now - t) for path, t in found]


def _put_segment(spark: SparkSession, log_path: str, rows: DataFrame) -> int:
    """Write one sorted segment; it appears at once, by a rename of its folder."""
    aside = f"{log_path.rstrip('/')}/_unfinished/{uuid.uuid4().hex}"
    rows.orderBy("logged_at", "_file").coalesce(1).write.parquet(aside)
    n = spark.read.parquet(aside).count()
    source, fs = file_system(spark, aside)
    target, _ = file_system(spark, f"{_folder(log_path)}/segment-{n}-{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"the segment could not be put: {target}")
    return n


def merge_log(spark: SparkSession, log_path: str, least: int = 100, grace_s: float = 3600.0) -> int:
    """Merge pending rows (if there are ``least`` or more) and full tiers of segments; the rows merged.

    Run it from one place at a time, at any time: readers and writers go on.
    """
    segments = _segments(spark, log_path)
    old = [path for path, _, age in _segment_files(spark, log_path) if age >= grace_s]
    if old:  # files and segments whose rows an old segment holds
        settled = spark.read.schema("_file string").parquet(*old).distinct()
        for r in _pending(spark, log_path).join(settled, "_file", "left_semi").select("_file").collect():  # at most the merges of a grace period
            delete(spark, f"{log_path.rstrip('/')}/{r['_file']}")
        gone: set[str] = set()
        for path, n, _ in _segment_files(spark, log_path):
            over = [p for p in old if p != path and p not in gone and int(p.rsplit("-", 2)[1]) > n]
            if over:
                rest = spark.read.schema("_file string").parquet(path).join(spark.read.schema("_file string").parquet(*over), "_file", "left_anti")
                if rest.isEmpty():
                    delete(spark, path)
                    gone.add(path)
    new = _pending(spark, log_path)
    if segments is not None:
        new = new.join(_segments(spark, log_path).select("_file").distinct(), "_file", "left_anti").select(*new.columns)
    merged = 0
    if new.count() >= max(1, least):
        merged = _put_segment(spark, log_path, new)
    tiers: dict[int, list[str]] = {}
    for path, n, _ in _segment_files(spark, log_path):
        tiers.setdefault((n // max(1, least)).bit_length() // 3, []).append(path)
    for paths in tiers.values():
        if len(paths) >= TIER:
            rows = spark.read.schema(f"{_ddl()}, _file string").parquet(*paths)
            _put_segment(spark, log_path, rows.dropDuplicates(["_file"]))
    return merged


def register_log(spark: SparkSession, log_path: str, name: str = "control.pipeline_logs") -> str:
    """The run log as a named view over its files and segments, so that later rows show without more ado."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.split('.')[0]}")
    columns = ", ".join(RUN_LOG.fieldNames())
    every = f"SELECT {columns}, element_at(split(_metadata.file_path, '/'), -1) AS _file FROM parquet.`{log_path}`"
    if _segments(spark, log_path) is not None:
        every += f" UNION ALL SELECT {columns}, _file FROM parquet.`{_folder(log_path)}/segment-*`"
    first = ", ".join(f"any_value({c}) AS {c}" for c in RUN_LOG.fieldNames())
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {first} FROM ({every}) GROUP BY _file")
    return name


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    rows, segments = _pending(spark, log_path), _segments(spark, log_path)
    if segments is not None:
        rows = rows.unionByName(segments).dropDuplicates(["_file"])
    return rows.drop("_file")
