"""Session helpers: a local session for tests and the bench, and the shared folder.

On a cluster the session comes from the platform and already names a shared,
fault-tolerant folder in ``spark.checkpoint.dir``. Everything this library
writes outside of the caller's lake (landing fixtures, checkpoints) lives
under that folder. A folder of our own is set only when the setting is empty,
which happens in local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_LOCAL_CONF = "spark.cardmarts.localSharedDir"


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cardmarts",
    event_log_dir: str | None = None,
) -> SparkSession:
    """A local session with AQE on and the UI off (tests, bench).

    ``event_log_dir`` turns on Spark's event log there (stage and task metrics).
    """
    builder = SparkSession.builder
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
                   .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false"))
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "cardmarts-warehouse"))
        .config("spark.driver.memory", os.environ.get("CARDMARTS_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session. If it is unset in local
    mode (tests on a laptop), a fresh folder is made once and recorded in the
    session so that later calls and ``DataFrame.checkpoint`` agree on it. On a
    cluster a folder of one machine would lose data, so an unset one is an error.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.conf.get(_LOCAL_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        # core settings cannot be changed on a live session; keep ours beside it
        base = tempfile.mkdtemp(prefix="cardmarts-")
        spark.conf.set(_LOCAL_CONF, base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    return "/".join([base, *[p.strip("/") for p in parts if p]])


def scale_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """SQL settings sized for ``input_bytes`` of input on ``cores`` executor cores.

    The shuffle starts with about one partition per ``partition_bytes`` of
    input (at least two per core; no upper bound) and AQE merges
    small ones towards ``partition_bytes`` and splits skewed ones, in joins
    and in the rebalance before partitioned writes. Scans read splits of the
    same size.
    """
    parts = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL settings on a live session."""
    for k, v in conf.items():
        spark.conf.set(k, v)
