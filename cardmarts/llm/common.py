"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return shared_dir(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables that only an operator's own steps read; ``close`` removes them.

    Close it once what the operator returns no longer reads them.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        self.paths = []


def hot_join(rows: DataFrame, side: DataFrame, key: str, how: str = "inner", per: int = 100_000, counted: DataFrame | None = None,
             by: list[str] | None = None) -> DataFrame:
    """``rows`` joined to ``side``, which has one row for each ``key``; a key of many rows is spread over tasks.

    A key with more than ``per`` rows is dealt out by a hash of its rows (or of their columns ``by``), its one row of
    ``side`` repeated for each part.
    ``per`` is raised where more than 10,000 keys could be above it, so that their list, which is broadcast, is bounded.
    ``counted`` (a written table that has the rows' keys; ``rows`` by default) is read once more to find those keys.
    """
    counted = rows if counted is None else counted
    per = max(per, counted.count() // 10_000)
    hot = counted.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > per).select(
        F.col(key).alias("hot_key"), F.ceil(F.col("n") / per).cast("int").alias("parts"))
    dealt = rows.join(F.broadcast(hot), rows[key] == F.col("hot_key"), "left").withColumn(
        "part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*(by or rows.columns)), F.col("parts")).cast("int")))
    many = side.join(F.broadcast(hot), side[key] == F.col("hot_key"), "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)))
    return dealt.drop("hot_key", "parts").join(many.drop("hot_key", "parts"), [key, "part"], how).drop("part")


def spread(groups: DataFrame, count: str, name: str, block: int = 4_096) -> DataFrame:
    """Each row as often as its ``count`` says, with its ``turn`` from 0; what occurs often is written out in blocks over the tasks."""
    once = groups.filter(F.col(count) == 1).withColumn("turn", F.lit(0).cast("long"))
    many = materialize(groups.filter(F.col(count) > 1), name)
    at = many.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / block))))
    at = at.repartition(*[col(c) for c in at.columns])
    turn = F.explode(F.sequence(F.col("block") * block, F.least((F.col("block") + 1) * block, F.col(count)) - 1))
    return once.unionByName(at.withColumn("turn", turn).drop("block"))


def one_row(rows: DataFrame, key: str, row: str) -> DataFrame:
    """The struct ``row`` of one of the rows of each ``key``: that with the smallest hash; most are left out before the shuffle."""
    return rows.groupBy(key).agg(F.min_by(F.col(row), F.xxhash64(F.col(row).cast("string"))).alias(row)).select(f"{row}.*")


def byte_slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch's rows in order, in slices of about ``most`` bytes of a string or binary column (one row at least)."""
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, a = np.cumsum(length), 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield batch.slice(a, b - a)
        a = b


def release_memory() -> None:
    """Hand freed memory back to the system: Arrow's pool, and where the C library can, its heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task`` over batches; at its end what it has freed goes back to the system.

    A Python worker waits for its next task beside the JVM and would keep that memory meanwhile.
    """

    @functools.wraps(task)
    def run(batches):
        yield from task(batches)
        release_memory()

    return run


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
