"""Compaction of small files only.

A version that an incremental compaction makes holds the files that it wrote and
a manifest (``_files``) of all files that belong to the copy: its own, and those
of earlier versions that were left as they are. Small files of a partition are
packed into bins of about ``target_bytes``; only bins of two files or more are
read and rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardmarts.sinks.commits import file_system

MANIFEST = "_files"
VERSION = "v"
_FILES = "path string, length long, folder string"


def has_manifest(spark: SparkSession, version_path: str) -> bool:
    p, fs = file_system(spark, f"{version_path}/{MANIFEST}")
    return fs.exists(p)


def folder_files(spark: SparkSession, version_path: str, fmt: str = "parquet") -> DataFrame:
    """(path, length, folder) of a version's own files; ``folder`` names the partition, '' without one."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").option("recursiveFileLookup", "true").load(version_path)
    return found.select("path", "length", F.regexp_extract("path", rf"/{VERSION}=[^/]+/(?:(.*)/)?[^/]+$", 1).alias("folder"))


def live_files(spark: SparkSession, version_path: str, fmt: str = "parquet") -> DataFrame:
    """(path, length, folder) of all files of a copy."""
    if has_manifest(spark, version_path):
        return spark.read.schema(_FILES).parquet(f"{version_path}/{MANIFEST}")
    return folder_files(spark, version_path, fmt)


def read_files(spark: SparkSession, table_root: str, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """The rows of some of a table's files, with the partition columns of their folders."""
    return spark.read.format(fmt).option("basePath", table_root).load(paths).drop(VERSION)


def packed(files: DataFrame, target_bytes: int) -> DataFrame:
    """The files to rewrite: per folder, small files in bins of about ``target_bytes``, two or more to a bin."""
    small = files.filter(F.col("length") < 0.75 * target_bytes)
    upto = F.sum("length").over(Window.partitionBy("folder").orderBy("length", "path").rowsBetween(Window.unboundedPreceding, -1))
    bins = small.withColumn("bin", F.floor(F.coalesce(upto, F.lit(0)) / target_bytes))
    together = F.count("*").over(Window.partitionBy("folder", "bin"))
    return bins.withColumn("together", together).filter("together > 1").select("path", "length", "folder")
