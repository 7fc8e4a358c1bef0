"""Landing files for the testbed, written by Spark from the raw entities.

CSV entities are written with a header by many tasks. A JSON dictionary is
written as several complete dictionary files, one per hash bucket of its
keys, each holding a bounded share of the pairs; the bucket count grows with
the row count so no task assembles more than ``pairs_per_file`` pairs.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.schemas import CSV_ENTITIES, JSON_ENTITIES
from cardmarts.session import shared_dir
from cardmarts.sources.landing import landing_path
from cardmarts.testbed.entities import RAW_ENTITIES, RUN_DATE

# Spark's text writer names its files *.txt; the testbed's readers match that.
JSON_FILE_GLOB = "*.txt"


def new_landing_root(spark: SparkSession) -> str:
    """A fresh landing folder under the shared folder (one per run, never reused)."""
    return shared_dir(spark, "cardmarts-testbed", f"landing-{uuid.uuid4().hex[:12]}")


def _json_dictionary_files(df: DataFrame, key: str, value: str, root: str | None, path: str,
                           pairs_per_file: int) -> None:
    # the pairs are written once, so that what derives them does not run again for their number
    kept = shared_dir(df.sparkSession, "cardmarts-testbed", f"pairs-{uuid.uuid4().hex[:12]}")
    df.select(key, value).write.parquet(kept)
    df = df.sparkSession.read.parquet(kept)
    n = df.count()
    buckets = max(1, math.ceil(n / pairs_per_file))
    pair = F.regexp_replace(F.to_json(F.create_map(F.col(key), F.col(value))), r"^\{|\}$", "")
    # legal whitespace of every kind around the colon, by the key's hash
    blank = F.element_at(F.array(*[F.lit(x) for x in ("", " ", "\t", "\n", "\r\n")]), F.pmod(F.hash(key), F.lit(5)) + 1)
    pair = F.regexp_replace(pair, '^("[^"]*"):', F.concat(F.lit("$1"), blank, F.lit(":"), blank))
    grouped = (
        # copies of one key from different input splits go to different files, so a
        # key repeated very often never gathers in one task; the split id keeps it
        # deterministic when a task is retried
        df.select(F.pmod(F.hash(F.col(key), F.spark_partition_id()), F.lit(buckets)).alias("bucket"),
                  pair.alias("pair"))
        .groupBy("bucket")
        .agg(F.concat_ws(", ", F.collect_list("pair")).alias("pairs"))
    )
    if root:
        text = F.concat(F.lit(f'{{"{root}": {{'), F.col("pairs"), F.lit("}}"))
    else:
        text = F.concat(F.lit("{"), F.col("pairs"), F.lit("}"))
    # one folder per bucket, one line per folder; the reader takes every file below
    grouped.select("bucket", text.alias("value")).write.mode("overwrite").partitionBy("bucket").text(path)


def write_landing(
    spark: SparkSession, sf_dir: str, landing_root: str, entity: str,
    ingestion_date: str = RUN_DATE, df: DataFrame | None = None, pairs_per_file: int = 50_000,
    compression: str = "none", rows_per_file: int = 500_000,
) -> str:
    """Write one entity's raw rows as landing files; returns the date folder."""
    path = landing_path(landing_root, entity, ingestion_date)
    raw = df if df is not None else RAW_ENTITIES[entity](spark, sf_dir)
    if entity in CSV_ENTITIES:
        writer = raw.select(*CSV_ENTITIES[entity].fieldNames()).write.mode("overwrite").option("header", True)
        if compression != "none":  # such a file is read by one task, so its rows are bounded
            writer = writer.option("compression", compression).option("maxRecordsPerFile", rows_per_file)
        writer.csv(path)
    else:
        root, key, value = JSON_ENTITIES[entity]
        _json_dictionary_files(raw, key, value, root, path, pairs_per_file)
    return path


def write_all_landing(spark: SparkSession, sf_dir: str, landing_root: str,
                      ingestion_date: str = RUN_DATE) -> dict[str, str]:
    return {e: write_landing(spark, sf_dir, landing_root, e, ingestion_date) for e in RAW_ENTITIES}
