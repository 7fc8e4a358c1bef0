"""Exact distinct counts that merge: bitmaps over dense numbers of the values.

Every value (a customer id) gets a number once and keeps it; numbers are dense,
so a group's set of values is a few bitmaps of 4 KB each, one for every 32,768
numbers. Bitmaps of groups merge by or, and a group that has changed is made
anew by itself: the months of a mart reload one by one, and a year or any other
range of months is counted from their bitmaps without reading the rows again.

Null values are not counted. A value that has no number fails loudly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardmarts.session import shared_dir

NUMBER = "number"


def number_values(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(column, number): ``known`` numbers as they are, and the next ones for new values, in their order.

    New values are sorted and counted per range, so no task sees them all. Keep the
    result as a table: it is the dictionary that later months are numbered with.
    """
    new = values.select(column).filter(F.col(column).isNotNull()).distinct()
    if known is not None:
        new = new.join(known, column, "left_anti")
    start = known.agg(F.coalesce(F.max(NUMBER) + 1, F.lit(0)).alias("start")) if known is not None else None
    placed = new.sort(column).withColumn("range", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    shared_dir(values.sparkSession)
    # written once, as ranges and places must not be made anew for the counts below
    placed = placed.withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).checkpoint()
    sizes = placed.groupBy("range").agg(F.count("*").alias("n"))  # a row per range
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.withColumn("first", F.coalesce(before, F.lit(0))).select("range", "first")
    if start is not None:
        firsts = firsts.join(F.broadcast(start)).select("range", (F.col("first") + F.col("start")).alias("first"))  # one row
    numbered = placed.join(F.broadcast(firsts), "range").select(column, (F.col("first") + F.col("at")).cast("long").alias(NUMBER))
    return numbered if known is None else known.select(column, NUMBER).unionByName(numbered)


def group_bitmaps(rows: DataFrame, keys: Sequence[str], column: str, numbers: DataFrame) -> DataFrame:
    """(keys, bucket, bitmap) of the values in each group."""
    pairs = rows.filter(F.col(column).isNotNull()).select(*keys, column).distinct()
    met = pairs.join(numbers, column, "left")
    number = F.when(F.col(NUMBER).isNotNull(), F.col(NUMBER)).otherwise(
        F.raise_error(F.concat(F.lit("value without a number: "), F.col(column).cast("string"))).cast("long"))
    return met.groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))


def replace_groups(bitmaps: DataFrame, fresh: DataFrame, keys: Sequence[str], touched: DataFrame) -> DataFrame:
    """``bitmaps`` with the groups of ``touched`` (keys) taken from ``fresh``."""
    return bitmaps.join(touched.select(*keys).distinct(), list(keys), "left_anti").unionByName(fresh)


def count_merged(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """(keys, name): exact distinct values of every group, or of coarser groups of them."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
