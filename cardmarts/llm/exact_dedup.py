"""Exact deduplication by two Bloom passes, in DataFrame functions only.

Pass 1 hashes every text once and writes the narrow table (id, digest) to the
shared folder. Two hash functions map each digest to a slot; a count per slot
(pre-aggregated in the map tasks) leaves the slots hit at least twice, packed
into bitmaps. Pass 2 probes that filter: a row with a slot hit only once is
certainly unique and passes straight through without a shuffle; only the rest
is grouped by digest.

The filter is broadcast. Its size is bounded by ``max_bits`` (two functions
of at most that many bits: 32 MB by default), whatever the input. Beyond the
bound the filter passes more rows to the grouping, never fewer, so the result
stays exact.

Defined results: a null text counts as empty. Of equal texts the row with the
largest id stays; null ids are smallest. Rows that also share that id are
equal copies: exactly one stays. Other columns, whatever their names, are
carried along untouched; an empty table gives an empty result. Whole texts are
hashed, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.llm.common import col, hot_join, materialize, one_row, spread, table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BITMAP_BITS = 32768  # bits of one row of bitmap_construct_agg


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same, faster, where a text is all ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def text_digest(text: Column) -> Column:
    """SHA-256 (binary) of the normalised text."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256))


def _slots(digest: Column, bits: int) -> list[Column]:
    h = F.xxhash64(digest)
    return [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1)) + F.lit(bits)]


def hit_slots(narrow: DataFrame, bits: int, at_least: int) -> DataFrame:
    """Bitmaps (bucket, bitmap) of the slots that ``at_least`` rows hit."""
    slot = narrow.select(F.explode(F.array(*_slots(F.col("digest"), bits))).alias("slot"))
    hit = slot.groupBy("slot").agg(F.count("*").alias("n")).filter(F.col("n") >= at_least)
    return hit.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))


def repeat_filter(narrow: DataFrame, max_bits: int = 1 << 26, at_least: int = 2) -> tuple[DataFrame, int]:
    """The broadcast filter of digests that possibly occur ``at_least`` times, and its bits per hash function.

    ``max_bits`` (a power of two) bounds the filter; see the module's text.
    """
    bits = BITMAP_BITS
    wanted = min(max_bits, 16 * max(1, narrow.count()))
    while bits < wanted:
        bits *= 2
    return materialize(hit_slots(narrow, bits, at_least), "bloom"), bits


def probe(rows: DataFrame, filters: DataFrame, bits: int) -> DataFrame:
    """``rows`` (with ``digest``) plus ``maybe``: false where the digest certainly occurs once."""
    out = rows
    for i, slot in enumerate(_slots(F.col("digest"), bits)):
        side = F.broadcast(filters.select(F.col("bucket").alias(f"bucket{i}"), F.col("bitmap").alias(f"bitmap{i}")))
        out = (out.withColumn(f"slot{i}", slot)
               .withColumn(f"bucket{i}", F.bitmap_bucket_number(f"slot{i}")).join(side, f"bucket{i}", "left"))
        pos = F.bitmap_bit_position(f"slot{i}").cast("int")
        byte = F.conv(F.hex(F.substring(F.col(f"bitmap{i}"), F.shiftright(pos, 3) + 1, F.lit(1))), 16, 10).cast("int")
        mask = F.pow(F.lit(2), pos.bitwiseAND(F.lit(7))).cast("int")
        out = out.withColumn(f"bit{i}", F.coalesce(byte.bitwiseAND(mask), F.lit(0)) != 0)
    return out.select(*rows.columns, (F.col("bit0") & F.col("bit1")).alias("maybe"))


def _groups(maybe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows per digest and id, and per digest the id that stays, the group's size and the rows that share that id."""
    per_id = materialize(maybe.groupBy("digest", "id").agg(F.count("*").alias("n")), "per-id")
    return per_id, materialize(per_id.groupBy("digest").agg(
        F.max("id").alias("keep_id"), F.sum("n").alias("group_size"),
        F.max(F.struct(F.col("id"), F.col("n")))["n"].alias("n_top")), "groups")


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return materialize(docs.select(col(id_col).alias("id"), text_digest(col(text_col)).alias("digest")), "digests")


def dedup_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_bits: int = 1 << 26) -> DataFrame:
    """One row per document: id, digest (binary), keep_id, group_size, kept."""
    narrow = _narrow(docs, id_col, text_col)
    flagged = probe(narrow, *repeat_filter(narrow, max_bits))
    once = flagged.filter(~F.col("maybe")).select(
        "id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    per_id, groups = _groups(flagged.filter("maybe"))
    more = spread(hot_join(per_id, groups, "digest"), "n", "equal-ids")
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 0)
    return once.unionByName(more.withColumn("kept", kept).select(*once.columns))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_bits: int = 1 << 26) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they were."""
    narrow = _narrow(docs, id_col, text_col)
    filters, bits = repeat_filter(narrow, max_bits)
    maybe = materialize(probe(narrow, filters, bits).filter("maybe").drop("maybe"), "maybe")
    groups = _groups(maybe)[1].filter("group_size > 1")
    packed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"),
                         text_digest(col(text_col)).alias("digest"), col(id_col).alias("id"))
    rows = probe(packed, filters, bits)
    once = rows.filter(~F.col("maybe")).select("row.*")
    more = hot_join(rows.filter("maybe").drop("maybe"), groups, "digest", "left", counted=maybe, by=["id"])
    single = more.filter(F.col("group_size").isNull()).select("row.*")
    stays = more.filter(F.col("group_size").isNotNull() & F.col("id").eqNullSafe(F.col("keep_id")))
    kept = stays.filter("n_top = 1").select("row.*").unionByName(one_row(stays.filter("n_top > 1"), "digest", "row"))
    return once.unionByName(single).unionByName(kept)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id that stays, its group's size, and its digest."""
    rows = dedup_decisions(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                       F.lower(F.hex("digest")).alias("text_sha256"))


OP7_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
