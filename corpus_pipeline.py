"""Corpus pipeline: documents to a deduplicated, mixed and encoded corpus.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept. ``run`` writes every stage's rows as Parquet to the shared folder and
reads them back, which cuts lineage: a lost executor costs at most a part of
one stage. All stages but the last return the columns of the documents as they
were; the last returns ids, their number and the digest of the decoded text.

Nulls, empty texts, repeated rows and empty tables are defined by each
operator; documents without an identified language leave in the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.llm.common import materialize, sha256_hex, table
from cardmarts.llm.exact_dedup import exact_dedup
from cardmarts.llm.language_id import keep_identified
from cardmarts.llm.mixing import mix
from cardmarts.llm.prob_minhash import near_dedup
from cardmarts.llm.sentencepieces import encode_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified: without text or letters there is none; no score is too low."""
    return keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids and the digest of the text that the ids decode to."""
    rows = encode_table(docs, decoded=True)
    return rows.select(F.col("id").alias("doc_id"), "ids", F.size("ids").cast("long").alias("n_ids"),
                       sha256_hex(F.col("decoded")).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

ORACLE_SQL = None  # language models, MinHash and encoding are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = materialize(stage(spark, rows, sf_dir), f"stage-{name}")
    return rows
