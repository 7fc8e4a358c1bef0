"""Approximate nearest neighbours by cross-polytope hashing.

A hash rotates the unit vector pseudo-randomly (three rounds of random signs
and a fast Hadamard transform, padded to a power of two) and takes the nearest
signed axis. ``hashes`` of them make a bucket, ``tables`` independent ones an
index that holds every distinct vector once per table. A query looks into its
``probes`` most likely buckets of each table, likeliest first, and every
vector found there is scored exactly (cosine in double precision on the
original vectors).

Buckets meet queries in blocks: a bucket with many vectors or many queries is
cut on both sides by hash, so no group holds more than about ``block`` of
either, however hot the bucket; a block yields only each query's best few.
Equal vectors are indexed once, with the few smallest ids that any answer can
need, so a vector that a third of the rows share costs one row. The bucket
counts that steer the cutting are the only thing broadcast: at most
``tables * (2 * padded dimension) ** hashes`` rows per dimension.

``hashes=1`` suits up to some millions of vectors. A second hash squares the
number of buckets, so a query must look into more of them, in more tables:
``REACH`` has what was measured on vectors without near neighbours (64
dimensions, the five best, 2,000 vectors): 8 tables and 16 probes find 0.985 at
one hash, looking at 60 % of all pairs; 16 tables and 512 probes find 0.995 at two,
looking at 38 %. With the first figures two hashes find 0.2. For more hashes
give both, and measure.

The best of a block are scored once more pair by pair, so that a score does not
depend on the block and equal ones go to the smaller id.

Defined results: vectors that are null, empty, zero, or hold a null or
non-finite component take no part, as query or candidate; only vectors of
equal length are compared. Equal rows (id and vector) count once. A query
that finds fewer than ``top`` is searched exactly against all rows, so it gets
every candidate there is, if fewer. Ties go to the smaller id. An empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardmarts.llm.common import col, materialize, table

REACH = {1: (8, 16), 2: (16, 512)}  # hashes: (tables, probes)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, width, h = x.shape[0], x.shape[1], 1
    while h < width:
        y = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Pseudo-random rotation of the rows, padded to a power of two."""
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(3, width))
    for s in signs:
        x = hadamard(x * s)
    return x


def likeliest(unit: np.ndarray, seed: int, hashes: int, probes: int) -> np.ndarray:
    """The ``probes`` likeliest buckets of each row, best first (the first is the row's own)."""
    code = cost = None
    for k in range(hashes):
        y = rotate(unit, seed * 1009 + k)
        y = np.concatenate([y, -y], axis=1)
        gap = (y.max(axis=1, keepdims=True) - y) ** 2
        best = np.argsort(gap, axis=1, kind="stable")[:, :probes]
        gap = np.take_along_axis(gap, best, axis=1)
        if code is None:
            code, cost = best, gap
        else:
            both = (cost[:, :, None] + gap[:, None, :]).reshape(len(unit), -1)
            ids = (code[:, :, None] * y.shape[1] + best[:, None, :]).reshape(len(unit), -1)
            pick = np.argsort(both, axis=1, kind="stable")[:, :probes]
            code, cost = np.take_along_axis(ids, pick, axis=1), np.take_along_axis(both, pick, axis=1)
    return code


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64, copy=False)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # first to a size that squares safely
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def bucketed(vectors: DataFrame, tables: int, hashes: int, probes: int, seed: int) -> DataFrame:
    """(id, dim, tab, bucket, place) for each vector (id, dim, vec), table and probe."""

    def run(batches):
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                unit = _unit(_matrix(part["vec"]))
                for t in range(tables):
                    codes = likeliest(unit, seed + t, hashes, probes)
                    yield pd.DataFrame({
                        "id": np.repeat(part["id"].to_numpy(), codes.shape[1]), "dim": np.int32(dim), "tab": np.int32(t),
                        "bucket": codes.ravel().astype("int64")})

    return vectors.select("id", "dim", "vec").mapInPandas(run, "id long, dim int, tab int, bucket long")


def _best_in_block(most: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asked.empty:
            return pd.DataFrame({"query": [], "id": [], "score": []}).astype({"query": "int64", "id": "int64"})
        rows = rows.sort_values("id")
        ids, x, q = rows["id"].to_numpy(), _unit(_matrix(rows["vec"])), _unit(_matrix(asked["asked_vec"]))
        score = q @ x.T
        least = np.partition(score, max(0, len(ids) - most), axis=1)[:, max(0, len(ids) - most)]
        of, at = np.nonzero(score >= least[:, None] - 1e-9)
        exact = (q[of] * x[at]).sum(axis=1)  # the same sum for a pair in every block
        order = np.lexsort((ids[at], -exact, of))
        of, at, exact = of[order], at[order], exact[order]
        keep = np.arange(len(of)) - np.searchsorted(of, of) < most
        return pd.DataFrame({"query": asked["query"].to_numpy()[of[keep]], "id": ids[at[keep]], "score": exact[keep]})
    return run


def _meet(index: DataFrame, asked: DataFrame, vectors: DataFrame, most: int, block: int) -> DataFrame:
    """Best ``most`` per query and block of (query, id, score), where index and queries share a bucket."""
    key = ["dim", "tab", "bucket"]
    grid = materialize(
        index.groupBy(key).agg(F.ceil(F.count("*") / block).cast("int").alias("cuts"))
        .join(asked.groupBy(key).agg(F.ceil(F.count("*") / block).cast("int").alias("ask_cuts")), key), "grid")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cut = lambda n: F.pmod(F.xxhash64("id", F.lit("cut")), F.col(n)).cast("int")
    rows = index.join(F.broadcast(grid), key).withColumn("cut", cut("cuts")).withColumn("ask_cut", spread("ask_cuts"))
    asks = asked.join(F.broadcast(grid), key).withColumn("ask_cut", cut("ask_cuts")).withColumn("cut", spread("cuts"))
    block_key = [*key, "cut", "ask_cut"]
    rows = rows.select("id", *block_key).join(vectors.select("id", "vec"), "id")
    # new names on this side: both sides read the same table of vectors
    asks = asks.select("id", *block_key).join(vectors.select("id", F.col("vec").alias("asked_vec")), "id").select(
        F.col("id").alias("query"), F.col("asked_vec"), *[F.col(k).alias(k) for k in block_key])
    return rows.groupBy(block_key).cogroup(asks.groupBy(block_key)).applyInPandas(
        _best_in_block(most), "query long, id long, score double")


def _bits(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def nearest(embeddings: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", top: int = 5,
            tables: int | None = None, hashes: int = 1, probes: int | None = None, block: int = 1024, seed: int = 11) -> DataFrame:
    """query_id, rank, id and score of the ``top`` nearest found for every row with ``is_query`` (over ``id``).

    ``tables`` and ``probes`` are those of ``REACH`` unless given.
    """
    if hashes not in REACH and None in (tables, probes):
        raise ValueError(f"no tables and probes were measured for {hashes} hashes: give both")
    tables, probes = tables or REACH[hashes][0], probes or REACH[hashes][1]
    vec = col(vec_col).cast("array<double>")
    rows = embeddings.select(col(id_col).cast("long").alias("id"), vec.alias("vec")).filter(
        F.col("id").isNotNull() & F.col("vec").isNotNull())
    rows = rows.filter(F.forall("vec", _bits) & F.exists("vec", lambda x: x != 0)).distinct()
    # equal vectors once, with the top + 1 smallest ids: all that an answer can need
    few = rows.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("n") <= top + 1)
    vectors = materialize(
        few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
            F.col("ids")[0].alias("id"), F.size("vec").alias("dim"), "vec", "ids"), "vectors")
    queries = materialize(
        rows.filter(is_query).withColumnRenamed("id", "query_id").join(vectors.select("id", "vec"), "vec").select("query_id", "id"),
        "queries")
    asked = vectors.join(queries.select("id").distinct(), "id")
    index = materialize(bucketed(vectors, tables, hashes, 1, seed), "index")
    probed = materialize(bucketed(asked, tables, hashes, probes, seed), "probes")

    def best(found: DataFrame) -> DataFrame:
        once = found.groupBy("query", "id").agg(F.max("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
        return once.withColumn("n", rank).filter(F.col("n") <= top + 1).drop("n")

    found = materialize(best(_meet(index, probed, vectors, top + 1, block)), "found")
    # queries whose buckets held too few: exactly, against all rows, in blocks
    ids = vectors.select("id", F.size("ids").alias("m"))
    short = asked.join(found.join(ids, "id").groupBy(F.col("query").alias("id")).agg(F.sum("m").alias("m")).filter(F.col("m") > top),
                       "id", "left_anti").select("id", "dim")
    everywhere = lambda df: df.select("id", "dim", F.lit(-1).alias("tab"), F.lit(0).cast("long").alias("bucket"))
    short = materialize(everywhere(short), "short")
    if not short.isEmpty():
        rest = best(_meet(everywhere(vectors), short, vectors, top + 1, block))
        found = found.join(short.select(F.col("id").alias("query")), "query", "left_anti").unionByName(rest)
    answers = found.join(vectors.select("id", "ids"), "id").select(
        F.col("query").alias("id"), F.explode("ids").alias("vec_id"), "score")
    answers = queries.join(answers, "id").filter(F.col("query_id") != F.col("vec_id"))
    answers = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
