"""Mixing sources to target weights by pivotal dependent rounding.

Each source's target (in words) over its size gives every one of its documents
the same fractional number of copies. The whole part is taken; the fractions
are rounded by weighted pivotal steps: two documents of a source trade words
(size times probability) until one probability is 0 or 1, the direction drawn
so that expectations are kept. Every step keeps the source's sum of words, so
only the last document left over can move it.

The steps run as a reduction tree. Documents are dealt to chunks of about
``chunk_rows`` by a hash of id, source and size (a hot source is spread over all
chunks). Rows that agree in these three are counted first and stand as one: they
take the whole copies of their sum, and the fraction left is one document.
In a chunk the documents of a source meet from large to small; what is left of
it is one document, and the left-overs of ``fan`` chunks meet in the next level,
and so on to one per source, which is rounded by a last draw. Each chunk is
drawn once: choosing among draws would change the probabilities of long
documents. A step settles the smaller of two documents, so the last one is
often the longest, and its draw would miss the target by many words. Therefore
a tail of the source's short documents stays out of this tree, just enough of
them to make up for either outcome of the last draw: what the draw adds or
takes is taken from or added to the tail's probabilities in proportion (on
average nothing, so every document keeps its expectation), and the tail goes
through a tree of its own, whose last document is short. The tail is chosen by
sizes and rates alone; a source without enough short documents has none and
can miss its target by its last document's words.
All draws are hashes of the seed and the row, and chunks depend on the data
only, so reruns and retried tasks agree.

One row per source reaches the driver to settle the targets.

Defined results: a null text has no words; a null source is a source of its
own, last in order. A document without words takes 0. Repeated rows share
the copies of their sum evenly. A very long text is one document like any other; other columns, whatever
their names, are carried along. An empty table gives an empty result. No document is
taken more than ``most`` (3) times.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardmarts.llm.common import col, fresh, materialize, spread, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
_BLOCK = 4_096  # equal rows handed out at a time
_STATE = "chunk long, pos long, source string, id long, no_id boolean, size long, rows long, whole long, p double, done boolean"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, most: float = 3.0) -> dict[str | None, float]:
    """Target words per source: shares by weight of all words, none above ``most`` times its size.

    Sources are ordered by code point, null last; the weights repeat. What a
    full source gives up is shared again by weight among the others.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target: dict[str | None, float] = {}
    left, rest = set(order), float(sum(sizes.values()))
    while left:
        unit = rest / math.fsum(weight[s] for s in left)
        full = [s for s in order if s in left and weight[s] * unit > most * sizes[s]]
        if not full:
            target |= {s: weight[s] * unit for s in left}
            break
        for s in full:
            target[s] = most * sizes[s]
            left.discard(s)
        rest -= math.fsum(target[s] for s in full)
    return target


def _draw(seed: int, *keys: int) -> float:
    """A number in [0, 1) from integers alone (splitmix64)."""
    x = seed & 0xFFFFFFFFFFFFFFFF
    for k in keys:
        x = (x ^ (k & 0xFFFFFFFFFFFFFFFF)) + 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        x = (x ^ x >> 27) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
        x ^= x >> 31
    return (x >> 11) / (1 << 53)


def pivotal_round(size: np.ndarray, p: np.ndarray, key: np.ndarray, seed: int, eps: float = 1e-9) -> np.ndarray:
    """Probabilities after weighted pivotal steps from left to right; at most one stays fractional.

    ``sum(size * p)`` is kept. All sizes must be positive.
    """
    p = p.copy()
    open_at = -1
    for j in np.flatnonzero((p > eps) & (p < 1 - eps)):
        if open_at < 0:
            open_at = j
            continue
        i = open_at
        si, sj = float(size[i]), float(size[j])
        give = min(si * (1 - p[i]), sj * p[j])  # words from j to i
        take = min(si * p[i], sj * (1 - p[j]))  # words from i to j
        if _draw(seed, int(key[i]), int(key[j])) < take / (give + take):
            p[i] += give / si
            p[j] -= give / sj
        else:
            p[i] -= take / si
            p[j] += take / sj
        for k in (i, j):
            p[k] = 0.0 if p[k] <= eps else 1.0 if p[k] >= 1 - eps else p[k]
        still = [k for k in (i, j) if 0 < p[k] < 1]
        open_at = still[0] if still else -1
    p[p <= eps] = 0.0
    p[p >= 1 - eps] = 1.0
    return p


def _round_group(pdf: pd.DataFrame, seed: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["source", "size", "no_id", "id", "chunk", "pos"], ascending=[True, False, True, True, True, True],
                          na_position="last", ignore_index=True, kind="stable")
    p = pdf["p"].to_numpy(copy=True)
    key = pdf["chunk"].to_numpy() * (1 << 32) + np.arange(len(pdf))  # each step its own draw, whatever the ids
    size = pdf["size"].to_numpy()
    source = pdf["source"]
    starts = np.flatnonzero(np.r_[True, ~((source == source.shift()) | (source.isna() & source.shift().isna())).to_numpy()[1:]])
    for a, b in zip(starts, np.r_[starts[1:], len(pdf)], strict=True):
        p[a:b] = pivotal_round(size[a:b], p[a:b], key[a:b], seed)
    return pdf.assign(p=p, done=(p == 0) | (p == 1))


def _step(size: Column) -> Column:
    """Steps of a fourth of a doubling."""
    return F.floor(4 * F.log2(F.greatest(size, F.lit(1))))


def _reduce_tree(state: DataFrame, chunk_rows: int, fan: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose p is 0 or 1 in the end, each source's last row with its p and the draw that settled it)."""
    chunks = -(-max(1, state.count()) // chunk_rows)
    state = state.select(F.pmod(F.col("deal"), F.lit(chunks)).alias("chunk"), F.lit(0).cast("long").alias("pos"), "source", "id", "no_id",
                         "size", "rows", "whole", "p", (F.col("p").isin(0.0, 1.0)).alias("done"))
    finished, levels = [], 0
    while True:
        rounded = materialize(
            state.filter(~F.col("done")).groupBy("chunk").applyInPandas(_rounder(seed + levels), _STATE), f"pivotal-{levels}")
        finished += [state.filter("done"), rounded.filter("done")]
        state = rounded.filter(~F.col("done")).withColumn("pos", F.col("chunk")).withColumn("chunk", F.floor(F.col("chunk") / fan))
        levels += 1
        if chunks == 1:
            break
        chunks = -(-chunks // fan)
    keep = ["source", "id", "no_id", "size", "rows", "whole", "p"]
    settled = F.pmod(F.xxhash64("id", "source", "size", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30) < F.col("p")
    return reduce_union([f.select(keep) for f in finished]), state.select(*keep, settled.cast("double").alias("settled"))


def _rounder(seed: int):
    return lambda pdf: _round_group(pdf, seed)


def group_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[float, ...] = WEIGHTS, most: float = 3.0, chunk_rows: int = 2_000, fan: int = 256,
                    seed: int = 20) -> DataFrame:
    """One row per id, source and size: its rows, source_size, target and the copies of all its rows together."""
    spark = docs.sparkSession
    sizes = materialize(docs.select(col(id_col).cast("long").alias("id"), col(source_col).cast("string").alias("source"),
                                    word_count(col(text_col)).alias("size"))
                        .groupBy("id", "source", "size").agg(F.count("*").alias("rows")), "sizes")
    per_source = {r["source"]: int(r["n"]) for r in sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("n")).collect()}
    target = source_targets(per_source, weights, most)
    # as an Arrow table it needs no Python workers
    rates = spark.createDataFrame(pa.table({
        "source": pa.array(per_source, pa.string()), "source_size": pa.array(per_source.values(), pa.int64()),
        "target": pa.array([target[s] for s in per_source], pa.float64()),
        "rate": pa.array([target[s] / n if n else 0.0 for s, n in per_source.items()], pa.float64())}))
    shared = F.broadcast(rates.withColumnRenamed("source", "name"))  # one row per source, already on the driver
    rated = sizes.join(shared, F.col("source").eqNullSafe(F.col("name")), "left").drop("name")
    # what the rows of a group take for certain, and the fraction of one copy that is left of all of them
    base = F.floor(F.col("rate") + 1e-12)
    extra = F.when(F.col("size") == 0, 0.0).otherwise(F.greatest(F.col("rate") - base, F.lit(0.0)) * F.col("rows"))
    certain = F.floor(F.col("extra") + 1e-12)
    rated = rated.withColumn("extra", extra).withColumn("whole", base * F.col("rows") + certain).withColumn(
        "p", F.greatest(F.col("extra") - certain, F.lit(0.0)))
    rated = materialize(rated, "rated")
    # the tail: single rows of the shortest sizes, up to what evens out the longest document's draw
    room = F.least(F.col("p"), 1 - F.col("p"))
    single = rated.filter((F.col("rows") == 1) & (F.col("p") > 0)).select("source", "size", room.alias("room"))
    steps = single.groupBy("source", _step(F.col("size")).alias("step")).agg(F.sum("size").alias("words"), F.min("room").alias("room"))
    longest = rated.filter("p > 0").groupBy("source").agg(F.max("size").alias("longest"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("step"))
    met = steps.withColumn("upto", upto).join(longest, steps["source"].eqNullSafe(longest["source"])).drop(longest["source"])
    enough = met.filter(F.col("upto") * F.col("room") >= 1.1 * F.col("longest"))
    tails = materialize(enough.groupBy("source").agg(F.min(F.struct("step", "upto", "room", "longest")).alias("t")).select(
        F.col("source").alias("name"), F.col("t.step").alias("step"),
        F.least(F.lit(1.0), 1.5 * F.col("t.longest") / F.col("t.room") / F.col("t.upto")).alias("part")), "tails")  # a row per source
    draw = F.pmod(F.xxhash64("id", "source", "size", F.lit(seed + 1)), F.lit(1 << 30)) / float(1 << 30)
    marked = rated.join(tails, F.col("source").eqNullSafe(F.col("name")), "left").drop("name")
    inside = (F.col("rows") == 1) & (F.col("p") > 0) & (_step(F.col("size")) <= F.col("step")) & (draw < F.col("part"))
    state = materialize(marked.select(
        F.xxhash64("id", "source", "size").alias("deal"), "source", F.coalesce("id", F.lit(0)).cast("long").alias("id"),
        F.col("id").isNull().alias("no_id"), "size", "rows", "whole", "p", F.coalesce(inside, F.lit(False)).alias("tail")), "fractions")
    done, last = _reduce_tree(state.filter(~F.col("tail")).drop("tail"), chunk_rows, fan, seed * 1009)
    # what the draw of a source's last document adds, in words
    off = last.groupBy("source").agg(F.sum((F.col("settled") - F.col("p")) * F.col("size")).alias("off"), F.max("size").alias("over"))
    tail = state.filter("tail").drop("tail")
    words = tail.groupBy("source").agg(F.sum("size").alias("words"), F.min(room).alias("room"))
    shift = off.join(words, off["source"].eqNullSafe(words["source"])).select(
        off["source"].alias("name"), F.when(F.col("words") * F.col("room") >= F.col("over"), F.col("off") / F.col("words")).otherwise(0.0).alias("shift"))
    shift = materialize(shift, "shifts")
    shifted = tail.join(shift, F.col("source").eqNullSafe(F.col("name")), "left").withColumn(
        "p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("p") - F.coalesce("shift", F.lit(0.0))))).drop("name", "shift")
    tail_done, tail_last = _reduce_tree(shifted, chunk_rows, fan, seed * 2003)
    rows = reduce_union([done, tail_done, *(x.drop("p").withColumnRenamed("settled", "p").select(done.columns) for x in (last, tail_last))])
    return rows.join(shared, F.col("source").eqNullSafe(F.col("name")), "left").select(
        F.when(~F.col("no_id"), F.col("id")).alias("id"), "source", "size", "rows", "source_size", "target",
        (F.col("whole") + F.round("p").cast("long")).alias("copies"))


def mix_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies (0 to ``most``).

    ``how``: weights, most, chunk_rows, fan and seed of ``group_decisions``.
    """
    groups = group_decisions(docs, id_col, text_col, source_col, **how)
    each = F.floor(F.col("copies") / F.col("rows"))
    one = (F.col("turn") < F.col("copies") - each * F.col("rows")).cast("long")
    return spread(groups, "rows", "equal-rows", _BLOCK).select("id", "source", "size", "source_size", "target", (each + one).cast("int").alias("copies"))


def reduce_union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix_decisions(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 20, **how) -> DataFrame:
    """The mix itself: ``docs`` with every row repeated as often as it is taken, columns as they were."""
    groups = group_decisions(docs, id_col, text_col, source_col, seed=seed, **how)
    size, ident, source = fresh(docs, "size_x"), fresh(docs, "id_x"), fresh(docs, "source_x")
    # rows that agree in id, source and size are interchangeable: each takes its turn in the sum of their copies
    total = groups.select(F.col("id").alias(ident), F.col("source").alias(source), F.col("size").alias(size), "copies", "rows")
    total = materialize(total.filter("copies > 0"), "copies")
    # two written tables: that of equal rows is mostly small or empty, and then the texts are not shuffled for it
    once, many = materialize(total.filter("rows = 1"), "copies-once"), materialize(total.filter("rows > 1"), "copies-many")
    packed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(id_col).cast("long").alias(ident),
                         col(source_col).cast("string").alias(source), word_count(col(text_col)).alias(size))

    def met(side: DataFrame) -> DataFrame:
        own = [packed[c].alias(c) for c in (ident, source, size)]
        return packed.join(side, [packed[c].eqNullSafe(side[c]) for c in (ident, source, size)]).select("row", *own, "copies", "rows")

    return _repeat(met(once).select("row", "copies").unionByName(_shared_copies(met(many), [ident, source, size])))


def _shared_copies(met: DataFrame, keys: list[str]) -> DataFrame:
    """(row, copies): the rows of a key take their copies in turn, in the order in which tasks have written them.

    Rows are numbered within the task that wrote them; the tasks' counts give each task its first number.
    """
    tied = materialize(met.withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "tied-rows")
    per_task = tied.groupBy(*keys, "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*keys).orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    start = materialize(per_task.select(*[F.col(k).alias(f"s_{k}") for k in keys], F.col("task").alias("s_task"),
                                        F.coalesce(before, F.lit(0)).alias("start")), "tied-starts")
    placed = tied.join(start, [F.col("task") == F.col("s_task"), *[F.col(k).eqNullSafe(F.col(f"s_{k}")) for k in keys]])
    turn = F.col("start") + F.row_number().over(Window.partitionBy(*keys, "task").orderBy("at")) - 1
    each = F.floor(F.col("copies") / F.col("rows"))
    extra = F.col("copies") - each * F.col("rows")
    return placed.withColumn("turn", turn).select("row", (each + (F.col("turn") < extra).cast("long")).alias("copies"))


def _repeat(rows: DataFrame) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return rows.filter("copies > 0").select("row", copy.alias("copy")).select("row.*")
