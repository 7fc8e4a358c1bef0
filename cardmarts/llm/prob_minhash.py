"""Near-duplicate groups by ProbMinHash, banding and exact verification.

A document is the set of its five-word shingles weighted by how often they
occur; two documents are similar by their probability Jaccard

    J_P(u, v) = sum over d in both of 1 / sum over e of max(u_e / u_d, v_e / v_d)

which is the plain Jaccard similarity where all weights agree and does not
change when a text is repeated whole.

Signing: every shingle starts a Poisson process with its weight as rate; each
arrival meets a register (all of them once, in pseudo-random order), and a
register keeps the earliest. A shingle stops as soon as its next arrival is
later than all registers, so most shingles make one or two steps. Two
documents agree in a register with probability J_P. ``rows`` registers make a
band; documents that share a band are candidates.

Texts that are equal are signed alike and stand as one. In every band bucket
all members are compared with one leader, then with the member most like the
leader (the original of a group of edited copies), for ``rounds`` rounds, so a
bucket costs as many comparisons as it has members, not pairs. What is then
still not connected inside a bucket is searched by prefixes. With shares a and
b of the weights of u and v known to be apart, J_P is at most
1 / (1 / (1 - a) + b / (1 - b)), so linked texts share 0.8 of each one's weight
or more. In one order of all shingles, rare ones first, the first shingle that
two linked texts share lies within the first 0.2 of each one's weight: only
these are indexed, only texts that meet there are looked at, and the weights
before that place and bitmaps of the shingles (one of u whose bit v lacks is
not in v) bound the similarity once more. All bounds are exact, so no link found
by the bands is lost. Every link is verified exactly, and classes are the
connected components of the links.

The leader of a bucket is its member with the smallest hash, so the buckets of
a group of copies share few leaders and a copy is compared some five times,
not once for each of its 32 buckets. A leader of many copies is spread over
tasks in the comparison.

The texts are read twice: once to sign, once to get the shingles of those
documents that have a candidate; a Bloom filter bounded by ``max_bits`` keeps
all others out of the shuffle. Components are found by contraction, one small
table a round, in the shared folder.

Words are the lower-cased text's runs of non-space characters. Defined
results: a text of fewer than five words is one shingle of all its words; a
null text or one without words is a class of its own row's text (equal ones
together). Null ids are carried; repeated rows fall in one class. An empty
table gives an empty result. Other columns are carried along untouched. A very
long text is split into words in parts; beyond that about 80 bytes a word are
held while it is signed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardmarts.llm.common import Scratch, byte_slices, col, hot_join, materialize, one_row, releasing, spread, table
from cardmarts.llm.exact_dedup import probe, repeat_filter

SHINGLE = 5
BYTES = 1 << 20  # of text worked on at a time in a task
BITMAP_WORDS = 16  # of 64 bits
_PAIRS = 1_000  # comparisons with one text in a task
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finish, on an array of uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Number of words of each text, and all words' hashes."""
    count, found, held = np.zeros(len(texts), np.int64), [np.empty(0, np.uint64)], []

    def flush() -> None:
        if held:
            found.append(pd.util.hash_array(np.array(held, dtype=object), categorize=True).astype(np.uint64))
            held.clear()

    for k, t in enumerate(texts):
        at = 0
        while t and at < len(t):
            end = at + BYTES
            while end < len(t) and not t[end].isspace():
                end += 1
            words = t[at:end].lower().split()
            count[k] += len(words)
            held += words
            at = end
            if len(held) > BYTES // 4:
                flush()
    flush()
    return count, np.concatenate(found)


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document's place, shingle hash, weight), sorted by document and hash."""
    count, h = word_hashes(texts)
    if not len(h):
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.float64)
    # short texts are filled up with a hash of nothing, so that each gives one shingle
    room = np.where(count > 0, np.maximum(count, SHINGLE), 0)
    padded = np.zeros(int(room.sum()), np.uint64)
    start = np.concatenate([[0], np.cumsum(room)[:-1]])
    word_doc = np.repeat(np.arange(len(texts)), count)
    at = np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count) + start[word_doc]
    padded[at] = h
    n = np.maximum(room - SHINGLE + 1, 0)
    doc = np.repeat(np.arange(len(texts)), n)
    first = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + start[doc]
    s = np.zeros(len(first), np.uint64)
    for k in range(SHINGLE):
        s += mix64(padded[first + k] + _ODD[k]) * _ODD[k]
    s = mix64(s)
    order = np.lexsort((s, doc))
    doc, s = doc[order], s[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    places = np.flatnonzero(new)
    return doc[places], s[places], np.diff(np.append(places, len(s))).astype(np.float64)


def prob_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, m: int) -> np.ndarray:
    """The winning element of each of ``m`` (prime) registers per document."""
    when = np.full(docs * m, np.inf)
    who = np.zeros(docs * m, np.uint64)
    latest = np.full(docs, np.inf)
    step = mix64(element + np.uint64(1)) % np.uint64(m - 1) + np.uint64(1)
    at = mix64(element + np.uint64(2)) % np.uint64(m)
    t = np.zeros(len(element))
    for k in range(m):
        draw = np.uint64((3 + k) * int(_ODD[0]) & 0xFFFFFFFFFFFFFFFF)
        u = (mix64(element + draw) >> np.uint64(11)).astype(np.float64) / (1 << 53)
        # arrivals without replacement: the rest of the registers share the rate
        t = t - np.log1p(-u) / weight * (m / (m - k))
        on = t < latest[doc]
        doc, element, weight, step, at, t = doc[on], element[on], weight[on], step[on], at[on], t[on]
        if not len(doc):
            break
        slot = doc * m + at.astype(np.int64)
        np.minimum.at(when, slot, t)
        won = when[slot] == t
        who[slot[won]] = element[won]
        at = (at + step) % np.uint64(m)
        open_docs = np.unique(doc)
        latest[open_docs] = when.reshape(docs, m)[open_docs].max(axis=1)
    return who.reshape(docs, m)


def band_keys(who: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket per band."""
    cut = who[:, : bands * rows].reshape(len(who), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * _ODD[1], cut.shape[:2]).copy()
    for r in range(rows):
        key = mix64(key * _ODD[2] + cut[:, :, r])
    return key.view(np.int64)


def _prime(least: int) -> int:
    while any(least % k == 0 for k in range(2, int(least**0.5) + 1)):
        least += 1
    return least


def signed(rows: DataFrame, bands: int, rows_per_band: int) -> DataFrame:
    """(id, digest, bands) of (id, digest, text); no bands for a text without words."""
    m = _prime(bands * rows_per_band)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            for part in byte_slices(batch, "text", BYTES):
                doc, element, weight = shingles(part.column("text").to_pylist())
                keys = band_keys(prob_minhash(doc, element, weight, part.num_rows, m), bands, rows_per_band)
                has = np.zeros(part.num_rows, bool)
                has[doc] = True
                ends = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[has].ravel())).cast(kind)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("digest"), lists], names=["id", "digest", "bands"])

    return rows.select("id", "digest", "text").mapInArrow(releasing(run), "id long, digest binary, bands array<long>")


def shingle_vectors(rows: DataFrame) -> DataFrame:
    """(digest, hashes, weights, bits, mass) of (digest, text).

    Sorted 64-bit hashes and their counts as bytes, a bitmap of the hashes and the sum of the counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", BYTES):
                n = part.num_rows
                doc, element, weight = shingles(part.column("text").to_pylist())
                cut = np.searchsorted(doc, np.arange(n + 1))
                bits = np.zeros((n, BITMAP_WORDS), np.uint64)
                place = (element >> np.uint64(8)) % np.uint64(64 * BITMAP_WORDS)
                np.bitwise_or.at(bits, (doc, (place >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (place & np.uint64(63)))
                mass = np.bincount(doc, weights=weight, minlength=n)
                bits = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BITMAP_WORDS), pa.array(bits.view(np.int64).ravel()))
                parts = [(element[x:y].tobytes(), weight[x:y].astype(np.float32).tobytes()) for x, y in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), pa.array([p[0] for p in parts], pa.binary()),
                     pa.array([p[1] for p in parts], pa.binary()), bits, pa.array(mass)],
                    names=["digest", "hashes", "weights", "bits", "mass"])

    return rows.select("digest", "text").mapInArrow(
        releasing(run), "digest binary, hashes binary, weights binary, bits array<long>, mass double")


def may_reach(x: str, y: str, threshold: float) -> Column:
    """Can two aliased rows with ``bits`` and ``mass`` have a J_P of ``threshold``? An exact upper bound."""
    apart = lambda a, b: F.expr(" + ".join(f"bit_count({a}.bits[{k}] & ~{b}.bits[{k}])" for k in range(BITMAP_WORDS)))
    u, v = F.col(f"{x}.mass") - apart(x, y), F.col(f"{y}.mass") - apart(y, x)  # weight that may be shared
    a, b = F.col(f"{x}.mass"), F.col(f"{y}.mass")
    least = threshold - 1e-9
    return (u * v >= least * (a * v + (b - v) * u)) & (u * v >= least * (b * u + (a - u) * v))


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """J_P of two weighted sets given as sorted hashes and weights, in O(n log n)."""
    if not len(a) or not len(b):
        return 0.0
    every = np.union1d(a, b)
    u, v = np.zeros(len(every)), np.zeros(len(every))
    u[np.searchsorted(every, a)] = wa
    v[np.searchsorted(every, b)] = wb
    both = (u > 0) & (v > 0)
    with np.errstate(divide="ignore"):
        ratio = np.where(v > 0, u / np.where(v > 0, v, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    ratio, u, v, both = ratio[order], u[order], v[order], both[order]
    # u_e / u_d is the larger term where e's ratio is at least d's, v_e / v_d elsewhere
    v_below, u_from = np.concatenate([[0.0], np.cumsum(v)]), np.concatenate([np.cumsum(u[::-1])[::-1], [0.0]])
    k = np.searchsorted(ratio, ratio[both], side="left")
    return float((1 / (u_from[k] / u[both] + v_below[k] / v[both])).sum())


@F.arrow_udf(T.DoubleType())
def _similarity(ha: pa.Array, wa: pa.Array, hb: pa.Array, wb: pa.Array) -> pa.Array:
    cut = lambda x, kind: np.frombuffer(x.as_py(), dtype=kind)
    return pa.array([probability_jaccard(cut(a, np.uint64), cut(c, np.float32).astype(float), cut(b, np.uint64), cut(d, np.float32).astype(float))
                     for a, c, b, d in zip(ha, wa, hb, wb, strict=True)], pa.float64())


def text_key(text: Column) -> Column:
    """Identity of a text: 16 bytes."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def components(links: DataFrame, save=materialize) -> DataFrame:
    """(node, root) for every node of the links (a, b), root being the same for connected nodes.

    Each round hangs every node on its smallest neighbour and contracts the
    links. Nodes are digests, so their order is random and the rounds few.
    """
    edges = save(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        up = save(edges.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("up")), "parents")
        if roots is None:
            roots = up.select("node", F.col("up").alias("root"))
        else:
            moved = up.select(F.col("node").alias("root"), "up")
            roots = save(roots.join(moved, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        left, right = (up.select(F.col("node").alias(x), F.col("up").alias(f"{x}_up")) for x in "ab")
        edges = save(edges.join(left, "a").join(right, "b").select(F.col("a_up").alias("a"), F.col("b_up").alias("b"))
                            .filter("a <> b").distinct(), "edges")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


class _Verifier:
    """Exact similarities of pairs (a, b) of digests; shingles are made once per document that needs them."""

    def __init__(self, docs: DataFrame, max_bits: int, save):
        self.docs, self.max_bits, self.save = docs, max_bits, save
        self.vectors = self.known = None

    def prepare(self, members: DataFrame) -> None:
        """Shingles of all members (digest): the only documents whose texts are shuffled."""
        wanted = self.save(members.select("digest").distinct(), "wanted")
        rows = probe(self.docs, *repeat_filter(wanted, self.max_bits, 1)).filter("maybe").drop("maybe")
        # one text for each digest leaves a task, however many rows have it
        once = rows.groupBy("digest").agg(F.first("text").alias("text")).join(wanted, "digest", "left_semi")
        self.vectors = self.save(shingle_vectors(once), "shingles")

    def verify(self, pairs: DataFrame, name: str) -> DataFrame:
        """(a, b, sim) of the distinct pairs with a < b that are not known yet; remembers them."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
        if self.known is not None:
            pairs = pairs.join(self.known.select("a", "b"), ["a", "b"], "left_anti")
        pairs = self.save(pairs, f"{name}-pairs")
        left = self.vectors.select(F.col("digest").alias("a"), F.col("hashes").alias("ha"), F.col("weights").alias("wa"))
        right = self.vectors.select(F.col("digest").alias("b"), F.col("hashes").alias("hb"), F.col("weights").alias("wb"))
        got = hot_join(hot_join(pairs, left, "a", per=_PAIRS), right, "b", per=_PAIRS, counted=pairs)
        got = got.select("a", "b", _similarity("ha", "wa", "hb", "wb").alias("sim"))
        got = self.save(got, name)
        self.known = got if self.known is None else self.known.unionByName(got)
        return got

    def both_ways(self) -> DataFrame:
        k = self.known
        return k.select("a", "b", "sim").union(k.select("b", "a", "sim"))


def _entries(rows: DataFrame) -> DataFrame:
    """(digest, shingle, weight) of (digest, hashes, weights)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, hashes, weights in zip(*(batch.column(c) for c in ("digest", "hashes", "weights")), strict=True):
                h, w = np.frombuffer(hashes.as_py(), np.int64), np.frombuffer(weights.as_py(), np.float32)
                for a in range(0, len(h), 100_000):
                    part = h[a:a + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.repeat(digest, len(part)), pa.array(part), pa.array(w[a:a + 100_000].astype(np.float64))],
                                                     names=["digest", "shingle", "weight"])

    return rows.select("digest", "hashes", "weights").mapInArrow(releasing(run), "digest binary, shingle long, weight double")


def prefix_pairs(members: DataFrame, vectors: DataFrame, threshold: float, save=materialize, block: int = 1_000) -> DataFrame:
    """Pairs (a, b) of ``members`` (digest, root) with different roots that exact bounds allow to reach ``threshold``.

    A shingle that many members have at their front is dealt out in blocks of about ``block`` members.
    """
    known = save(members.join(vectors, "digest"), "rest-shingles")
    entries = save(_entries(known), "entries")
    rarity = entries.groupBy("shingle").agg(F.count("*").alias("n"))
    order = Window.partitionBy("digest").orderBy("n", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    front = entries.join(rarity, "shingle").withColumn("before", F.coalesce(F.sum("weight").over(order), F.lit(0.0)))
    front = front.join(known.select("digest", "root", "bits", "mass"), "digest").withColumn("apart", F.col("before") / F.col("mass"))
    front = save(front.filter((F.col("apart") <= 1 - threshold + 1e-9) & (F.col("n") > 1)).select(
        "shingle", "n", "digest", "root", "bits", "mass", "apart"), "prefixes")
    meet = save(front.groupBy("shingle").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"), F.min("root").alias("lo"), F.max("root").alias("hi"))
                .filter("lo <> hi").select("shingle", "parts"), "meeting")
    front = front.join(meet, "shingle")
    x = front.withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int")).alias("x")
    y = front.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("y")
    share = lambda a, b: 1 / (1 - F.col(f"{a}.apart")) + F.col(f"{b}.apart") / (1 - F.col(f"{b}.apart")) <= 1 / threshold + 1e-9
    pairs = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.digest") < F.col("y.digest"))
                   & (F.col("x.root") != F.col("y.root")) & share("x", "y") & share("y", "x") & may_reach("x", "y", threshold))
    return pairs.select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b"))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, bands: int = 32,
                 rows_per_band: int = 6, rounds: int = 2, max_bits: int = 1 << 26) -> tuple[DataFrame, DataFrame]:
    """(id, digest) of every row, and (digest, root) of every text that is linked to a different one."""
    own = Scratch(docs.sparkSession)
    try:
        return _near_classes(docs, id_col, text_col, threshold, bands, rows_per_band, rounds, max_bits, own.save)
    finally:
        own.close()


def _near_classes(docs: DataFrame, id_col: str, text_col: str, threshold: float, bands: int, rows_per_band: int, rounds: int,
                  max_bits: int, save) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(col(id_col).cast("long").alias("id"), text_key(col(text_col)).alias("digest"),
                       F.coalesce(col(text_col), F.lit("")).alias("text"))
    signs = save(signed(rows, bands, rows_per_band), "signatures")
    once = signs.filter(F.size("bands") > 0).groupBy("digest").agg(F.first("bands").alias("bands"))
    entries = save(once.select("digest", F.explode("bands").alias("bucket")), "bands")
    order = F.struct(F.xxhash64("digest").alias("h"), F.col("digest"))
    leaders = save(entries.groupBy("bucket").agg(F.min(order).alias("first"), F.count("*").alias("n"))
                          .filter("n > 1").select("bucket", F.col("first.digest").alias("lead")), "leaders")
    members = save(hot_join(entries, leaders, "bucket"), "members")
    check = _Verifier(rows.select("digest", "text"), max_bits, save)
    check.prepare(members)
    check.verify(members.select(F.col("lead").alias("a"), F.col("digest").alias("b")), "round-0")

    def linked() -> DataFrame:
        return components(check.known.filter(F.col("sim") >= threshold - 1e-9), save)

    def open_buckets(members: DataFrame, roots: DataFrame) -> DataFrame:
        """Members (with their root) of the buckets that hold more than one component."""
        placed = members.join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
        placed = save(placed, "rooted")
        parted = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("bucket")
        return save(hot_join(placed, save(parted, "parted"), "bucket"), "open")

    def with_distance(members: DataFrame, lead: str, out: str) -> DataFrame:
        sims = check.both_ways().select(F.col("a").alias(lead), F.col("b").alias("digest"), (1 - F.col("sim")).alias(out))
        return members.join(sims, [lead, "digest"], "left").withColumn(
            out, F.when(F.col(lead) == F.col("digest"), 0.0).otherwise(F.col(out)))

    roots = linked()
    left = open_buckets(members, roots).withColumnRenamed("lead", "lead0")
    leads = 1
    while leads <= rounds and not left.isEmpty():
        # the member most like the last leader: the original of a group of edited copies is near to all of them
        far = save(with_distance(left, f"lead{leads - 1}", "d"), "distances")
        centre = far.filter(F.col("digest") != F.col(f"lead{leads - 1}")).groupBy("bucket").agg(
            F.min(F.struct(F.coalesce("d", F.lit(2.0)).alias("d"), F.col("digest"), F.col("root"))).alias("best"))
        centre = save(centre.select("bucket", F.col("best.digest").alias(f"lead{leads}"), F.col("best.root").alias("lead_root")), "centres")
        met = left.join(centre, "bucket")
        check.verify(met.filter(F.col("root") != F.col("lead_root")).select(F.col(f"lead{leads}").alias("a"), F.col("digest").alias("b")), f"round-{leads}")
        roots = linked()
        left = open_buckets(met.drop("root", "lead_root"), roots)
        leads += 1
    if not left.isEmpty():
        members = save(left.select("digest", "root").distinct(), "rest")
        check.verify(prefix_pairs(members, check.vectors, threshold, save), "rest-pairs")
        roots = linked()
    ids = materialize(signs.select("id", "digest"), "near-ids")
    roots = materialize(roots.select(F.col("node").alias("digest"), "root"), "near-roots")
    return ids, roots


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """id, digest, class_id (the smallest id of the class), class_size and kept (one row of each class) per row."""
    ids, roots = near_classes(docs, id_col, text_col, **how)
    same = materialize(ids.groupBy("digest", "id").agg(F.count("*").alias("n")), "counted-ids")
    rooted = materialize(hot_join(same, roots, "digest", "left").withColumn("root", F.coalesce("root", "digest")), "rooted-ids")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("digest"))).alias("top")
    classes = materialize(rooted.groupBy("root").agg(first, F.sum("n").alias("class_size")).select(
        "root", F.col("top.id").alias("class_id"), F.col("top.digest").alias("top"), "class_size"), "classes")
    rows = spread(hot_join(rooted, classes, "root"), "n", "equal-ids")
    best = F.col("id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("top")) & (F.col("turn") == 0)
    return rows.select("id", "digest", "class_id", "class_size", best.alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 26, **how) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with their columns as they were.

    Rows of classes of one pass straight through; only possible members of larger classes are shuffled.
    """
    decided = near_duplicates(docs, id_col, text_col, max_bits=max_bits, **how)
    many = materialize(decided.filter("class_size > 1"), "decided")
    packed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), text_key(col(text_col)).alias("digest"),
                         col(id_col).cast("long").alias("id"))
    rows = probe(packed, *repeat_filter(materialize(many.select("digest").distinct(), "member-texts"), max_bits, 1))
    alone = rows.filter(~F.col("maybe")).select("row.*")
    # each (digest, id) is kept or dropped as a whole but for equal rows, of which one stays
    verdict = materialize(many.groupBy("digest", "id").agg(F.max("kept").alias("kept"), F.count("*").alias("ties")), "verdicts")
    v = verdict.select(F.col("digest").alias("v_digest"), F.col("id").alias("v_id"), "kept", "ties")
    met = rows.filter("maybe").join(v, (F.col("digest") == F.col("v_digest")) & F.col("id").eqNullSafe(F.col("v_id")), "left")
    plain = met.filter("kept IS NULL OR (kept AND ties = 1)").select("row.*")
    tied = one_row(met.filter("kept AND ties > 1"), "digest", "row")
    return alone.unionByName(plain).unionByName(tied)


def op2_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")
