import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from helpers import awkward, documents, empty

from pyspark.sql import functions as F

from cardmarts.llm import prob_minhash as M


def shingle_counts(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def jp(a, b):
    keys = a.keys() | b.keys()
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in keys) for d in a.keys() & b.keys())


def classes(rows, threshold=0.8):
    """rows: (place, text); equal texts together, texts at least as similar as the threshold linked."""
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sh = {i: shingle_counts(t) for i, t in rows}
    texts = {i: t or "" for i, t in rows}
    for a, b in combinations(parent, 2):
        if texts[a] == texts[b] or (sh[a].keys() & sh[b].keys() and jp(sh[a], sh[b]) >= threshold):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    out = defaultdict(set)
    for i in parent:
        out[find(i)].add(i)
    return {frozenset(x) for x in out.values()}


def found(spark, rows, **how):
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    out = defaultdict(set)
    kept = Counter()
    for r in M.near_duplicates(docs, **how).collect():
        out[r["class_id"]].add(r["id"])
        kept[r["class_id"]] += r["kept"]
        assert r["class_size"] >= 1
    assert set(kept.values()) <= {1}
    assert all(k == min(v) for k, v in out.items())
    return {frozenset(x) for x in out.values()}


def words(rng, n):
    return [rng.choice("abcdefgh") + rng.choice("ijklmnop") + rng.choice("qrstuvwx") for _ in range(n)]


def edited(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        w[rng.randrange(len(w))] = "edit" + str(rng.randrange(10**6))
    return w


@pytest.fixture(scope="module")
def family():
    rng = random.Random(7)
    rows = []
    origin = words(rng, 200)
    # copies near the original but not near each other
    rows += [" ".join(edited(rng, origin, 3)) for _ in range(40)] + [" ".join(origin)]
    chain = words(rng, 120)
    for _ in range(12):  # a chain: only neighbours are similar
        rows.append(" ".join(chain))
        chain = edited(rng, chain, 2)
    rows += [" ".join(words(rng, rng.randint(1, 60))) for _ in range(40)]
    rows += [" ".join(origin[:100] + words(rng, 100)) for _ in range(10)]  # half in common
    rows += ["a b c", "A  b c", "a b d", "", "", None, "same words again " * 40, "same words again " * 80]
    return list(enumerate(rows))


def test_classes_match_brute_force(spark, family):
    assert found(spark, family) == classes(family)


def test_links_off_the_leaders_are_found(spark, family):
    """With wide buckets almost everything meets; the leaders alone would miss links of the chain."""
    assert found(spark, family, bands=24, rows_per_band=1, rounds=1) == classes(family)


def test_bitmaps_bound_the_similarity(spark):
    rng = random.Random(11)
    base = words(rng, 80)
    texts = [" ".join(edited(rng, base, k % 6) + base[: k % 4 * 10]) for k in range(40)] + ["a b", "c d e f g h", "q " * 30]
    rows = spark.createDataFrame([(bytearray([i]), t) for i, t in enumerate(texts)], "digest binary, text string")
    v = M.shingle_vectors(rows).cache()
    for t in (0.3, 0.6, 0.8, 0.95):
        got = {(r[0][0], r[1][0]) for r in v.alias("x").join(v.alias("y"), M.may_reach("x", "y", t)).select("x.digest", "y.digest").collect()}
        for a in range(len(texts)):
            for b in range(len(texts)):
                if jp(shingle_counts(texts[a]), shingle_counts(texts[b])) >= t:
                    assert (a, b) in got
    assert len(got) < len(texts) ** 2 / 2


def test_probability_jaccard_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = Counter(rng.integers(0, 30, 40).tolist()), Counter(rng.integers(10, 40, 30).tolist())
        cut = lambda c: (np.array(sorted(c), np.uint64), np.array([float(c[k]) for k in sorted(c)]))
        assert abs(M.probability_jaccard(*cut(a), *cut(b)) - jp(a, b)) < 1e-12


def test_registers_estimate_it():
    a = Counter({k: 1 + k % 3 for k in range(300)})
    b = Counter({k: 1 + k % 4 for k in range(60, 340)})
    doc = np.repeat([0, 1], [len(a), len(b)])
    element = M.mix64(np.array([*a, *b], np.uint64))
    weight = np.array([*a.values(), *b.values()], float)
    who = M.prob_minhash(doc, element, weight, 2, 4999)
    assert abs((who[0] == who[1]).mean() - jp(a, b)) < 0.03


def test_shingles_have_five_words_and_count():
    doc, h, w = M.shingles(["a b c d e f", None, "", "a b c d e a b c d e a b c d e", "x y"])
    assert Counter(doc.tolist()) == {0: 2, 3: 5, 4: 1}
    assert sorted(w[doc == 3].tolist()) == [2, 2, 2, 2, 3]
    one = M.shingles(["A b  c\td e"])[1]
    assert one[0] == h[doc == 0][0] or one[0] == h[doc == 0][1]


def test_rows_and_columns_stay(spark):
    docs = awkward(spark)
    out = M.near_dedup(docs)
    assert out.schema == docs.schema
    got = M.near_duplicates(docs)
    assert got.count() == docs.count()
    assert out.count() == got.filter("kept").count()
    assert M.near_dedup(empty(spark)).count() == 0
    assert M.near_duplicates(empty(spark)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    nodes = [bytes([rng.randrange(256) for _ in range(8)]) for _ in range(80)]
    links = [(nodes[k], nodes[k + 1]) for k in range(0, 59)] + [(nodes[60], nodes[k]) for k in range(61, 75)]
    df = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in links], "a binary, b binary")
    got = defaultdict(set)
    for r in M.components(df).collect():
        got[bytes(r["root"])].add(bytes(r["node"]))
    assert sorted(map(len, got.values())) == [15, 60]


def test_a_copy_is_compared_a_few_times(spark, monkeypatch):
    """A large group of near copies shares its leaders over the buckets: some five leaders for 32 buckets."""
    rng = random.Random(12)
    origin = words(rng, 200)
    rows = list(enumerate([" ".join(edited(rng, origin, 1)) for _ in range(150)]))
    made = []
    verify = M._Verifier.verify

    def counted(self, pairs, name):
        got = verify(self, pairs, name)
        made.append((name, got.count()))
        return got

    monkeypatch.setattr(M._Verifier, "verify", counted)
    assert len(found(spark, rows)) == 1
    assert sum(n for _, n in made) <= 6 * len(rows), made


def test_prefixes_lose_no_pair_of_long_texts(spark):
    rng = random.Random(13)
    base = words(rng, 2_500)
    texts = [" ".join(edited(rng, base, k * 12)) for k in range(0, 14, 2)] + [" ".join(words(rng, 2_500)) for _ in range(2)]
    texts += [" ".join(base[:2_000] + words(rng, 500)) for _ in range(2)] + [" ".join(base[:400] * 3 + base[400:])]
    rows = spark.createDataFrame([(bytearray([i]), t) for i, t in enumerate(texts)], "digest binary, text string")
    vectors = M.shingle_vectors(rows).cache()
    members = rows.select("digest", F.col("digest").alias("root"))
    cut = [M.shingles([t])[1:] for t in texts]  # the exact measure, itself tested against the sum over pairs
    like = {(a, b): M.probability_jaccard(*cut[a], *cut[b]) for a in range(len(texts)) for b in range(a + 1, len(texts))}
    for threshold in (0.8, 0.6):
        pairs = M.prefix_pairs(members, vectors, threshold, block=3).select("a", "b").distinct().collect()
        got = {(r[0][0], r[1][0]) for r in pairs}
        linked = {p for p, sim in like.items() if sim >= threshold}
        assert linked and linked <= got
    assert len(got) < len(texts) * (len(texts) - 1) / 2


def test_long_texts_are_hashed_in_parts(monkeypatch):
    rng = random.Random(14)
    texts = [" ".join(words(rng, n)) for n in (900, 3, 0, 50)] + [None, "ΟΔΟΣ ΑΣ\u2003x\ny " * 40]
    whole = M.shingles(texts)
    for size in (1, 64, 1_000):
        monkeypatch.setattr(M, "BYTES", size)
        assert all((a == b).all() for a, b in zip(whole, M.shingles(texts), strict=True))
