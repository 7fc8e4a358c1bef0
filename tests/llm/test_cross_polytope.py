import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardmarts.llm import cross_polytope as X

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec string, bucket int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", 2) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, query, top=5):
    ok = {}
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok.setdefault((i, tuple(v)), None)
    out = {}
    for q, qv in ok:
        if q % query:
            continue
        a = np.array(qv, np.float32).astype(float)
        best = {}
        for i, v in ok:
            b = np.array(v, np.float32).astype(float)
            if i != q and len(b) == len(a):
                best[i] = max(best.get(i, -2), float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))))
        out[q] = sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:top]
    return out


def check(spark, rows, query=10, least=0.9, **how):
    got = {}
    for r in X.nearest(frame(spark, rows), F.col("id") % query == 0, **how).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = brute(rows, query)
    hits = total = 0
    for q, best in want.items():
        mine = [got.get(q, {})[k] for k in sorted(got.get(q, {}))]
        assert len(mine) == len(best)
        assert [k for k in sorted(got.get(q, {}))] == list(range(1, len(best) + 1))
        assert all(a[1] >= b[1] - 1e-12 for a, b in zip(mine, mine[1:], strict=False))
        hits += len({m[0] for m in mine} & {b[0] for b in best})
        total += len(best)
    assert set(got) == {q for q in want if want[q]}
    assert not total or hits / total >= least
    return got, want


def vectors(n, d, seed=0):
    return [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32))]


def test_recall_against_brute_force(spark):
    check(spark, vectors(600, 24), block=64)


def test_two_hashes_and_odd_dimension(spark):
    check(spark, vectors(300, 13, 1), hashes=2, probes=200, least=0.85)


def test_hot_vector_ties_and_exact_scores(spark):
    rows = vectors(60, 8, 2)
    rows += [(1000 + k, rows[0][1]) for k in range(300)]  # one vector holds most rows
    got, want = check(spark, rows, block=16)
    for q in want:
        if q >= 1000 or q == 0:
            assert [v for v, _ in (got[q][k] for k in range(1, 6))] == [b[0] for b in want[q]]
            assert abs(got[q][1][1] - 1) < 1e-12


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (10, None), (20, []), (30, [0.0, 0.0]), (40, [nan, 1.0]), (50, [inf, 1.0]), (60, [None, 1.0]),
            (70, [1.0, 2.0, 3.0]), (80, [0.5, 0.5]), (0, [1.0, 0.0]), (3, [2.0, 0.1])]
    got, _ = check(spark, rows)
    assert set(got) == {0, 80}  # 70 has no candidate of its length
    assert {v for v, _ in got[0].values()} == {3, 80}


def test_empty_and_few(spark):
    assert X.nearest(frame(spark, []), F.col("id") % 10 == 0).count() == 0
    assert X.nearest(frame(spark, [(0, [1.0, 2.0])]), F.col("id") % 10 == 0).count() == 0
    check(spark, vectors(7, 16, 3), tables=1, probes=1, least=1.0)  # too few found: searched exactly


def test_rotation_keeps_lengths_and_probes_start_at_home():
    x = np.random.default_rng(1).normal(size=(50, 20))
    assert np.allclose(np.linalg.norm(X.rotate(x, 3), axis=1), np.linalg.norm(x, axis=1))
    p = X.likeliest(x, 3, 2, 30)
    assert (p[:, :1] == X.likeliest(x, 3, 2, 1)).all() and all(len(set(r)) == 30 for r in p)


@pytest.mark.parametrize("sf, hashes", [("sf0.01", 1), ("sf0.1", 1), ("sf0.1", 2)])
def test_recall_on_the_given_vectors(spark, sf, hashes):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    got = defaultdict(list)
    for r in X.nearest(df, F.col("id") % 50 == 0, hashes=hashes).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = total = 0
    for k in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[k]
        score[k] = -9
        best = set(ids[np.argsort(-score, kind="stable")[:5]].tolist())
        mine = got[int(ids[k])]
        assert len(mine) == 5
        for v, s in mine:
            assert abs(s - score[np.flatnonzero(ids == v)[0]]) < 1e-12
        hits, total = hits + len(best & {v for v, _ in mine}), total + 5
    assert hits / total >= 0.9, hits / total


def test_large_components_and_equal_scores(spark):
    rows = [(0, [1e160, 0.0]), (1, [2e200, 1e190]), (2, [0.0, 5.0]), (3, [3.0, 3.0]), (4, [1e-200, 1e-200]), (5, [-1.0, 0.0])]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in X.nearest(wide, F.col("id") == 0).collect()}
    assert [got[0, k][0] for k in range(1, 6)] == [1, 3, 4, 2, 5]
    assert abs(got[0, 1][1] - 1) < 1e-9 and got[0, 2][1] == got[0, 3][1]


def test_unmeasured_reach_must_be_given(spark):
    with pytest.raises(ValueError):
        X.nearest(frame(spark, vectors(5, 4)), F.col("id") == 0, hashes=3)
