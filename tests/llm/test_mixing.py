import random

import numpy as np
import pandas as pd
from helpers import awkward, documents, empty, prose

from cardmarts.llm import mixing as M


def test_targets_follow_the_weights_and_the_cap():
    t = M.source_targets({"a": 10, "b": 1000, "c": 1000, None: 600})
    assert t["a"] == 30  # full at three times its size
    assert abs(sum(t.values()) - 2610) < 1e-6
    rest = 2610 - 30
    assert abs(t["b"] - rest * 2 / 8) < 1e-6 and abs(t["c"] - rest / 8) < 1e-6 and abs(t[None] - rest * 5 / 8) < 1e-6
    assert M.source_targets({}) == {}
    assert M.source_targets({"a": 0}) == {"a": 0}
    t = M.source_targets({"Z": 5, "a": 5, "\U00010000": 5, "\uffff": 5})  # by code point, not by UTF-16
    assert t["Z"] > t["a"] > t["\uffff"]


def test_pivotal_steps_keep_the_sum_and_are_unbiased():
    size = np.array([50, 40, 30, 20, 10, 5, 5, 3, 2, 1.0])
    p = np.full(10, 0.3)
    total = np.zeros(10)
    for seed in range(4000):
        q = M.pivotal_round(size, p, np.arange(10), seed)
        assert abs((size * q).sum() - (size * p).sum()) < 1e-6
        assert ((q > 0) & (q < 1)).sum() <= 1
        total += q
    assert np.abs(total / 4000 - 0.3).max() < 0.04


def test_sources_come_near_their_targets(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(1, 120)), "en", rng.choice(["a", "a", "a", "a", "b", "c", None])) for i in range(900)]
    docs = documents(spark, rows, 5)
    got = M.mix_decisions(docs, chunk_rows=100, fan=2).collect()  # several levels
    assert len(got) == 900
    by = {}
    for r in got:
        assert 0 <= r["copies"] <= 3
        s = by.setdefault(r["source"], [0, r["target"], r["source_size"], 0])
        s[0] += r["copies"] * r["size"]
        s[3] += r["size"]
    for taken, target, size, seen in by.values():
        assert size == seen
        assert abs(taken - target) <= 120
    again = M.mix_decisions(docs.repartition(2), chunk_rows=100, fan=2).collect()
    assert sorted((r["id"], r["copies"]) for r in again) == sorted((r["id"], r["copies"]) for r in got)


def test_long_documents_keep_their_probability(spark):
    # 60 pairs of sources at rates 0.2 and 1.8, each with one document that weighs a fifth of all the others
    rng = random.Random(6)
    rows, long_ids = [], {}
    for k in range(120):
        low = k % 2 == 0
        long_ids[len(rows)] = low
        sizes = [400] + [1 + 39 * i // 99 for i in range(99)]
        rows += [(len(rows) + i, "w " * n, "en", f"s{k:03d}") for i, n in enumerate(sizes)]
    rng.shuffle(rows)
    docs = documents(spark, rows)
    for chunk_rows, fan in ((100_000, 256), (2_000, 2)):  # one chunk; several levels
        got = {True: [], False: []}
        for seed in range(5):
            for r in M.mix_decisions(docs, weights=(0.2, 1.8), chunk_rows=chunk_rows, fan=fan, seed=seed).filter("size = 400").collect():
                got[long_ids[r["id"]]].append(r["copies"])
        assert len(got[True]) == len(got[False]) == 300
        assert abs(np.mean(got[True]) - 0.2) < 0.08  # over three standard errors
        assert abs(np.mean(got[False]) - 1.8) < 0.08


def test_equal_rows_stand_as_one(spark, monkeypatch):
    big = (1 << 60) + 1  # no double holds it
    rows = [(None, "same text here", "en", "a")] * 3_000 + [(big, "one two", "en", "a")] * 7
    rows += [(i, "w " * (1 + i % 9), "en", "ab"[i % 2]) for i in range(1_000)] + [(None, "w " * (10 + i % 30), "en", "b") for i in range(60)]
    docs = documents(spark, rows)
    monkeypatch.setattr(M, "_BLOCK", 100)
    groups = M.group_decisions(docs, chunk_rows=50).collect()
    assert len(groups) == 1_032 and sum(r["rows"] for r in groups) == len(rows)  # so a chunk holds the group in one row
    want = {(r["id"], r["source"], r["size"]): (r["rows"], r["copies"]) for r in groups}
    got = {}
    for r in M.mix_decisions(docs, chunk_rows=50).collect():
        got.setdefault((r["id"], r["source"], r["size"]), []).append(r["copies"])
    assert (big, "a", 2) in got
    for k, copies in got.items():
        assert (len(copies), sum(copies)) == want[k] and max(copies) - min(copies) <= 1 and 0 <= min(copies) <= max(copies) <= 3
    rate = next(r["target"] / r["source_size"] for r in groups if r["source"] == "a")
    assert abs(want[None, "a", 3][1] - 3_000 * rate) <= 1
    mixed = M.mix(docs, chunk_rows=50).groupBy("doc_id").count().collect()
    for i in (None, big):
        assert next(r["count"] for r in mixed if r["doc_id"] == i) == sum(c for k, (_, c) in want.items() if k[0] == i)


def test_null_ids_keep_their_probability():
    pdf = pd.DataFrame({"chunk": 0, "pos": 0, "source": "a", "id": 0, "no_id": True, "size": range(1, 41), "rows": 1, "whole": 0, "p": 0.3, "done": False})
    total = np.zeros(40)
    for seed in range(1_000):
        total += M._round_group(pdf, seed * 1009).sort_values("size")["p"].to_numpy()
    assert np.abs(total / 1_000 - 0.3).max() < 0.07


def test_mix_repeats_rows(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(0, 30)), "en", "ab"[i % 2]) for i in range(200)] + [(7, "same text", "en", "a")] * 5
    docs = documents(spark, rows)
    out = M.mix(docs)
    assert out.schema == docs.schema
    want = sum(r["copies"] for r in M.mix_decisions(docs).collect() if r["size"] > 0)
    assert out.filter("text <> ''").count() == want


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    got = M.mix_decisions(docs).collect()
    assert len(got) == docs.count()
    assert all(r["size"] == 0 for r in got if r["id"] in (1, 2, 3))
    assert M.mix(docs).schema == docs.schema
    assert M.mix(empty(spark)).count() == 0
    assert M.mix_decisions(empty(spark)).count() == 0
