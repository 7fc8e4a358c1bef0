import random

import corpus_pipeline as C
from helpers import awkward, documents, empty, prose

from cardmarts.llm.common import materialize


def through(spark, docs):
    for name, stage in C.STAGES:
        out = materialize(stage(spark, docs, ""), f"test-{name}")
        if name != C.STAGES[-1][0]:
            assert out.schema == docs.schema
        docs = out
        yield name, docs


def test_every_stage_takes_effect(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 80), "en", "ab"[i % 2]) for i in range(60)]
    near = rows[5][1].replace(rows[5][1].split()[40], "changed", 1)
    rows += [(100, rows[3][1].upper(), "en", "a"), (101, near, "en", "b"), (102, "12 34", "en", "a"), (103, None, "en", "a")]
    out = dict(through(spark, documents(spark, rows)))
    ids = {k: sorted({r["doc_id"] for r in v.select("doc_id").collect()}) for k, v in out.items()}
    assert 102 not in ids["language_id"] and 103 not in ids["language_id"] and len(ids["language_id"]) == 62
    assert 3 not in ids["exact_dedup"] and 100 in ids["exact_dedup"] and len(ids["exact_dedup"]) == 61
    assert 101 not in ids["near_dedup"] and 5 in ids["near_dedup"] and len(ids["near_dedup"]) == 60
    assert set(ids["mixing"]) <= set(ids["near_dedup"])
    last = out["sentencepiece"]
    assert last.columns == ["doc_id", "ids", "n_ids", "decoded_sha256"]
    assert last.count() == out["mixing"].count()


def test_awkward_and_empty(spark):
    for docs in (awkward(spark), empty(spark)):
        for _ in through(spark, docs):
            pass
