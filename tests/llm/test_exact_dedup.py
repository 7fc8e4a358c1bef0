import hashlib
from collections import defaultdict

import pytest
from helpers import awkward, documents, empty

from cardmarts.llm import exact_dedup as D

LOWER = str.maketrans(D.UPPER, D.UPPER.lower())


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r["text"] or "").translate(LOWER)].append(r["doc_id"])
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def test_decisions_match_brute_force(spark):
    docs = awkward(spark)
    rows = docs.collect()
    want = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in brute(rows).items()}
    got = D.dedup_decisions(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["keep_id"], r["group_size"]) == want[bytes(r["digest"]).hex()]
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(want)
    assert all(r["id"] == r["keep_id"] for r in kept)


def test_rows_keep_their_columns_and_one_stays_per_text(spark):
    docs = awkward(spark)
    out = D.exact_dedup(docs)
    assert out.schema == docs.schema
    rows = out.collect()
    want = brute(docs.collect())
    assert len(rows) == len(want)
    assert all(r["doc_id"] == want[(r["text"] or "").translate(LOWER)][0] for r in rows)


def test_empty_table(spark):
    assert D.exact_dedup(empty(spark)).count() == 0
    assert D.dedup_decisions(empty(spark)).count() == 0


def test_saturated_filter_stays_exact(spark):
    docs = documents(spark, [(i, f"text {i % 700}", "en", "a") for i in range(1000)])
    got = D.dedup_decisions(docs, max_bits=D.BITMAP_BITS).collect()
    assert sum(r["kept"] for r in got) == 700
    assert all(r["keep_id"] == max(r["id"] % 700, r["id"] % 700 + 700 if r["id"] % 700 < 300 else 0) for r in got)


def test_only_possible_repeats_are_shuffled(spark):
    docs = documents(spark, [(i, f"text {i}", "en", "a") for i in range(2000)] + [(5000, "text 3", "en", "a")])
    narrow = docs.select("doc_id", D.text_digest(docs["text"]).alias("digest"))
    maybe = D.probe(narrow, *D.repeat_filter(narrow)).filter("maybe").count()
    assert 2 <= maybe < 60


@pytest.mark.parametrize("text", ["ÀÉA", "Zz", "İI", ""])
def test_lower_is_ascii_only(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(D.ascii_lower(df["t"])).first()[0] == text.translate(LOWER)
