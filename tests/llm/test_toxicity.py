import random

import pytest
from helpers import awkward, documents, empty, prose
from pyspark.sql import functions as F

from cardmarts.llm import toxicity as X
from cardmarts.llm.language_id import held_out

INSULTS = ["moron", "clown", "stinker", "réeux"]


def corpus(spark, n=1_200):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(20, 300)).split()
        toxic = i % 6 == 0
        for _ in range(rng.randint(2, 4) if toxic else 0):
            w = rng.choice(INSULTS)
            words[rng.randrange(len(words))] = w if w != "stinker" else "stink" + rng.choice(["er", "ish", "olo", "aux"])
        if i % 5 == 1:
            words[3:3] = rng.choice(["circus clown", "reeux"]).split()
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(toxic)))
    return documents(spark, rows, 5), spark.createDataFrame([*labels, (None, 1), (3, None), (99_999, 1)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = corpus(spark)
    sample = X.labelled_sample(docs, labels, ~held_out("id", 4, 2), "doc_id", "text", "toxic", 20_000)
    return docs, labels, X.learn_lexicon(sample)


def test_held_out_accuracy(spark, learned):
    docs, labels, _ = learned
    got = {r["id"]: r for r in X.score_toxicity(docs, labels, ~held_out("id", 4, 2)).withColumn("held", held_out("id", 4, 2)).collect()}
    test = [r for r in got.values() if r["held"]]
    assert len(test) > 200 and len(got) == 1_200
    assert sum(r["predicted"] == int(r["id"] % 6 == 0) for r in test) / len(test) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())


def test_lexicon_has_the_words_and_the_exception(learned):
    lexicon = learned[2]
    entries = set(lexicon.entries)
    assert {X.fold("moron")[0], X.fold("réeux")[0]} <= entries
    assert any(x.startswith(" stin") for x in entries) and " reeux " not in entries
    assert X.fold("circus clown")[0] in lexicon.exceptions
    calm, rude = "a day at the zoo with a circus clown ", "a day at the zoo with a clown "
    assert lexicon.score(calm) == lexicon.score("a day at the zoo with a circus ring ") < lexicon.score(rude)


@pytest.mark.parametrize("text", ["M0R0N", "m​oron", "ｍｏｒｏｎ", "mоrоn", "m0ron!", "mo̵ron"])
def test_hidden_spellings_fold(text):
    assert X.fold(text)[0] == X.fold("moron")[0]


def test_folding_leaves_other_text_alone():
    assert X.fold("call 555-0199 at 10:30, costs $5")[0] == " caii at costs "
    assert X.fold("réeux reeux")[0] == " réeux reeux "
    assert X.fold(None) == X.fold("") == X.fold(" 12 !?") == (" ", 0)
    assert X.fold("1diot $tupid l0ser")[0] == X.fold("idiot stupid loser")[0]


def test_folding_in_pieces(monkeypatch):
    rng = random.Random(1)
    text = " ".join(rng.choice(["idi0t", "a", "ÉÀ", "x1", "!", "clown\n"]) for _ in range(2_000))
    whole = X.fold(text)
    monkeypatch.setattr(X, "PIECE", 13)
    assert X.fold(text) == whole


def test_matches_equal_a_plain_search():
    rng = random.Random(5)
    entries = [" moron ", " mor", " idi", " idiot ", " a "]
    exceptions = [" so moron ", " idiot proof ", " a a "]
    lexicon = X.Lexicon(dict.fromkeys(entries, 1.0), exceptions)
    for _ in range(500):
        text = " " + " ".join(rng.choice(["moron", "mora", "idiot", "idiom", "so", "proof", "a", "b"]) for _ in range(rng.randint(1, 12))) + " "
        safe = [(s, s + len(e)) for e in exceptions for s in range(len(text)) if text.startswith(e, s)]
        want = [(s, e) for e in entries for s in range(len(text)) if text.startswith(e, s)
                and not any(a <= s and s + len(e) <= b for a, b in safe)]
        assert sorted(lexicon.matches(text)) == sorted(want)


def test_longer_texts_need_more(learned):
    lexicon = learned[2]
    short, long = "you moron of the day", "you moron of the day " + "calm words here " * 4_000
    assert lexicon.score(long) < 0.3 < lexicon.score(short)


def test_held_out_labels_are_not_used(spark, learned):
    docs, labels, _ = learned
    flipped = labels.withColumn("toxic", F.when(held_out("doc_id", 4, 2), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(X.score_toxicity(docs, x, ~held_out("id", 4, 2)).collect()) for x in (labels, flipped))
    assert a == b


def test_sample_is_bounded_and_copies_stand_as_one(spark):
    rows = [(i, "you moron " + prose(random.Random(i % 40), 30), "en", "s") for i in range(2_000)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 40 < 4)) for i in range(2_000)], "doc_id long, toxic int")
    sample = X.labelled_sample(docs, labels, F.lit(True), "doc_id", "text", "toxic", 10_000).collect()
    assert len(sample) == 40 and sum(r["weight"] for r in sample) == 2_000
    small = X.labelled_sample(docs, labels, F.lit(True), "doc_id", "text", "toxic", 400).collect()
    assert abs(sum(r["weight"] for r in small if r["label"] == 1) - 200) < 60


def test_awkward_degenerate_and_empty(spark):
    docs = awkward(spark)
    for rows in ([], [(4, 1)], [(4, 0), (5, 0)], [(4, 1), (7, 0), (10, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        got = X.score_toxicity(docs, labels, F.lit(True)).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got if r["id"] in (1, 2, 3)}) == 1
    assert X.score_toxicity(empty(spark), labels, F.lit(True)).count() == 0
