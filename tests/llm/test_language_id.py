import random

from helpers import awkward, documents, empty

from cardmarts.llm import language_id as L

VOCAB = {"en": "the of and to that with ing tion ness", "fr": "le la les des que eau oux ment tre", "de": "der die das und ung heit keit sch ein"}


def corpus(n=120):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(list(VOCAB))
        parts = VOCAB[lang].split()
        rows.append((i, " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(30)), lang, "s"))
    return rows


def test_held_out_accuracy_on_unseen_words(spark):
    rows = corpus()
    docs = documents(spark, rows)
    model = L.fit_language_model(docs.filter(~L.held_out("doc_id", 3, 1)))
    got = L.predict_language(docs.filter(L.held_out("doc_id", 3, 1)), model, "text", "p", "s").collect()
    assert len(got) > 20
    assert sum(r["p"] == r["lang"] for r in got) / len(got) > 0.95
    assert all(0 <= r["s"] <= 1 for r in got)
    assert model.predict("ungheitschung")[0] == "de"  # no word of the vocabulary: by its n-grams
    assert "ungheitschung" not in model.words


def test_backoff_takes_longer_grams_first():
    import numpy as np
    m = L.LanguageModel(["a", "b"], {}, [{"x": np.array([1.0, -1.0])}, {"xy": np.array([-2.0, 2.0])}], backoff=0.5)
    assert m.unseen_score("xy").tolist() == [-2.0, 2.0]
    assert m.unseen_score("x").tolist() == [0.5, -0.5]
    assert m.unseen_score("qq").tolist() == [0.0, 0.0]


def test_awkward_rows(spark):
    docs = awkward(spark)
    model = L.fit_language_model(documents(spark, corpus(40)))
    got = L.predict_language(docs, model, "text", "p", "s")
    assert got.count() == docs.count()
    for r in got.collect():
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert (r["p"], r["s"]) == ("und", 0.0)
        else:
            assert r["p"] in VOCAB


def test_nothing_to_learn_from(spark):
    model = L.fit_language_model(empty(spark))
    assert L.predict_language(awkward(spark), model, "text", "p", "s").filter("p <> 'und'").count() == 0
    assert L.keep_identified(empty(spark)).count() == 0


def test_stage_keeps_columns_and_rejects_letterless(spark):
    docs = documents(spark, [*corpus(60), (900, "123 !!", "en", "s"), (901, None, "en", "s")])
    out = L.keep_identified(docs)
    assert out.schema == docs.schema
    ids = {r["doc_id"] for r in out.collect()}
    assert ids == set(range(60))


def test_sample_is_bounded(spark):
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    n = L.sample_rows(docs, "doc_id", 5_000).count()
    assert 4_600 < n < 5_400
    assert L.sample_rows(docs, "doc_id", 50_000).count() == 20_000


def test_a_rare_language_and_repeated_rows_are_sampled(spark):
    rows = [(i, f"the of and {i % 50}", "en", "s") for i in range(3_000)] + [(None, "and to that", "en", "s")] * 1_500
    rows += [(10_000 + i, "ungheit keitsch", "de", "s") for i in range(5)]
    docs = documents(spark, rows)
    labelled = docs.selectExpr("doc_id AS id", "text", "lang")
    got = L.sample_by_language(labelled, 300).collect()
    assert sum(r["lang"] == "de" for r in got) == 5  # whole
    assert 220 < sum(r["times"] for r in got) < 380 and len(got) < 300
    hot = [r["times"] for r in got if r["text"] == "and to that"]
    assert len(hot) == 1 and 97 <= hot[0] <= 100  # its third of the language's 295
    model = L.fit_language_model(docs, max_docs=300)
    assert model.langs == ["de", "en"] and model.predict("ungheit")[0] == "de"
    assert L.language_quotas({"a": 5, "b": 1_000, "c": 1_000}, 105) == {"a": 5.0, "b": 50.0, "c": 50.0}


def test_stage_keeps_texts_of_low_score(spark):
    docs = documents(spark, [*corpus(60), (900, "\u4f60\u597d", "zh", "s"), (901, "q", None, "s"), (902, "12", "en", "s")])
    model = L.fit_language_model(docs.filter(~L.held_out("doc_id", 3, 1)))
    assert model.predict("\u03b1\u03b2")[1] < 0.5  # a script never learned
    more = docs.unionByName(documents(spark, [(903, "\u03b1\u03b2", None, "s")]))
    ids = {r["doc_id"] for r in L.keep_identified(more).collect()}
    assert ids == {*range(60), 900, 901, 903}
