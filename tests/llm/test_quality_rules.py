import random

from helpers import awkward, documents, empty, prose
from pyspark.sql import functions as F

from cardmarts.llm import quality_rules as Q
from cardmarts.llm.language_id import held_out


def corpus(spark, n=400):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(rng, rng.randint(20, 60)).capitalize() + "."
        if bad:
            text = " ".join(w + "%%%" for w in text.split()) if i % 8 else text.upper().replace(" ", "!! ")
        docs.append((i, text, "en", "s"))
        labels.append((i, int(not bad), "clash"))
    labels += [(0, None, ""), (99999, 1, "")]
    return documents(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, text string")


def test_held_out_accuracy_and_columns_only(spark):
    docs, labels = corpus(spark)
    out = Q.score_quality(docs, labels, ~held_out("id", 5, 0))
    got = {r["id"]: r for r in out.collect()}
    truth = {i: int(i % 4 != 0) for i in range(400)}
    test = [i for i in truth if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["predicted"] == truth[i] for i in test) / len(test) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    assert "Python" not in out._jdf.queryExecution().toString()


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = corpus(spark)
    flipped = labels.withColumn("quality", F.when(held_out("doc_id", 5, 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = Q.score_quality(docs, labels, ~held_out("id", 5, 0)).orderBy("id").collect()
    b = Q.score_quality(docs, flipped, ~held_out("id", 5, 0)).orderBy("id").collect()
    assert a == b


def test_tree_rules_are_paths():
    text = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5
  If (feature 1 <= 0.5)
   If (feature 0 <= 2.0)
    Predict: 0.0
   Else (feature 0 > 2.0)
    Predict: 1.0
  Else (feature 1 > 0.5)
   Predict: 1.0"""
    a, b = ("b", "<=", 0.5), ("b", ">", 0.5)
    assert Q.tree_rules(text, ["a", "b"]) == {(a,), (a, ("a", "<=", 2.0)), (a, ("a", ">", 2.0)), (b,)}


def test_awkward_and_degenerate(spark):
    docs = awkward(spark)
    one_class = spark.createDataFrame([(4, 1), (5, 1)], "doc_id long, quality int")
    got = Q.score_quality(docs, one_class, F.lit(True)).collect()
    assert len(got) == docs.count()
    assert len({round(r["score"], 9) for r in got}) == 1 and 0 < got[0]["score"] < 1
    none = one_class.limit(0)
    assert Q.score_quality(docs, none, F.lit(True)).count() == docs.count()
    assert Q.score_quality(empty(spark), none, F.lit(True)).count() == 0


def test_statistics_of_odd_texts(spark):
    rows, names = Q.with_statistics(awkward(spark), "doc_id", "text")
    for r in rows.collect():
        assert all(r[n] is not None and r[n] == r[n] for n in names)
