"""Quality classifier: a sparse ensemble of rules, compiled into column expressions.

Text statistics are DataFrame functions over the whole text. A random forest of
shallow trees is fitted on a bounded, hash-chosen sample of labelled rows
(``max_rows``); every path from a root to a node becomes a conjunctive rule
over the statistics, and a lasso logistic regression over the rules keeps the
few that carry weight. The result is a list of (rule, weight) that compiles
into one Spark column, so scoring is a projection of the statistics: no join,
no shuffle and no Python.

Defined results: a null text counts as empty and gets a score like any other.
Rows with a null label, and labels without a document, are not learned from.
A document with several labels is learned from once for each. If the labels
are all alike (or there are none) the score is their smoothed mean. Repeated
rows are each scored; an empty table gives an empty result. Ties among rules of
equal worth are settled by their text; other columns are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.llm.common import col, materialize, table
from cardmarts.llm.language_id import held_out, sample_rows

SYMBOL = r"[^\p{L}\p{M}\p{N}\s.,;:'!?|\"-]"
COUNTED = {"bar": "|", "shout": "!", "stop": ".", "line": "\n"}
Condition = tuple[str, str, float]  # statistic, "<=" or ">", threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    weight: float = 0.0

    def column(self) -> Column:
        tests = [(F.col(f) <= t) if op == "<=" else (F.col(f) > t) for f, op, t in self.conditions]
        return reduce(lambda a, b: a & b, tests)

    def __str__(self) -> str:
        return f"{self.weight:+.3f} if " + " and ".join(f"{f} {op} {t:.4g}" for f, op, t in self.conditions)


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[str]]:
    """id and statistics of each whole text (ratios of an empty text are 0), and their names."""
    t, words = F.col("t"), F.col("words")
    text = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("t"))
    cut = text.select(
        "id", F.char_length(t).alias("chars"), F.array_remove(F.split(t, r"\s+"), "").alias("words"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).alias("upper"), F.regexp_count(t, F.lit(SYMBOL)).alias("symbol"),
        F.regexp_count(t, F.lit("[0-9]")).alias("digit"),
        *[(F.char_length(t) - F.char_length(F.replace(t, F.lit(c)))).alias(k) for k, c in COUNTED.items()])
    seen = cut.select("*", F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("distinct"),
                      F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))).alias("repeats")).drop("words")
    per_word = lambda c: F.col(c) / F.greatest(F.col("n"), F.lit(1))
    per_char = lambda c: F.col(c) / F.greatest(F.col("chars"), F.lit(1))
    stats = {
        "log_words": F.log1p("n"), "word_length": per_word("chars"), "distinct_words": per_word("distinct"),
        "repeated_words": per_word("repeats"), "log_distinct": F.log1p("distinct"), "capitals": per_char("upper"),
        "symbols": per_char("symbol"), "digits": per_char("digit"), **{f"{k}s": per_word(k) for k in COUNTED},
    }
    return seen.select("id", *[c.cast("double").alias(k) for k, c in stats.items()]), list(stats)


def tree_rules(debug: str, names: list[str]) -> set[tuple[Condition, ...]]:
    """Every path of a tree (as Spark prints it), from the root to each inner node and leaf."""
    found, path = set(), []
    for line in debug.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth = len(m[1])
            path = [p for p in path if p[0] < depth]
            path.append((depth, (names[int(m[2])], m[3], float(m[4]))))
            found.add(tuple(c for _, c in path))
    return found


@dataclass
class RuleEnsemble:
    rules: list[Rule]
    intercept: float

    def score(self) -> Column:
        """Probability of label 1, over a row that has the statistics."""
        total = F.lit(float(self.intercept))
        for r in self.rules:
            total = total + F.when(r.column(), F.lit(float(r.weight))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def fit_rules(rows: DataFrame, names: list[str], label: str = "label", trees: int = 12, depth: int = 3,
              lasso: float = 0.002, max_rows: int = 20_000, seed: int = 7) -> RuleEnsemble:
    """Fit on at most about ``max_rows`` hash-chosen rows with columns ``id``, ``names`` and a 0/1 ``label``."""
    sample = materialize(sample_rows(rows, "id", max_rows).select(*names, F.col(label).cast("double").alias("label")), "labelled")
    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if ones in (0, n):
        return RuleEnsemble([], _logit((ones + 0.5) / (n + 1)))
    packed = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="skip").transform(sample)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=5,
                                    subsamplingRate=0.7, maxBins=64).fit(packed.select("features", "label"))
    paths = sorted(set().union(*[tree_rules(t.toDebugString, names) for t in forest.trees]))
    if not paths:
        return RuleEnsemble([], _logit((ones + 0.5) / (n + 1)))
    rules = [Rule(p) for p in paths]
    hits = materialize(sample.select("label", F.array(*[r.column().cast("double") for r in rules]).alias("hits")), "rule-hits")
    lr = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60).fit(
        hits.select(array_to_vector("hits").alias("features"), "label"))
    kept = [Rule(r.conditions, float(w)) for r, w in zip(rules, lr.coefficients.toArray(), strict=True) if abs(w) > 1e-9]
    return RuleEnsemble(kept, float(lr.intercept))


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """id, score and predicted for every document; ``learn`` (over ``id``) names the rows whose labels may be used."""
    rows, names = with_statistics(docs, id_col, text_col)
    stats = materialize(rows, "statistics")
    known = labels.filter(col(label_col).isNotNull()).select(col(id_col).alias("id"), col(label_col).alias("label"))
    ensemble = fit_rules(stats.filter(learn).join(known.filter(learn), "id"), names)
    scored = stats.select("id", ensemble.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out("id", 5, 0))
    return scored.select(F.col("id").alias("doc_id"), held_out("id", 5, 0).alias("held_out"), "score", "predicted")
