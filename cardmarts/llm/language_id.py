"""Language identification by words first, with backoff to character n-grams.

Training counts words per language on a bounded, hash-chosen sample of the
labelled documents (``max_docs``, whole texts, shared evenly among the
languages, so that a rare one is learned whole) and keeps the ``max_words`` most
frequent words of each language; n-grams of those documents' words, with word
borders, are counted for lengths ``max_n`` down to 1 and the ``max_grams`` most
frequent per language and length are kept. The model is therefore bounded by
its parameters, not by the corpus, and can be sent to every task.

Prediction reads whole texts. A known word (known in any language) adds its
smoothed log frequency per language. An unseen word is scored by its longest
known n-grams: at each position the longest known n-gram is used, with a
fixed penalty per character given up; a character never seen adds nothing.
The language with the largest sum wins (ties to the smaller name); the score
is its posterior under equal priors, from the mean per word times the square
root of the number of words, so that long texts do not saturate at once.

Defined results: null or letterless text gives ``und`` with score 0.
With nothing to learn from, every text is ``und``. Rows without a language
are not learned from. Repeated rows count each time in training (in a sample
they share the weight of their language's rate) and are each predicted; other columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cardmarts.llm.common import col, fresh, materialize, releasing, table

WORD = r"\p{L}[\p{L}\p{M}]*"
UNKNOWN = "und"
MEMO_WORDS = 60_000  # scores kept per task before the memo is emptied
_BLOCK = 4_096  # words summed at a time


@dataclass
class LanguageModel:
    langs: list[str]
    words: dict[str, np.ndarray]
    grams: list[dict[str, np.ndarray]]  # by length, 1 first
    backoff: float = 0.4
    _memo: dict[str, int] = field(default_factory=dict)  # rows of _scores
    _scores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def word_score(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        return known if known is not None else self.unseen_score(word)

    def unseen_score(self, word: str) -> np.ndarray:
        """Log likelihood by the longest known n-gram at each position."""
        total, text, i = np.zeros(len(self.langs)), f" {word} ", 0
        while i < len(text):
            for n in range(min(len(self.grams), len(text) - i), 0, -1):
                hit = self.grams[n - 1].get(text[i:i + n])
                if hit is not None:
                    total = total + hit * self.backoff ** (len(self.grams) - n)
                    i += n
                    break
            else:
                i += 1
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _WORDS.findall(text.lower()) if text else []
        if not words or not self.langs:
            return UNKNOWN, 0.0
        memo, total = self._memo, np.zeros(len(self.langs))
        for a in range(0, len(words), _BLOCK):
            block = words[a:a + _BLOCK]
            if len(memo) > MEMO_WORDS:
                memo.clear()
            for w in block:
                if w not in memo:
                    if len(memo) >= len(self._scores):
                        grown = np.zeros((max(1024, 2 * len(memo)), len(self.langs)))
                        if memo:
                            grown[: len(memo)] = self._scores[: len(memo)]
                        self._scores = grown
                    self._scores[len(memo)] = self.word_score(w)
                    memo[w] = len(memo)
            total += self._scores[[memo[w] for w in block]].sum(axis=0)
        z = total / np.sqrt(len(words))
        best = int(np.argmax(total))
        return self.langs[best], float(1 / np.exp(z - z[best]).sum())


_WORDS = regex.compile(WORD)


def sample_rows(rows: DataFrame, key: str, at_most: int) -> DataFrame:
    """A hash-chosen part of ``rows``, about ``at_most`` of them, or all; no sort, no collect."""
    n = rows.count()
    if n <= at_most:
        return rows
    return rows.filter(F.xxhash64(col(key), F.lit("sample")) < F.lit(int(-(1 << 63) + (1 << 64) * (at_most / n))))


def language_quotas(rows: dict[str, int], at_most: int) -> dict[str, float]:
    """Rows to learn from per language: an even share of ``at_most``; what a rare language leaves goes to the others."""
    quota: dict[str, float] = {}
    for k, lang in enumerate(sorted(rows, key=lambda x: (rows[x], x))):
        quota[lang] = min(float(rows[lang]), (at_most - sum(quota.values())) / (len(rows) - k))
    return quota


def sample_by_language(labelled: DataFrame, at_most: int) -> DataFrame:
    """(lang, text, times) of (id, text, lang): about ``at_most`` rows in all, chosen per language by a hash of id and text.

    Rows that agree in id and text are counted and come once, with their share as ``times``.
    """
    per_lang = {r["lang"]: int(r["n"]) for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if sum(per_lang.values()) <= at_most:
        return labelled.select("lang", "text", F.lit(1).cast("long").alias("times"))
    quota = language_quotas(per_lang, at_most)
    # one row per language; as an Arrow table it needs no Python workers
    rates = F.broadcast(labelled.sparkSession.createDataFrame(pa.table({
        "lang": pa.array(per_lang, pa.string()), "rate": pa.array([quota[x] / n for x, n in per_lang.items()], pa.float64())})))
    keyed = labelled.select("lang", "text", F.xxhash64("id", "text").alias("key"))
    share = F.col("n") * F.col("rate")
    draw = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    counted = keyed.groupBy("lang", "key").agg(F.count("*").alias("n")).join(rates, "lang")
    chosen = counted.withColumn("times", F.floor(share + 1e-9) + (draw < share - F.floor(share + 1e-9)).cast("long"))
    chosen = materialize(chosen.filter("times > 0").select("lang", "key", "times"), "lang-sample")
    # at most about ``at_most`` rows
    return keyed.join(F.broadcast(chosen), ["lang", "key"]).groupBy("lang", "key").agg(
        F.first("text").alias("text"), F.first("times").alias("times")).select("lang", "text", "times")


def _top(counts: DataFrame, group: list[str], item: str, most: int) -> list:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("n"), F.col(item)))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= most).drop("rank").collect()


def _log_rates(rows: list, langs: list[str], item: str, smooth: float) -> dict[str, np.ndarray]:
    at = {x: i for i, x in enumerate(langs)}
    counts: dict[str, np.ndarray] = {}
    for r in rows:
        counts.setdefault(r[item], np.zeros(len(langs)))[at[r["lang"]]] += r["n"]
    total = np.sum(list(counts.values()), axis=0) if counts else np.ones(len(langs))
    low = smooth * (len(counts) + 1)
    out = {k: np.log((v + smooth) / (total + low)) for k, v in counts.items()}
    # only differences between languages matter: centre, so that unknown parts weigh nothing
    return {k: v - v.mean() for k, v in out.items()}


def fit_language_model(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       max_docs: int = 20_000, max_words: int = 20_000, max_grams: int = 5_000, max_n: int = 4,
                       smooth: float = 0.5) -> LanguageModel:
    """The model of the labelled rows. The model's size is bounded by ``max_words``, ``max_grams`` and ``max_n``."""
    labelled = train.filter(col(lang_col).isNotNull() & col(text_col).isNotNull()).select(
        col(id_col).alias("id"), col(text_col).alias("text"), col(lang_col).alias("lang"))
    sample = sample_by_language(labelled, max_docs)
    words = materialize(
        sample.select("lang", "times", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))).alias("word"))
        .groupBy("lang", "word").agg(F.sum("times").alias("n")), "lang-words")
    marked = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    grams = words.select("lang", "n", F.length(marked).alias("len"), marked.alias("marked")).select(
        "lang", "n", "len", "marked", F.explode(F.sequence(F.lit(1), F.lit(max_n))).alias("k")).filter("len >= k").select(
        "lang", "n", "marked", "k", F.explode(F.sequence(F.lit(1), F.col("len") - F.col("k") + 1)).alias("at")).select(
        "lang", "k", F.substring(F.col("marked"), F.col("at"), F.col("k")).alias("gram"), "n"
    ).groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))
    top_words = _top(words, ["lang"], "word", max_words)
    top_grams = _top(grams, ["lang", "k"], "gram", max_grams)
    langs = sorted({r["lang"] for r in top_words})
    by_n = [[r for r in top_grams if r["k"] == n] for n in range(1, max_n + 1)]
    return LanguageModel(langs, _log_rates(top_words, langs, "word", smooth),
                         [_log_rates(rows, langs, "gram", smooth) for rows in by_n])


def predict_language(docs: DataFrame, model: LanguageModel, text_col: str, lang_out: str, score_out: str) -> DataFrame:
    """``docs`` plus the predicted language and its score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.arrow_udf(kind)
    @releasing
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in batches:
            got = [m.predict(x.as_py()) for x in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=["lang", "score"])

    got = fresh(docs, "lang_id")
    return docs.withColumn(got, predict(col(text_col))).select(
        *[col(c) for c in docs.columns], col(got)["lang"].alias(lang_out), col(got)["score"].alias(score_out))


def held_out(id_col: str, mod: int, remainder: int):
    """Is crc32 of the id's text this remainder? A null id counts as the empty text."""
    return F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")) % mod == remainder


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_language_model(docs.filter(~held_out("doc_id", 3, 1)))
    rows = docs.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "text")
    return predict_language(rows, model, "text", "lang_pred", "score").drop("text")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Documents whose language is identified: all but ``und``, whatever the score (a short text's is low)."""
    model = fit_language_model(docs.filter(~held_out(id_col, 3, 1)), id_col, text_col, lang_col)
    lang, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    scored = predict_language(docs, model, text_col, lang, score)
    return scored.filter(col(lang) != UNKNOWN).select(*[col(c) for c in docs.columns])
