"""Toxicity by a weighted lexicon, matched by an Aho-Corasick automaton over folded text.

Folding undoes spellings that hide a word: lower case, compatibility forms
(NFKC), marks that no letter takes up, invisible characters, Cyrillic and Greek
letters that look like Latin ones, and digits or signs that stand for letters
beside a letter (``1d1ot``, ``$tupid``). ``l`` and ``i`` fold into one letter, as
1 and | are written for both. Accented letters stay, as accents tell words
apart. What is not a letter separates words. The lexicon, its exceptions and
the texts are all folded by the same function.

An entry is a whole word (`` word ``) or the start of a word (`` wor``), and
one pass of the automaton finds all of them in a text, together with the
exception phrases; entries inside an exception phrase do not count. The score is

    1 / (1 + exp(-(b + sum of weight * occurrences / sqrt(1 + words / 100))))

so that a long text needs more than one slip.

Learning uses a bounded sample of the labelled documents (``max_rows`` ids,
half of them toxic where there are as many, weighted back to their shares;
copies and near copies count once).
Words and word starts that more toxic than other documents hold are the
candidates (``max_terms``); two-word phrases around them that clean documents
hold too, and that toxic ones hold no more often, become exceptions, beside
those given (``exceptions``). A lasso logistic regression over the normalised occurrences
then leaves the few entries that carry weight. The lexicon is bounded by these
parameters and goes to every task.

Defined results: a null text counts as empty; an empty text gets the score of a
text without entries. Null labels and labels without a document are not learned
from; of a document's several labels the largest counts, and of several rows of
one id the smallest text is learned from. With labels all alike, or none, every
score is their smoothed mean. Repeated rows are each scored, an empty table
gives an empty result. Whole texts are read; a very long one is folded in
pieces. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.llm.common import byte_slices, col, materialize, table
from cardmarts.llm.language_id import held_out

PIECE = 1 << 22  # characters of one text that are folded at a time
STARTS = (3, 4, 5, 6, 7, 8)  # lengths of word starts that may become entries
# fixed values: letters that look like a Latin letter, then what stands for it
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y",
    "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i",
}
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}
_INVISIBLE = "­​‌‍⁠﻿"
_FOLD = {ord(c): s for c, s in LOOKALIKES.items()} | dict.fromkeys(map(ord, _INVISIBLE)) | {c: None for c in range(0x300, 0x370)}
_SIGNS = str.maketrans(STANDS_FOR)
_AS_LETTER = re.compile(r"(?<=[a-z])[0134578@$!|]+(?=[a-z])|(?<![a-z0-9@$!|])[0134578@$!|]+(?=[a-z])|(?<=[a-z])[@$]+(?![a-z0-9])")
_LETTERS = "".join(map(chr, range(ord("a"), ord("z") + 1)))
_BLANK = bytes(ord("i") if c == ord("l") else c if chr(c) in _LETTERS else 32 for c in range(128)) + bytes([32] * 128)
_NO_LETTER = re.compile(r"[\W\d_]+")


def _fold_piece(text: str) -> list[str]:
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_FOLD)
    text = _AS_LETTER.sub(lambda m: m[0].translate(_SIGNS), text)
    if text.isascii():
        return text.encode("ascii").translate(_BLANK).decode("ascii").split()
    return _NO_LETTER.sub(" ", text).replace("l", "i").split()


def fold(text: str | None) -> tuple[str, int]:
    """The folded words, a blank around each, and their number."""
    text, pieces, words, at = text or "", [], 0, 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and not text[end].isspace():
            end += 1
        piece = _fold_piece(text[at:end])
        words += len(piece)
        if piece:
            pieces.append(" ".join(piece))
        at = end
    return f" {' '.join(pieces)} " if pieces else " ", words


def norm(words: int) -> float:
    return math.sqrt(1 + words / 100)


@dataclass
class Lexicon:
    """Folded entries (`` word `` or `` wor``) with weights, exception phrases (`` two words ``) and the intercept."""

    entries: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    intercept: float = 0.0
    _automaton: ahocorasick.Automaton | None = None

    def __getstate__(self):
        return {"entries": self.entries, "exceptions": self.exceptions, "intercept": self.intercept, "_automaton": None}

    def matches(self, folded: str) -> list[tuple[int, str]]:
        """(place, entry) of every entry outside exception phrases."""
        if not self.entries:
            return []
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for x in self.entries:
                a.add_word(x, (x, False))
            for x in self.exceptions:
                if x not in self.entries:
                    a.add_word(x, (x, True))
            a.make_automaton()
            self._automaton = a
        found, safe = [], []
        for end, (x, excepted) in self._automaton.iter(folded):
            (safe if excepted else found).append((end - len(x) + 1, x))
        if safe:  # both lists are in order of their ends
            spans = sorted((s, s + len(x)) for s, x in safe)
            reach, k, kept = 0, 0, []
            for s, x in sorted(found):
                while k < len(spans) and spans[k][0] <= s:
                    reach = max(reach, spans[k][1])
                    k += 1
                if s + len(x) > reach:
                    kept.append((s, x))
            found = kept
        return found

    def score(self, text: str | None) -> float:
        folded, words = fold(text)
        z = self.intercept + sum(self.entries[x] for _, x in self.matches(folded)) / norm(words)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def patterns(folded: str) -> set[str]:
    """Whole words and word starts of a folded text."""
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in STARTS if len(w) > k}


def passage_mark(folded: str) -> int:
    """The smallest hash of three words in a row; of the whole text if it has fewer."""
    w = folded.split()
    if len(w) < 3:
        return xxhash.xxh64_intdigest(folded)
    return min(xxhash.xxh64_intdigest(f"{a} {b} {c}") for a, b, c in zip(w, w[1:], w[2:], strict=False))


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str, max_rows: int) -> DataFrame:
    """(label, weight, folded, words) of at most about ``max_rows`` labelled ids.

    Copies and most near copies (texts that agree in ``passage_mark``) are one row with their joint weight, so that
    the other words of one text do not seem toxic because it was copied.
    """
    known = labels.filter(col(label_col).isNotNull() & col(id_col).isNotNull()).select(
        col(id_col).cast("long").alias("id"), (col(label_col) == 1).cast("int").alias("label")).filter(learn)
    known = materialize(known.groupBy("id").agg(F.max("label").alias("label")), "toxic-labels")
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    rate, left = {}, max_rows
    for k, label in enumerate(sorted(n, key=n.get)):
        rate[label] = min(1.0, left / (len(n) - k) / n[label])
        left -= min(n[label], left // (len(n) - k))
    share = F.when(F.col("label") == 1, rate.get(1, 1.0)).otherwise(rate.get(0, 1.0))
    draw = F.pmod(F.xxhash64("id", F.lit("toxic-sample")), F.lit(1 << 40)) / float(1 << 40)
    chosen = known.filter(draw < share).withColumn("weight", 1 / share)
    # at most about max_rows narrow rows, by the filter above
    rows = docs.select(col(id_col).cast("long").alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id", "label", "weight").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text"):
                folded = [fold(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), part.column("weight"), pa.array([f for f, _ in folded], pa.string()), pa.array([n for _, n in folded], pa.int64()),
                     pa.array([passage_mark(f) for f, _ in folded], pa.uint64()).view(pa.int64())], names=["label", "weight", "folded", "words", "mark"])

    texts = rows.mapInArrow(run, "label int, weight double, folded string, words long, mark long")
    once = texts.groupBy("label", "mark").agg(F.sum("weight").alias("weight"), F.min(F.struct("folded", "words")).alias("text"))
    return materialize(once.select("label", "weight", "text.*"), "toxic-sample")


def _by_label(sample: DataFrame, found) -> DataFrame:
    """(item, toxic, clean): documents of the sample that hold an item of ``found(folded)``, added up within tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())

        def drain() -> pa.RecordBatch:
            items = list(held[0] | held[1])
            out = pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array([held[1][x] for x in items], pa.int64()),
                                              pa.array([held[0][x] for x in items], pa.int64())], names=["item", "toxic", "clean"])
            held[0].clear(), held[1].clear()
            return out

        for batch in batches:
            for label, folded in zip(batch.column("label").to_pylist(), batch.column("folded").to_pylist(), strict=True):
                held[label].update(found(folded))
                if len(held[0]) + len(held[1]) > 300_000:
                    yield drain()
        yield drain()

    counted = sample.select("label", "folded").mapInArrow(run, "item string, toxic long, clean long")
    return counted.groupBy("item").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def phrases(folded: str, words: set[str]) -> set[str]:
    """Two-word phrases that hold one of the folded ``words``."""
    found, w = set(), folded.split()
    for k, x in enumerate(w):
        if x in words:
            if k:
                found.add(f" {w[k - 1]} {x} ")
            if k + 1 < len(w):
                found.add(f" {x} {w[k + 1]} ")
    return found


def closed(rows: list) -> list:
    """The rows (item, toxic, clean) without word starts that say no more than a longer item in the same documents."""
    seen = {r["item"]: (r["toxic"], r["clean"]) for r in rows}
    idle = {x[:k] for x, n in seen.items() for k in range(1, len(x)) if seen.get(x[:k]) == n}
    return [r for r in rows if r["item"] not in idle]


def learn_lexicon(sample: DataFrame, exceptions: tuple[str, ...] = (), max_terms: int = 2_000, max_phrases: int = 1_000,
                  least_docs: int = 3, lasso: float = 0.001) -> Lexicon:
    """Entries, exceptions and weights from (label, weight, folded, words)."""
    given = [fold(x)[0] for x in exceptions]
    n = {r["label"]: (r["n"], r["w"]) for r in sample.groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    (clean, clean_w), (toxic, toxic_w) = n.get(0, (0, 0.0)), n.get(1, (0, 0.0))
    flat = Lexicon({}, given, math.log((toxic_w + 0.5) / (clean_w + 0.5)))
    if not clean or not toxic:
        return flat
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    ranked = materialize(_by_label(sample, patterns).filter(F.col("toxic") >= least_docs).withColumn("odds", odds)
                         .filter((F.col("odds") > 1) & (F.col("odds") > 2 * spread)).withColumn("rank", F.col("toxic") * odds / spread), "toxic-patterns")
    top = closed(ranked.orderBy(F.desc("rank"), "item").limit(3 * max_terms).collect())[:max_terms]  # 3 max_terms rows
    if not top:
        return flat
    doubtful = {r["item"].strip() for r in top if r["item"].endswith(" ") and r["clean"] >= least_docs}
    if doubtful:
        safe = _by_label(sample, lambda folded: phrases(folded, doubtful)).withColumn("odds", odds).filter(
            (F.col("clean") >= 3) & (F.col("odds") < 0.5))
        given += [r["item"] for r in safe.orderBy(F.desc("clean"), "item").limit(max_phrases).collect()]  # max_phrases rows
    lexicon = Lexicon({r["item"]: 1.0 for r in top}, sorted(set(given)))
    place = {x: k for k, x in enumerate(lexicon.entries)}

    def features(folded, words):
        hits = Counter(place[x] for _, x in lexicon.matches(folded))
        return Vectors.sparse(len(place), {k: c / norm(words) for k, c in hits.items()})

    vector = F.udf(features, VectorUDT())
    rows = sample.select(vector("folded", "words").alias("features"), F.col("label").cast("double").alias("label"), "weight")
    fit = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=80, weightCol="weight").fit(
        materialize(rows, "toxic-features"))
    weights = fit.coefficients.toArray()  # entries only add
    return Lexicon({x: float(weights[k]) for x, k in place.items() if weights[k] > 1e-6}, lexicon.exceptions, float(fit.intercept))


def score_documents(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text"):
                scores = [lexicon.score(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(scores, pa.float64())], names=["id", "score"])

    rows = docs.select(col(id_col).cast("long").alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "id long, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", threshold: float = 0.3, max_rows: int = 20_000, **how) -> DataFrame:
    """id, score and predicted for every document; ``learn`` (over ``id``) names the ids whose labels may be used.

    ``how``: exceptions, max_terms, max_phrases, least_docs and lasso of ``learn_lexicon``.
    """
    sample = labelled_sample(docs, labels, learn, id_col, text_col, label_col, max_rows)
    scored = score_documents(docs, learn_lexicon(sample, **how), id_col, text_col)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out("id", 4, 2))
    return scored.select(F.col("id").alias("doc_id"), held_out("id", 4, 2).alias("held_out"), "score", "predicted")
