"""Small documents tables with the awkward cases that every operator must take."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, digest string, row string, size string, copies int, maybe boolean"


def prose(rng: random.Random, n: int, words: str = "the of and to in that is was for with as on be at by") -> str:
    vocab = words.split()
    return " ".join(rng.choice(vocab) + rng.choice(["", "a", "er", "ing", "ly"]) for _ in range(n))


def documents(spark, rows: list[tuple], partitions: int = 3):
    """rows: (doc_id, text, lang, source); the other columns clash with the operators' own names."""
    full = [(i, t, lang, s, len(t or ""), "x", "y", "z", "w", 7, True) for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOC_SCHEMA).repartition(partitions)


def awkward(spark):
    rng = random.Random(5)
    rows = [
        (1, None, "en", "a"), (2, "", None, "a"), (3, "   \n\t", "en", None), (4, "Hello World", "en", "a"),
        (5, "hello world", "en", "b"), (5, "hello world", "en", "b"), (None, "hello world", None, None),
        (6, "x" * 50_000, "en", "a"), (7, prose(rng, 30_000), "en", "b"), (8, "ÉÀ É", "fr", "c"), (9, "éÀ É", "fr", "c"),
        (10, "12 34 !! ## 5", "en", "a"), (None, None, None, None), (None, None, None, None),
    ]
    return documents(spark, rows)


def empty(spark):
    return documents(spark, [])
