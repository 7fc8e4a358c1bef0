import random
import re
from collections import Counter, defaultdict

import numpy as np
from helpers import awkward, documents, empty, prose

from cardmarts.llm import divergence as D

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, least=3, top=200):
    docs = [((r["lang"] or ""), (r["source"] or ""), Counter(TERM.findall((r["text"] or "").translate(LOWER)))) for r in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in d[2])
        kept = sorted(t for t, n in seen.items() if n >= least)
        groups = defaultdict(Counter)
        for _, source, c in own:
            groups[source].update({t: c[t] for t in kept if c[t]})
            groups[source] += Counter()
        v, whole = len(kept), Counter()
        for c in groups.values():
            whole.update(c)
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + v)
        for s in groups:
            pairs = [(sum((share(groups[s], t) - share(groups[o], t)) ** 2 // share(groups[o], t) for t in kept), o) for o in groups if o != s]
            words = []
            for t in kept:
                p, q = share(groups[s], t), share(whole, t)
                if groups[s][t] and p > q:
                    words.append(((p - q) ** 2 // q, t))
            for part, found in (("pair", pairs), ("term", words)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found) if part == "pair" or k < top}
    return out


def found(df):
    rows = [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(spark, n=300, partitions=5):
    rng = random.Random(3)
    vocab = "the of and to Ärger éclat zebra Quiz naïve x12y it's don't 漢字 a_b UPPER lower".split()
    rows = [(i, prose(rng, rng.randint(0, 30)) + " " + " ".join(rng.choices(vocab, k=rng.randint(0, 9))),
             rng.choice(["en", "en", "fr", None]), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(n)]
    rows += [(n + i, None, "xx", s) for i, s in enumerate("ab")] + [(n + 9, "lonely words here", "yy", "one")]
    return documents(spark, rows, partitions)


def test_matches_brute_force(spark):
    docs = corpus(spark)
    want = brute(docs.collect())
    got = found(D.audit(docs))
    assert got == want and any(x[2] == "pair" and x[0] == "xx" and x[4] == 0 for x in got)
    assert found(D.audit(docs, entries=20)) == want  # handed on after every few terms
    assert found(D.audit(docs.repartition(1))) == want


def test_few_ranks_and_other_bounds(spark):
    docs = corpus(spark, 120)
    assert found(D.audit(docs, least_docs=1, top=4)) == brute(docs.collect(), 1, 4)


def test_ties_go_to_the_smaller_item_in_utf8(spark):
    rows = [(i, "￿ \U00010000 zz aa", "en", "ab"[i % 2]) for i in range(6)] + [(9, "zz ￿ \U00010000 aa", "en", "a")]
    docs = documents(spark, rows)
    assert found(D.audit(docs)) == brute(docs.collect())


def test_blocks_add_up(spark, monkeypatch):
    docs = corpus(spark, 150)
    monkeypatch.setattr(D, "BLOCK", 3)
    assert found(D.audit(docs)) == brute(docs.collect())


def test_shares_are_exact():
    rng = random.Random(1)
    for _ in range(2_000):
        total = rng.randint(1, 8 * 10**17)
        count = rng.randint(0, total - 1)
        assert D.shares(np.array([count]), np.array([total]))[0] == 1 + 10**9 * (count + 1) // total


def test_tokenizer_is_the_pattern_also_in_pieces(monkeypatch):
    rng = random.Random(4)
    for size in (1, 7, 1 << 20):
        monkeypatch.setattr(D, "PIECE", size)
        for _ in range(200):
            text = "".join(rng.choice("aZé漢 \x00\n@[`{~0_\x7f\x80ß") for _ in range(rng.randint(0, 60)))
            got = [t.decode() for piece in D.terms(text.encode()) for t in piece]
            assert got == TERM.findall(text.translate(LOWER))


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    assert found(D.audit(docs)) == brute(docs.collect())
    assert D.audit(empty(spark)).count() == 0
    assert found(D.audit(docs.union(docs))) == brute(docs.union(docs).collect())  # repeated rows
