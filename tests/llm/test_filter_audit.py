import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from helpers import awkward, documents, empty, prose

from cardmarts.llm import filter_audit as X

WORD = re.compile("[^\x20\x09-\x0d]+")


def measures(text):
    words = WORD.findall(text)
    return len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall("[#$%&*|]", text))


def brute(rows, labels):
    first = {}
    for r in rows:
        if r["doc_id"] is not None:
            t = r["text"] or ""
            first[t] = min(first.get(t, r["doc_id"]), r["doc_id"])
    marks = {}
    for i, q, t in labels:
        if i is not None:
            good, toxic = marks.get(i, (False, False))
            marks[i] = (good or q == 1, toxic or t == 1)
    docs = []
    for r in rows:
        n, d, c, p, s = measures(r["text"] or "")
        e = r["doc_id"] is not None and r["doc_id"] > first[r["text"] or ""]
        fails = dict(zip("ABCDE", (n < 100, 100 * d < 80 * n, 100 * c > 10 * p, s > 0, e), strict=True))
        docs.append((r["lang"] or "", fails, *marks.get(r["doc_id"], (False, False))))
    out = {}
    for part in {d[0] for d in docs}:
        own, shapley = [d for d in docs if d[0] == part], Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order):
                gone = [d for d in left if d[1][f]]
                shapley[f] += len(gone)
                left = [d for d in left if not d[1][f]]
                all_fail = [d for d in own if d[1][f]]
                out[part, "".join(order), step + 1] = [
                    len(left), len(gone), len(all_fail) - len(gone), sum(sum(d[1].values()) == 1 for d in all_fail),
                    sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


def label_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, lang string".replace(", text string, lang string", ""))


def corpus(spark):
    rng = random.Random(8)
    texts = [prose(rng, rng.choice([3, 99, 100, 120])) for _ in range(60)]
    texts += [" ".join(f"word{rng.randint(0, 400)}" for _ in range(150)) for _ in range(60)]
    texts += [t.upper() for t in texts[:20]] + [t + " $" for t in texts[60:80]] + [None, "", "  "]
    rows = [(i, rng.choice(texts), rng.choice(["en", "en", "de", None]), "s") for i in range(400)]
    rows += [(None, texts[60], "en", "s")] * 3 + [(7, texts[61], "fr", "s"), (7, texts[62], "fr", "s"), rows[5], rows[5]]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 0, 1, None])) for i in range(0, 400, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1), (99_999, 1, 1)]
    return documents(spark, rows, 4), labels


def test_matches_brute_force(spark):
    docs, labels = corpus(spark)
    got = found(X.audit(docs, label_rows(spark, labels)))
    assert got == brute(docs.collect(), labels)
    assert len(got) == 600 * 4


def test_awkward_and_empty(spark):
    docs, none = awkward(spark), label_rows(spark, [])
    assert found(X.audit(docs, none)) == brute(docs.collect(), [])
    assert X.audit(empty(spark), none).count() == 0


def test_a_text_that_most_rows_hold_meets_as_one_row(spark):
    rows = [(i, "same text", "en", "s") for i in range(3_000)] + [(5_000 + i, prose(random.Random(i), 9), "en", "s") for i in range(50)]
    docs = documents(spark, rows, 6)
    got = found(X.audit(docs, label_rows(spark, [(0, 1, 1), (1, 1, 1)])))
    assert got["en", "EABCD", 1][:3] == (51, 2_999, 0) and got["en", "EABCD", 1][4:6] == (1, 1)


@pytest.mark.parametrize("piece", [1, 50, 1 << 21])
def test_transducer_counts(monkeypatch, piece):
    monkeypatch.setattr(X, "PIECE", piece)
    rng = random.Random(2)
    texts = ["".join(rng.choice("aAbZ é漢\U0001f600\t\x0b\x0c\r\n\x1c\x85\xa0#$|%") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts += ["", " ", "x" * 500 + " " + "x" * 500 + " " + "x" * 499 + "y", "w " * 300]
    got = X.Transducer().count([t.encode() for t in texts])
    for k, t in enumerate(texts):
        assert (got.words[k], got.distinct[k], got.capitals[k], got.points[k], got.symbols[k]) == measures(t), t
    assert len(X.Transducer().count([]).words) == 0


def test_hash_collisions_hide_no_word():
    words = [f"w{k}" for k in range(50)] * 2
    joined = (" ".join(words) + " ").encode()
    data = np.frombuffer(joined + bytes(8), np.uint8)
    start = np.array([m.start() for m in re.finditer(rb"\S+", joined)])
    length = np.array([len(w) for w in words])
    first = X.first_spans(data, np.zeros(100, np.int64), start, length, np.zeros(100, np.uint64))  # all hash alike
    assert first.tolist() == [True] * 50 + [False] * 50


def test_tables_tell_every_byte():
    kinds = X.class_table("#$%&*|")
    for b in range(128):
        c = chr(b)
        want = X.BLANK if c in " \t\n\x0b\x0c\r" else X.CAPITAL if "A" <= c <= "Z" else X.SYMBOL if c in "#$%&*|" else X.PLAIN
        assert kinds[b] == want
    assert X.ACTIONS[0, X.BLANK] == X.POINT and X.ACTIONS[1, X.REST] == 0 and X.ACTIONS[0, X.LEAD] == X.POINT | X.START
