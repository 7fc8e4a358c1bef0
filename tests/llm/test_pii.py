import hashlib
import random
import re

import numpy as np
from helpers import awkward, documents, empty
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cardmarts.llm import pii as P

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = 0
    for k, c in enumerate(reversed(d)):
        c = int(c)
        s += c if k % 2 == 0 else c * 2 - 9 if c > 4 else c * 2
    return s % 10 == 0


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and luhn(d)
    return kind == "email" or 10 <= len(d) <= 15


def brute(text):
    found = [(m.start(), k, m.end()) for k, (name, rx) in enumerate(PLAIN.items())
             for m in re.finditer(rx, text or "") if passes(name, m.group())]
    return sorted(found)


def check(spark, texts):
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = {r["id"]: r for r in P.find_personal_data(docs).collect()}
    for i, t in enumerate(texts):
        base = [(s["start"], s["kind"], s["stop"]) for s in got[i]["base"]]
        assert base == brute(t), t
        every = [(s["start"], s["kind"], s["stop"]) for s in got[i]["spans"]]
        assert every == sorted(every) and set(base) <= set(every)


TEXTS = [
    "mail a.b@c.de, x@y or é𝄞 q@r.st.uv. a@b.c%x@d.ef a@b@c.d", "1.2.3.4 256.1.1.1 01.002.3.4 1.2.3.4.5.6.7.8 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 12345 4785380592391139x79927398713", "+1 (988) 555-2485 +12 +1.2.3.4.5.6.7.8.9.0 +99",
    "card: 4111.1111.1111.1111 call 415-555-2671 or 0049 30 901820", "x (at) example (dot) com, a [at] b.org",
    "fe80:0:0:0:1:2:3:4 is my ip 2001:db8:85a3:0:0:8a2e:370:7334", "9" * 3000, "a" * 20000 + "@b.c", "1-" * 3000, None, "",
]


def test_base_spans_match_brute_force(spark):
    check(spark, TEXTS)


def test_random_texts(spark):
    rng = random.Random(9)
    check(spark, ["".join(rng.choice("01+-. (@)ab.é%255") for _ in range(rng.randint(0, 80))) for _ in range(600)])


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("12 5+-.@a𝄞:\n", max_size=40), min_size=1, max_size=30))
def test_any_texts(spark, texts):
    check(spark, texts)


def test_weak_labels_add_spans_that_look_like_the_sure_ones(spark):
    rng = random.Random(1)
    sure = [f"please call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} today" for _ in range(60)]
    more = ["call 0049 171 555 2671 now", "phone: 00331 444 555 6666"]
    noise = [f"order 12-{rng.randint(100, 999)}-{rng.randint(100, 999)} of it" for _ in range(60)]
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(sure + more + noise)])
    got = {r["id"]: r for r in P.find_personal_data(docs).collect()}
    assert all(len(got[i]["spans"]) >= 1 for i in range(60))
    assert not any(got[i]["spans"] for i in range(62, 122))


def test_em_finds_the_reliable_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.5
    noisy = lambda q: np.where(rng.random(4000) < q, truth, ~truth) * 2 - 1
    votes = np.stack([noisy(0.95), noisy(0.7), noisy(0.6), np.zeros(4000, int)], axis=1)
    post, rate = P.em(votes, np.zeros(4000, int), np.ones(4000))
    assert ((post > 0.5) == truth).mean() > 0.92
    assert rate[0, 1, 2] > rate[1, 1, 2] > rate[2, 1, 2]


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    got = P.find_personal_data(docs).collect()
    assert len(got) == docs.count()
    assert P.find_personal_data(empty(spark)).count() == 0


def test_digest(spark):
    docs = documents(spark, [(1, "a@b.cd 1.2.3.4", "en", "s"), (2, None, "en", "s")])
    out = P.find_personal_data(docs)
    got = {r[0]: r[1] for r in out.select("id", P.written("base")).collect()}
    assert got == {1: "email:0:6,ip:7:14", 2: ""}
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
