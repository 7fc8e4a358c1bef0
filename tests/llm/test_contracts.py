"""What the registered queries promise, on the given tables: columns, types and values against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
import regex

from cardmarts.llm import language_id as L
from cardmarts.llm import quality_rules as Q
from cardmarts.llm import url_reputation as U
from cardmarts.llm.queries import QUERIES

SCHEMAS = {
    "op1_warc_index": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op2_prob_minhash": {"doc_id": "bigint", "class_id": "bigint"},
    "op3_cross_polytope": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op4_url_reputation": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op5_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op6_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op7_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op8_sentencepiece": {"doc_id": "bigint"},
    "op9_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op10_quality_rules": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_divergence_audit": {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"},
    "op12_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op13_filter_interaction": {"part": "string", "filter_order": "string", "step": "int", "kept": "bigint", "removed": "bigint", "redundant": "bigint",
                                "unique_fails": "bigint", "good_lost": "bigint", "toxic_lost": "bigint", "shapley": "bigint"},
}


def rows_of(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r for r in rows_of(spark, sf_dir, "documents")}


@pytest.fixture(scope="module")
def answers(spark, sf_dir):
    """Each query's rows, made once."""
    made = {}

    def get(key):
        if key not in made:
            df = QUERIES[key](spark, sf_dir)
            kinds = dict(df.dtypes)
            assert SCHEMAS[key].items() <= kinds.items(), key
            made[key] = df.collect()
        return made[key]

    return get


def crc(i, mod):
    return zlib.crc32(str(i).encode()) % mod


def test_every_query_has_a_contract():
    assert set(SCHEMAS) == set(QUERIES)


@pytest.mark.parametrize("key", [k for k in SCHEMAS if k.split("_")[0] in ("op2", "op5", "op6", "op7", "op8", "op9", "op10", "op12")])
def test_one_row_per_document_with_its_columns(answers, docs, key):
    assert sorted(r["doc_id"] for r in answers(key)) == sorted(docs)


@pytest.mark.parametrize("key", ["op1_warc_index", "op4_url_reputation"])
def test_one_row_per_page(spark, sf_dir, answers, key):
    assert sorted(r["page_id"] for r in answers(key)) == sorted(r["page_id"] for r in rows_of(spark, sf_dir, "pages"))


def test_op4_rules_and_hosts(spark, sf_dir, answers):
    urls = {r["page_id"]: r["url"] for r in rows_of(spark, sf_dir, "pages")}
    for r in answers("op4_url_reputation"):
        url = urls[r["page_id"]]
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        assert r["path"] == re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        assert r["host"] == host and r["verdict"] in ("allow", "block")
        fit = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and r["path"].startswith(p)]
        assert r["rule"] == (max(fit)[1] if fit else None)
        if fit:
            assert r["verdict"] == max(fit)[2]


def brute_reputation(outcomes, low=2.0, high=1000.0):
    """Beta posteriors (mean, lower bound) per host, by hand."""
    host, dom, suf = (defaultdict(lambda: [0, 0]) for _ in range(3))
    for h, bad in outcomes:
        for level, key in ((host, h), (dom, ".".join(h.split(".")[-2:])), (suf, h.split(".")[-1])):
            level[key][0] += 1
            level[key][1] += bad

    def strength(level):
        n, b = [x[0] for x in level.values()], [x[1] for x in level.values()]
        mean = (sum(b) + 0.5) / (sum(n) + 1.0)
        rates = [y / x for x, y in zip(n, b, strict=True)]
        spread = float(np.var(rates)) if rates else 0.0
        binom = mean * (1 - mean)
        extra = spread - binom * (float(np.mean([1 / x for x in n])) if n else 0.0)
        return mean, min(max(binom / extra - 1 if extra > 0 else high, low), high)

    def post(n, bad, mean, s):
        return bad + mean * s, n - bad + (1 - mean) * s

    top, at_dom, at_host = strength(suf), strength(dom), strength(host)
    prior = (top[0] * top[1], (1 - top[0]) * top[1])
    s_post = {k: post(*v, *top) for k, v in suf.items()}
    mean = lambda ab: ab[0] / (ab[0] + ab[1])
    d_post = {k: post(*v, mean(s_post[k.split(".")[-1]]), at_dom[1]) for k, v in dom.items()}
    h_post = {k: post(*v, mean(d_post[".".join(k.split(".")[-2:])]), at_host[1]) for k, v in host.items()}

    def of(h, z=1.645):
        a, b = h_post.get(h) or d_post.get(".".join(h.split(".")[-2:])) or s_post.get(h.split(".")[-1]) or prior
        m = a / (a + b)
        return m, max(0.0, m - z * math.sqrt(m * (1 - m) / (a + b + 1)))

    return of


def test_op4_posteriors_equal_the_formulas(spark):
    rng = np.random.default_rng(4)
    hosts = [f"h{k}.{d}" for k in range(12) for d in ("a.biz", "b.biz", "c.info", "spam.info")] + ["plain", ""]
    rate = {h: 0.9 if "spam" in h else float(rng.beta(2, 8)) for h in hosts}
    outcomes = [(h, bool(rng.random() < rate[h])) for h in hosts[::2] for _ in range(int(rng.integers(1, 40)))]
    of = brute_reputation([(h, int(b)) for h, b in outcomes])
    seen = spark.createDataFrame([(f"http://{h}/x", b) for h, b in outcomes] + [("http://h0.a.biz/", None)], "url string, bad boolean")
    pages = spark.createDataFrame([(k, f"http://{h}/p") for k, h in enumerate([*hosts, "new.a.biz", "x.new.info", "far.org"])], "page_id long, url string")
    for r in U.judge_urls(pages, seen, rules=[]).collect():
        mean, low = of(r["host"])
        assert abs(r["bad_rate"] - mean) < 1e-9 and abs(r["bad_lower"] - low) < 1e-9
        assert r["verdict"] == ("block" if low > 0.5 else "allow")


WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def brute_language(train, max_words=20_000, max_grams=5_000, max_n=4, smooth=0.5, backoff=0.4):
    words = defaultdict(Counter)
    for text, lang in train:
        words[lang].update(WORD.findall(text.lower()))
    grams = [defaultdict(Counter) for _ in range(max_n)]
    for lang, c in words.items():
        for w, n in c.items():
            marked = f" {w} "
            for k in range(1, max_n + 1):
                for i in range(len(marked) - k + 1):
                    grams[k - 1][lang][marked[i:i + k]] += n
    langs = sorted(words)
    top = lambda c, most: dict(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:most])

    def rates(by_lang, most):
        kept = {lang: top(c, most) for lang, c in by_lang.items()}
        items = {x for c in kept.values() for x in c}
        out = {}
        for x in items:
            v = [math.log((kept[lang].get(x, 0) + smooth) / (sum(kept[lang].values()) + smooth * (len(items) + 1))) for lang in langs]
            out[x] = [y - sum(v) / len(v) for y in v]
        return out

    known, parts = rates(words, max_words), [rates(g, max_grams) for g in grams]

    def score(w):
        if w in known:
            return known[w]
        total, marked, i = [0.0] * len(langs), f" {w} ", 0
        while i < len(marked):
            for n in range(min(max_n, len(marked) - i), 0, -1):
                hit = parts[n - 1].get(marked[i:i + n])
                if hit is not None:
                    total = [a + b * backoff ** (max_n - n) for a, b in zip(total, hit, strict=True)]
                    i += n
                    break
            else:
                i += 1
        return total

    def predict(text):
        found = WORD.findall((text or "").lower())
        if not found:
            return "und", 0.0
        total = [sum(x) for x in zip(*map(score, found), strict=True)]
        z = [x / math.sqrt(len(found)) for x in total]
        best = max(range(len(langs)), key=lambda i: (total[i], -i))
        return langs[best], 1 / sum(math.exp(x - z[best]) for x in z)

    return predict


def test_op5_equals_the_method_by_hand(answers, docs):
    predict = brute_language([(r["text"], r["lang"]) for i, r in docs.items() if crc(i, 3) != 1 and r["lang"] is not None and r["text"] is not None])
    right = []
    for r in answers("op5_language_id"):
        lang, score = predict(docs[r["doc_id"]]["text"])
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-6
        assert r["held_out"] == (crc(r["doc_id"], 3) == 1)
        if r["held_out"]:
            right.append(lang == docs[r["doc_id"]]["lang"])
    assert np.mean(right) > 0.97


def test_op9_sizes_targets_and_limits(answers, docs):
    size = {i: len(re.findall("[^\x20\x09-\x0d]+", r["text"] or "")) for i, r in docs.items()}
    per_source = Counter()
    for i, r in docs.items():
        per_source[r["source"]] += size[i]
    order = sorted(per_source, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, rest = {}, set(order), float(sum(per_source.values()))
    while left:
        unit = rest / sum(weight[s] for s in left)
        full = [s for s in left if weight[s] * unit > 3 * per_source[s]]
        for s in full or list(left):
            target[s] = 3.0 * per_source[s] if full else weight[s] * unit
            left.discard(s)
        rest -= sum(target[s] for s in full)
    taken, longest = Counter(), Counter()
    for r in answers("op9_mixing"):
        s = docs[r["doc_id"]]["source"]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], per_source[s]) and abs(r["target"] - target[s]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["taken"] == 0 if not r["size"] else r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in order)


def test_op9_comes_near_its_targets(spark):
    got = Counter()
    target = {}
    documents = {r["doc_id"]: r["source"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source").collect()}
    for r in QUERIES["op9_mixing"](spark, "/root/testdata/sf0.1").collect():
        got[documents[r["doc_id"]]] += r["taken"]
        target[documents[r["doc_id"]]] = r["target"]
    assert all(abs(got[s] / target[s] - 1) < 0.01 for s in target)


def test_op10_scores_are_the_rules_sums(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stats, names = Q.with_statistics(documents, "doc_id", "text")
    by_hand = {}
    for r in documents.collect():
        t = r["text"] or ""
        words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", t) if w]
        n, chars = max(len(words), 1), max(len(t), 1)
        by_hand[r["doc_id"]] = {
            "log_words": math.log1p(len(words)), "word_length": len(t) / n, "distinct_words": len(set(words)) / n,
            "repeated_words": sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, "log_distinct": math.log1p(len(set(words))),
            "capitals": len(regex.findall(r"\p{Lu}", t)) / chars, "symbols": len(regex.findall(Q.SYMBOL, t)) / chars,
            "digits": len(re.findall("[0-9]", t)) / chars, **{f"{k}s": t.count(c) / n for k, c in Q.COUNTED.items()}}
    got = stats.collect()
    for r in got:
        for k in names:
            assert abs(r[k] - by_hand[r["id"]][k]) < 1e-9, k
    ensemble = Q.RuleEnsemble([Q.Rule((("capitals", ">", 0.01), ("log_words", "<=", 5.0)), 1.5), Q.Rule((("stops", "<=", 0.1),), -0.75)], 0.25)
    for r in stats.select("id", ensemble.score().alias("score")).collect():
        s, total = by_hand[r["id"]], 0.25
        total += 1.5 if s["capitals"] > 0.01 and s["log_words"] <= 5.0 else 0
        total -= 0.75 if s["stops"] <= 0.1 else 0
        assert abs(r["score"] - 1 / (1 + math.exp(-total))) < 1e-9


@pytest.mark.parametrize("key, label, mod, remainder, least", [("op10_quality_rules", "quality", 5, 0, 0.9), ("op12_toxicity", "toxic", 4, 2, 0.95)])
def test_classifiers_rank_held_out_documents(spark, key, label, mod, remainder, least):
    truth = {r["doc_id"]: r[label] for r in rows_of(spark, "/root/testdata/sf0.01", "labels")}
    rows = QUERIES[key](spark, "/root/testdata/sf0.01").collect()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (crc(r["doc_id"], mod) == remainder)
    test = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and truth.get(r["doc_id"]) is not None]
    good, bad = [s for s, t in test if t == 1], [s for s, t in test if t == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc >= least, auc


def test_op2_classes_are_equal_texts_at_least(answers, docs):
    cls = {r["doc_id"]: r["class_id"] for r in answers("op2_prob_minhash")}
    first = {}
    for i in sorted(docs):
        first.setdefault(docs[i]["text"] or "", i)
    for i in docs:
        assert cls[i] == cls[first[docs[i]["text"] or ""]] and cls[i] <= i and cls[cls[i]] == cls[i]


def test_op6_counts_and_digest_agree_with_the_spans(answers):
    for r in answers("op6_pii"):
        spans = [x.rsplit(":", 2) for x in r["spans"].split(",")] if r["spans"] else []
        count = Counter(k for k, _, _ in spans)
        for kind in ("email", "ip", "card", "phone"):
            assert r[f"n_{kind}"] <= count[kind] or r[f"n_{kind}"] == count[kind]
        assert len(r["base_sha256"]) == 64 and r["base_sha256"] == r["base_sha256"].lower()
        assert spans == sorted(spans, key=lambda s: (int(s[1]), ["email", "ip", "card", "phone"].index(s[0])))
        if not spans:
            assert r["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_op13_orders_agree_on_what_is_left(answers):
    last = defaultdict(set)
    for r in answers("op13_filter_interaction"):
        if r["step"] == 5:
            last[r["part"]].add(r["kept"])
    assert all(len(v) == 1 for v in last.values())
    assert {r["filter_order"] for r in answers("op13_filter_interaction")} == {"".join(p) for p in permutations("ABCDE")}


def test_language_model_is_used_as_learned(spark):
    """The registered model and the one by hand agree word by word."""
    rows = [("der die das und", "de"), ("the and of to", "en"), ("le la les et", "fr"), ("und the et", "en")]
    df = spark.createDataFrame([(k, t, x) for k, (t, x) in enumerate(rows)], "doc_id long, text string, lang string")
    model, predict = L.fit_language_model(df), brute_language(rows)
    for text in ("und das", "theand lesla", "zzz", "Straße und École", "q", ""):
        got, want = model.predict(text), predict(text)
        assert got[0] == want[0] and abs(got[1] - want[1]) < 1e-9, text
