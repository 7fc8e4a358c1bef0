r"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans of four kinds come from the base patterns (which also decide
the base spans) and from looser ones. Four labelers vote yes, no or abstain on
each candidate: its shape (regex), a checksum or range test, a gazetteer
(domain endings, card issuers, calling codes, reserved networks), and the
words just before it. Candidates are counted per kind, vote pattern and length
class, at most 4 x 81 x 8 rows whatever the input; over those counts
expectation-maximisation estimates each labeler's reliability, and a logistic
span classifier is trained on the resulting posteriors. It compiles into a
column expression that decides which looser candidates become spans. Base
spans always stay.

Positions: the k-th match starts after the gaps and matches before it, so
``split`` and ``regexp_extract_all`` by the same pattern give all offsets in
code points. The patterns are written without nested backtracking: a match can
only start where a run starts or the last match ended, and repeats are
possessive, so long runs of digits or letters stay linear and need no stack.

Not searched: compressed IPv6 addresses (``2001:db8::1``) and dotted cards other
than in groups of four (4-6-5).

One pass over the texts writes the narrow table of spans and votes to the
shared folder; nothing is shuffled by document.

Defined results: a null text counts as empty: no spans, and the digest of the
empty string. Repeated rows each give a row; other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.llm.common import col, materialize, table

KINDS = ["email", "ip", "card", "phone"]

# Base patterns. The same matches as
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+     ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+                                 phone \+[0-9][\x20().0-9-]+[0-9]
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser candidates: written-out addresses, IPv6 in full eight groups, card-like groups, numbers without a plus sign.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}[.\x20-]?[0-9]{4}[.\x20-]?[0-9]{4}[.\x20-]?[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+.])(?:00[0-9]{1,3}[\x20.-])?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9.])",
}
# A cheap test that must hold for the pattern to match at all.
GATE = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda t: t.contains("+"),
}
LOOSE_GATE = {
    "email": lambda t: t.contains("(at)") | t.contains("[at]"),
    "ip": lambda t: t.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]"),
    "card": lambda t: t.rlike(r"[0-9]{4}[.\x20-]?[0-9]{4}"),
    "phone": lambda t: t.rlike(r"[0-9]\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3}"),
}
# Gazetteers and cue words: fixed values.
GOOD_ENDINGS = r"(?i)\.(com|org|net|edu|gov|info|io|de|fr|es|it|nl|uk|eu)$"
ISSUERS = r"^(4|5[1-5]|2[2-7]|34|37|35|36|38|6011|62|64|65)"
CALLING_CODES = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED_NETS = r"^(0|10|127|169\.254|192\.168|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
CUES = {
    "email": r"(?i)(mail|contact|kontakt|correo|courriel|write to|reply)[^\n]{0,20}$",
    "ip": r"(?i)\b(ip|host|server|address|adresse|from|login)\b[^\n]{0,20}$",
    "card": r"(?i)(card|karte|carte|tarjeta|visa|master|amex|credit)[^\n]{0,20}$",
    "phone": r"(?i)(phone|tel|call|fax|mobil|handy|anruf|appel|llam)[^\n]{0,20}$",
}
AGAINST = r"(?i)(version|invoice|order|isbn|rechnung|factur|no\.|nr\.|id)[ :#=]{0,3}$"

_SPAN = "array<struct<start:int,stop:int,match:string,before:string>>"
N_LABELERS = 4


def located(text: Column, pattern: str, gate: Column) -> tuple[Column, Column]:
    """(matches, gaps) of a pattern; empty arrays where the gate does not hold."""
    none = F.array().cast("array<string>")
    return (F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
            F.when(gate, F.split(text, pattern, -1)).otherwise(none))


def spans(matches: Column, gaps: Column) -> Column:
    """array of (start, stop, match, before): code points, stop exclusive; before: up to 40 characters."""
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: F.struct(g.alias("g"), m.alias("m")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["g"])
        stop = start + F.char_length(x["m"])
        one = F.struct(start.alias("start"), stop.alias("stop"), x["m"].alias("match"), F.right(x["g"], F.lit(40)).alias("before"))
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    return F.when(F.size(matches) == 0, F.array().cast(_SPAN)).otherwise(
        F.aggregate(pairs, zero, step, lambda acc: acc["out"]))


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""
    n = F.length(number)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(number, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _octets_ok(x: Column) -> Column:
    return x.rlike(r"^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})){3}$")


def passes(kind: str, match: Column) -> Column:
    """The base test of a match of this kind."""
    if kind == "ip":
        return _octets_ok(match)
    if kind == "card":
        d = digits(match)
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    return F.lit(True)


def _passing(name: str, kind: str) -> Column:
    return F.filter(name, lambda s: passes(kind, s["match"]))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("int")


def labelers(kind: str, s: Column) -> list[Column]:
    """Votes (1, -1, 0) of the four labelers on a span: shape, check, gazetteer, context."""
    m, before, d = s["match"], s["before"], digits(s["match"])
    no = F.lit(False)
    cue, against = before.rlike(CUES[kind]), before.rlike(AGAINST)
    if kind == "email":
        shape = _vote(m.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+$"), no)
        check = _vote(F.char_length(m).between(6, 254), F.char_length(m) > 254)
        gaz = _vote(m.rlike(GOOD_ENDINGS), no)
    elif kind == "ip":
        shape = _vote(m.rlike(r"^[0-9.]+$"), no)
        check = _vote(_octets_ok(m) | m.contains(":"), no)
        gaz = _vote(no, m.rlike(RESERVED_NETS))
    elif kind == "card":
        shape = _vote(m.rlike(r"^[0-9]{4}([ -]?[0-9]{4}){2}[ -]?[0-9]{2,7}$"), m.contains("."))
        ok = F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)
        check = _vote(ok, ~ok)
        gaz = _vote(d.rlike(ISSUERS), ~d.rlike(ISSUERS))
    else:
        shape = _vote(m.rlike(r"^(\+|00)"), no)
        n = F.length(d)
        check = _vote(n.between(10, 15), (n < 7) | (n > 15))
        gaz = _vote(m.startswith("+") & d.rlike(CALLING_CODES), no)
    return [shape, check, gaz, _vote(cue, against)]


def find_candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, base spans (start, kind, stop) and candidates (start, kind, stop, base, votes, size) per document."""
    t = F.coalesce(col(text_col), F.lit(""))
    rows = docs.select(col(id_col).alias("id"), t.alias("text"))
    picks = []
    for which, patterns, gates in (("b", BASE, GATE), ("l", LOOSE, LOOSE_GATE)):
        for kind in KINDS:
            m, g = located(F.col("text"), patterns[kind], gates[kind](F.col("text")))
            picks += [m.alias(f"{which}m_{kind}"), g.alias(f"{which}g_{kind}")]
    rows = rows.select("id", *picks)
    rows = rows.select("id", *[spans(F.col(f"{w}m_{k}"), F.col(f"{w}g_{k}")).alias(f"{w}_{k}") for w in "bl" for k in KINDS])
    rows = rows.select("id", *[F.col(f"l_{k}") for k in KINDS],
                       *[_passing(f"b_{k}", k).alias(f"b_{k}") for k in KINDS])

    def marked(name: str, k: int, base: bool) -> Column:
        return F.transform(name, lambda s: F.struct(
            s["start"].alias("start"), F.lit(k).alias("kind"), s["stop"].alias("stop"), F.lit(base).alias("base"),
            F.array(*labelers(KINDS[k], s)).alias("votes"),
            F.least(F.floor(F.char_length(s["match"]) / 4), F.lit(7)).cast("int").alias("size")))

    rows = rows.select("id", F.concat(*[marked(f"b_{x}", k, True) for k, x in enumerate(KINDS)]).alias("base"),
                       F.concat(*[marked(f"l_{x}", k, False) for k, x in enumerate(KINDS)]).alias("loose"))
    free = F.filter("loose", lambda s: ~F.exists("base", lambda b: (s["start"] < b["stop"]) & (b["start"] < s["stop"])))
    return rows.select("id", "base", free.alias("loose"))


def em(votes: np.ndarray, kind: np.ndarray, count: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each counted pattern, and P(vote | truth) as [labeler, truth, vote + 1]."""
    post = 1 / (1 + np.exp(-votes.sum(axis=1).astype(float)))
    rate = np.full((votes.shape[1], 2, 3), 1 / 3)
    for _ in range(rounds):
        w = np.stack([count * (1 - post), count * post])
        for j in range(votes.shape[1]):
            for v in (-1, 0, 1):
                rate[j, :, v + 1] = w[:, votes[:, j] == v].sum(axis=1) + 1.0
        rate /= rate.sum(axis=2, keepdims=True)
        prior = np.array([(np.sum(w[1, kind == k]) + 1) / (np.sum(w[:, kind == k]) + 2) for k in range(len(KINDS))])
        odds = np.log(prior[kind] / (1 - prior[kind]))
        for j in range(votes.shape[1]):
            odds += np.log(rate[j, 1, votes[:, j] + 1] / rate[j, 0, votes[:, j] + 1])
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return post, rate


def features(kind: int, votes, size) -> list:
    """Of the classifier; the same for numbers and for columns."""
    as_number = (lambda x: x.cast("double")) if isinstance(size, Column) else float
    return [as_number(votes[j] == v) for j in range(N_LABELERS) for v in (-1, 1)] + [as_number(size) / 7.0, float(kind == 0), float(kind == 1), float(kind == 2), 1.0]


def fit_spans(counts: list, rounds: int = 300, ridge: float = 1e-3) -> np.ndarray:
    """Weights of the logistic span classifier, trained on the EM posteriors of the counted patterns."""
    if not counts:
        return np.array([0.0] * (2 * N_LABELERS + 4) + [-5.0])
    votes = np.array([list(r["votes"]) for r in counts])
    kind, n = np.array([r["kind"] for r in counts]), np.array([float(r["n"]) for r in counts])
    post, _ = em(votes, kind, n)
    x = np.array([features(r["kind"], r["votes"], r["size"]) for r in counts])
    w, share = np.zeros(x.shape[1]), np.sqrt(n) / np.sqrt(n).sum()  # rare patterns count too
    for _ in range(rounds):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - post)) + ridge * w
        hess = (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return w


def span_score(weights: np.ndarray, s: Column) -> Column:
    """The classifier's probability for a candidate, as a column."""
    total = F.lit(0.0)
    for k in range(len(KINDS)):
        z = F.lit(0.0)
        for w, x in zip(weights, features(k, s["votes"], s["size"]), strict=True):
            z = z + float(w) * x
        total = F.when(s["kind"] == k, z).otherwise(total)
    return 1 / (1 + F.exp(-total))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       threshold: float = 0.8) -> DataFrame:
    """id, base spans and all spans, both as sorted arrays of (start, kind, stop)."""
    found = materialize(find_candidates(docs, id_col, text_col), "candidates")
    counted = found.select(F.explode(F.concat("base", "loose")).alias("c")).groupBy(
        F.col("c.kind").alias("kind"), F.col("c.votes").alias("votes"), F.col("c.size").alias("size")).agg(F.count("*").alias("n"))
    weights = fit_spans(sorted(counted.collect(), key=lambda r: (r["kind"], list(r["votes"]), r["size"])))
    short = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))
    base = F.transform("base", short)
    more = F.transform(F.filter("loose", lambda s: span_score(weights, s) >= threshold), short)
    return found.select("id", F.sort_array(base).alias("base"), F.sort_array(F.concat(base, more)).alias("spans"))


def written(spans_col: str) -> Column:
    """kind:start:end, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans_col, lambda s: F.concat(
        F.get(name, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["stop"].cast("string"))), ",")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select(F.col("id").alias("doc_id"), *[count(k).alias(f"n_{x}") for k, x in enumerate(KINDS)],
                       F.sha2(written("base").cast("binary"), 256).alias("base_sha256"), written("spans").alias("spans"))
