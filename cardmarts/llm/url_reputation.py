"""URL filter: host reputation by empirical Bayes, in DataFrame functions only.

Labelled page outcomes (good or bad) are counted per host. A beta prior is
fitted by the method of moments at each level and handed down: suffixes shrink
to the prior of all suffixes, registered domains to their suffix's posterior,
hosts to their domain's posterior. A host is blocked when the lower bound of
its posterior bad rate (mean less ``z`` standard deviations) is above
``max_bad``: doubt speaks for the page. Hosts without any outcome inherit
their domain's posterior, domains without one their suffix's, and so on.

An explicit rule overrides the method. A rule fits its host and all
subdomains when the url's path starts with the rule's; of the rules that fit,
the longest (host and path together) wins.

Only one row per host, domain and suffix is shuffled after map-side counting;
the join back to the pages is on the host, whose hot values adaptive
execution splits. The suffix is the longest of ``suffixes`` (those of several
labels, a parameter) that the host ends with, else its last label; the
registered domain is the suffix and one label more.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule, and gets the verdict of a host without outcomes. A null
outcome is no outcome. Repeated rows count each time. Empty tables give an
empty result. Very long urls are read whole; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.llm.common import col, materialize, table

# Fixed rules of the query: (verdict, host, path).
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
# Suffixes of several labels under which unrelated owners register names; pass a full public list where there is one.
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "com.br", "com.cn", "com.mx", "com.tr",
    "co.in", "co.kr", "co.za", "blogspot.com", "github.io", "gitlab.io", "herokuapp.com", "netlify.app", "pages.dev", "vercel.app", "web.app",
)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_host(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_labels(host: Column, suffixes: tuple[str, ...], more: int) -> Column:
    """The host's suffix and ``more`` labels before it."""
    out = F.substring_index(host, ".", -1 - more)
    for labels in sorted({x.count(".") + 1 for x in suffixes}):  # the longest is asked for first
        known = [x for x in suffixes if x.count(".") + 1 == labels]
        out = F.when(F.substring_index(host, ".", -labels).isin(known), F.substring_index(host, ".", -labels - more)).otherwise(out)
    return out


def registered_domain(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    return _by_labels(host, suffixes, 1)


def suffix(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    return _by_labels(host, suffixes, 0)


def rule_fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    _, h, p = rule
    return ((host == h) | host.endswith("." + h)) & path.startswith(p)


def first_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does; ties to the text's order."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule = verdict = F.lit(None).cast("string")
    for r in reversed(ordered):
        fits = rule_fits(host, path, r)
        rule = F.when(fits, F.lit(r[1] + r[2])).otherwise(rule)
        verdict = F.when(fits, F.lit(r[0])).otherwise(verdict)
    return rule, verdict


def _strength(level: DataFrame, lowest: float, highest: float) -> tuple[float, float]:
    """The mean bad rate of a level's groups and the prior's strength (one row reaches the driver).

    Method of moments: the spread of the groups' rates beyond binomial noise
    gives the beta prior's number of pseudo-outcomes, held in a sane range.
    """
    r = F.col("bad") / F.col("n")
    m = level.filter("n > 0").agg(
        F.sum("bad").alias("b"), F.sum("n").alias("t"), F.count("*").alias("k"),
        F.var_pop(r).alias("v"), F.avg(1 / F.col("n")).alias("noise"))
    mean = (F.coalesce(F.col("b"), F.lit(0)) + 0.5) / (F.coalesce(F.col("t"), F.lit(0)) + 1.0)
    spread = F.coalesce(F.col("v"), F.lit(0.0))
    binom = mean * (1 - mean)
    # var(rate) = binom * noise + binom / (strength + 1) * (1 - noise)
    extra = spread - binom * F.coalesce(F.col("noise"), F.lit(0.0))
    s = F.when(extra > 0, binom / extra - 1).otherwise(F.lit(highest))
    row = m.select(mean.alias("mean"), F.least(F.greatest(s, F.lit(lowest)), F.lit(highest)).alias("strength")).first()
    return row["mean"], row["strength"]


def fit_reputation(outcomes: DataFrame, url_col: str = "url", bad_col: str = "bad",
                   lowest: float = 2.0, highest: float = 1000.0, suffixes: tuple[str, ...] = SUFFIXES,
                   ) -> tuple[DataFrame, DataFrame, DataFrame, tuple[float, float]]:
    """Posteriors (key, a, b) per host, domain and suffix, and the beta prior of all suffixes.

    ``lowest`` and ``highest`` bound a prior's pseudo-outcomes.
    """
    of_suffix, of_domain = (lambda h: suffix(h, suffixes)), (lambda h: registered_domain(h, suffixes))
    flag = col(bad_col).cast("boolean")
    counted = outcomes.filter(flag.isNotNull()).groupBy(url_host(col(url_col)).alias("host")).agg(
        F.count("*").alias("n"), F.count_if(flag).alias("bad"))
    hosts = materialize(counted, "host-outcomes")
    by = lambda key: hosts.groupBy(key(F.col("host")).alias("key")).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    tops, domains = by(of_suffix), by(of_domain)
    hosts = hosts.withColumnRenamed("host", "key")

    def shrink(level: DataFrame, parent: DataFrame | None, parent_key, s: tuple[float, float]) -> DataFrame:
        """Posterior of each group under the prior that its parent's posterior mean gives."""
        mean, strength = map(F.lit, s)
        rows = level
        if parent is not None:
            up = parent.select(F.col("key").alias("up"), (F.col("a") / (F.col("a") + F.col("b"))).alias("up_mean"))
            rows = rows.withColumn("up", parent_key(F.col("key"))).join(up, "up", "left")
            mean = F.coalesce(F.col("up_mean"), mean)
        return rows.select("key", (F.col("bad") + mean * strength).alias("a"),
                           (F.col("n") - F.col("bad") + (1 - mean) * strength).alias("b"))

    top = _strength(tops, lowest, highest)
    suffix_post = materialize(shrink(tops, None, None, top), "suffixes")
    domain_post = materialize(shrink(domains, suffix_post, of_suffix, _strength(domains, lowest, highest)), "domains")
    host_post = shrink(hosts, domain_post, of_domain, _strength(hosts, lowest, highest))
    return host_post, domain_post, suffix_post, (top[0] * top[1], (1 - top[0]) * top[1])


def judge_urls(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules: list[tuple[str, str, str]] | None = None, max_bad: float = 0.5, z: float = 1.645,
               suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """Each page's id, host, path, rule, verdict, and its host's posterior (bad_rate, bad_lower)."""
    host_post, domain_post, suffix_post, prior = fit_reputation(outcomes, url_col, suffixes=suffixes)
    url = col(url_col)
    rows = pages.select(col(id_col).alias("id"), url_host(url).alias("host"), url_path(url).alias("path"))
    # what a host without outcomes inherits is settled on the distinct hosts, not on the pages
    known = rows.select("host").distinct()
    side = lambda df, key: df.select(F.col("key").alias(key), F.col("a").alias(f"{key}_a"), F.col("b").alias(f"{key}_b"))
    known = (known.withColumn("h", F.col("host")).withColumn("d", registered_domain(F.col("host"), suffixes))
             .withColumn("s", suffix(F.col("host"), suffixes))
             .join(side(host_post, "h"), "h", "left").join(side(domain_post, "d"), "d", "left")
             .join(side(suffix_post, "s"), "s", "left"))
    a, b = (F.coalesce(F.col(f"h_{x}"), F.col(f"d_{x}"), F.col(f"s_{x}"), F.lit(p)) for x, p in zip("ab", prior, strict=True))
    mean = a / (a + b)
    sd = F.sqrt(mean * (1 - mean) / (a + b + 1))
    scores = materialize(known.select("host", mean.alias("bad_rate"), F.greatest(F.lit(0.0), mean - z * sd).alias("bad_lower")),
                         "host-scores")
    rule, by_rule = first_rule(F.col("host"), F.col("path"), RULES if rules is None else rules)
    method = F.when(F.col("bad_lower") > max_bad, "block").otherwise("allow")
    return rows.join(scores, "host", "left").select(
        F.col("id"), "host", "path", rule.alias("rule"), F.coalesce(by_rule, method).alias("verdict"),
        "bad_rate", "bad_lower")


def op4_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged; outcomes are the quality labels given for the pages' ids."""
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), "quality")
    outcomes = pages.select("page_id", "url").join(labels, "page_id").select(
        "url", (F.col("quality") == 0).alias("bad"))
    return judge_urls(pages, outcomes).withColumnRenamed("id", "page_id")
