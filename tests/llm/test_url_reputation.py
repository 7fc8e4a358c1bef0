import re

from cardmarts.llm import url_reputation as U
from pyspark.sql import functions as F

PAGES = "page_id long, url string, host string, verdict string"
URLS = [
    "http://a.example.net/en/1", "https://b.example.net/de/", "HTTP://A.Example.NET", "http://x.example.com/de/3?q=/de/",
    "http://example.com/de", "http://foo.org/fr/1", "http://foo.org/en/1", None, "", "no scheme", "http://", "http:///path",
    "ftp://Host.COM/a#b", "http://net/x", "http://notnet/x", "http://a.b://c.net/x", "http://spam.biz/1\n2?x",
]


def expected(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_for(host, path):
    best = None
    for v, h, p in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return best or (None, None)


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], PAGES)


def test_hosts_paths_and_rules(spark):
    pages = frame(spark, URLS)
    none = pages.limit(0).select("url", F.lit(True).alias("bad"))
    for r in U.judge_urls(pages, none).collect():
        host, path = expected(URLS[r["id"]])
        rule, verdict = rule_for(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or "allow")


def test_bad_hosts_fall_and_doubt_speaks_for_the_page(spark):
    good = [(f"http://good{i % 20}.example.biz/{i}", False) for i in range(400)]
    bad = [(f"http://spam.farm.info/{i}", True) for i in range(60)]
    rare = [("http://once.example.biz/1", True)]
    outcomes = spark.createDataFrame([*good, *bad, *rare, ("http://null.biz/", None)], "url string, bad boolean")
    pages = frame(spark, ["http://spam.farm.info/x", "http://once.example.biz/2", "http://good1.example.biz/", "http://new.example.biz/"])
    got = {r["id"]: r for r in U.judge_urls(pages, outcomes).collect()}
    assert [got[i]["verdict"] for i in range(4)] == ["block", "allow", "allow", "allow"]
    assert got[1]["bad_rate"] > got[3]["bad_rate"] > 0  # one bad outcome counts, shrunk towards its domain
    assert got[0]["bad_lower"] > 0.5


def test_empty_and_repeated(spark):
    pages = frame(spark, URLS)
    none = pages.limit(0).select("url", F.lit(True).alias("bad"))
    assert U.judge_urls(pages.limit(0), none).count() == 0
    assert U.judge_urls(pages.union(pages), none).count() == 2 * len(URLS)


def test_very_long_urls_and_clashing_columns(spark):
    long = "http://" + "a" * 200_000 + ".example.com/de/" + "x/" * 200_000 + "?" + "q" * 100_000
    pages = frame(spark, [long, long])
    none = pages.limit(0).select("url", F.lit(True).alias("bad"))
    rows = U.judge_urls(pages, none).collect()
    assert len(rows) == 2 and all((r["host"], r["path"]) == expected(long) and r["rule"] == "example.com/de/" for r in rows)


def test_suffixes_of_several_labels(spark):
    hosts = ["a.b.co.uk", "co.uk", "x.github.io", "github.io", "www.example.com", "com", "", "a.b.c.d.kawasaki.jp"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    more = (*U.SUFFIXES, "d.kawasaki.jp")
    got = [tuple(r) for r in df.select(U.registered_domain(F.col("h"), more), U.suffix(F.col("h"), more)).collect()]
    assert got == [("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("x.github.io", "github.io"), ("github.io", "github.io"), ("example.com", "com"),
                   ("com", "com"), ("", ""), ("c.d.kawasaki.jp", "d.kawasaki.jp")]
    # neighbours under a shared suffix are no relatives: only the bad site's own hosts fall
    bad = [("http://spam.github.io/", True)] * 80 + [(f"http://u{k % 8}.github.io/", False) for k in range(160)]
    outcomes = spark.createDataFrame(bad, "url string, bad boolean")
    pages = frame(spark, ["http://new.spam.github.io/x", "http://fresh.github.io/x"])
    new, old = ({r["id"]: r["bad_rate"] for r in U.judge_urls(pages, outcomes, suffixes=x).collect()} for x in (U.SUFFIXES, ()))
    assert new[0] > 0.7 > 0.5 > new[1] and old[0] == old[1]
