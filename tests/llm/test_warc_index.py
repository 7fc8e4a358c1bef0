import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cardmarts.llm import warc_index as W
from cardmarts.llm.common import scratch

SCHEMA = "page_id long, url string, html string, file string, offset long, surt string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "f", 1, "s") for i, u, h in rows], SCHEMA).repartition(4)


def stored(spark, pages, block_rows=3):
    folder = scratch(spark, "warc-test")
    captures = W.with_record_types(pages, "page_id", "url", F.col("html").cast("binary"))
    entries = W.write_archives(captures, f"{folder}/archives")
    return entries, W.build_index(entries, f"{folder}/index", block_rows), folder


BIG, SMALL = "<p>é𝄞 WARC/1.1\r\n\r\n" + "x" * 200, "<p>short"


def rows():
    rng = random.Random(2)
    out = [(9, "http://b.example.com/1", BIG), (3, "http://a.example.com/2", BIG), (7, None, BIG), (4, "http://c.example.com/?q#f", SMALL),
           (5, "http://c.example.com/?q", SMALL), (6, "http://e.org/", None), (8, "http://e.org/", ""), (10, "bad url\n", "y" * 150_000),
           (None, "http://n.org/", BIG), (3, "http://a.example.com/2", BIG)]
    return out + [(100 + k, "http://hot.example.net/same", "z" * rng.randint(50, 150)) for k in range(60)]


def expected(data):
    first = {}
    for i, _, h in data:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h in data:
        b = (h or "").encode()
        seen = first.get(b) if len(b) >= 100 else None
        again = seen is not None and i != seen
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", seen if again else None))
    return sorted(out, key=str)


def test_every_page_is_read_back(spark):
    data = rows()
    pages = frame(spark, data)
    _, shards, folder = stored(spark, pages)
    got = W.lookup(pages, "url", shards, folder, with_payload=True).collect()
    assert sorted([tuple(r[k] for k in ("id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got], key=str) == expected(data)
    texts = {(i, (h or "").encode()) for i, _, h in data}
    assert all((r["id"], bytes(r["payload"])) in texts for r in got if r["record_type"] == "response")
    assert all(r["payload"] is None for r in got if r["record_type"] == "revisit")


def test_a_lookup_gives_all_captures_of_a_url_and_no_others(spark):
    data = rows()
    _, shards, folder = stored(spark, frame(spark, data), block_rows=4)  # the hot url spans many blocks
    ask = spark.createDataFrame([("http://hot.example.net/same",), ("http://nowhere.org/",), ("http://hot.example.net/same",)], "url string")
    got = W.lookup(ask, "url", shards, folder).collect()
    assert sorted(r["id"] for r in got) == list(range(100, 160))


def test_blocks_are_sorted_and_the_directory_is_sparse(spark):
    entries, shards, folder = stored(spark, frame(spark, rows()), block_rows=7)
    assert sum(r["blocks"] for r in shards.collect()) < entries.count()
    spans = sorted((r["first"], r["last"]) for r in shards.collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_empty(spark):
    pages = frame(spark, [])
    _, shards, folder = stored(spark, pages)
    assert W.lookup(pages, "url", shards, folder).count() == 0


def test_keys(spark):
    df = spark.createDataFrame([("http://A.b.Com/x/y?q#f",), (None,), ("plain",), ("http://h",)], "u string")
    assert [r[0] for r in df.select(W.surt(F.col("u"))).collect()] == ["com,b,a)/x/y?q", "", "plain", "h)"]


@pytest.mark.parametrize("firsts, lasts, key, want", [
    (["a", "c", "c"], ["c", "c", "e"], "c", [0, 1, 2]), (["a", "d"], ["b", "f"], "c", []), (["a"], ["b"], "z", []), ([], [], "a", [])])
def test_reach(firsts, lasts, key, want):
    assert list(W._reach(lasts, firsts, key)) == want


def test_damage_is_noticed():
    digest = hashlib.sha256(b"abc").hexdigest()
    raw = W.warc_record(1, "http://x/", b"abc", digest, None, False, "2024-01-01T00:00:00Z")
    assert W.parse_record(raw)["payload"] == b"abc"
    with pytest.raises(ValueError):
        W.parse_record(raw.replace(b"abc", b"abd"))
