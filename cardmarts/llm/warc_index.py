"""WARC archives with a two-level capture index.

Writing: every task writes its records, each a gzip member of its own, to new
files in the shared folder and hands on one index entry per record (reversed-
host url key, id, file, offset, length). File names are new for each attempt
and only the entries of committed tasks are kept, so a lost executor leaves at
most unreferenced files behind.

Index: entries are range-partitioned and sorted by (key, id, offset), which
splits a key that a third of the captures share. A shard is a file of
compressed blocks of ``block_rows`` entries, and beside it a sparse directory
with the first and last key, offset and length of each block. The list of
shards (one row each, at most as many as shuffle partitions) is all that is
held by the driver.

Reading: keys are binary-searched in the list of shards, then in the shard's
directory, which names the blocks; a block is fetched by a range read and
searched for its entries, which name the records; these are sorted by file and
offset and fetched by range reads again. A key that spans many blocks gives a
row for each, so its blocks are fetched by many tasks.

Files are reached through the file systems that pyarrow knows (local, HDFS,
S3, GCS), under the folder in spark.checkpoint.dir.

Of records with equal payloads of at least ``least`` bytes the one with the
smallest id is a response and the others revisit it; shorter ones are all
responses. Only pages whose payload may occur twice (a bounded Bloom filter
tells) are shuffled.

Defined results: a null payload is empty; a null url has the empty key and no
target header; a null id is carried and never the smallest. Rows that repeat a
response's id and payload are responses too. Control characters in a url are
percent-encoded in the header. An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.llm.common import byte_slices, col, materialize, scratch, table
from cardmarts.llm.exact_dedup import probe, repeat_filter
from cardmarts.llm.url_reputation import url_host

FILE_BYTES = 1 << 30  # an archive file is closed beyond this size
READ_AHEAD = 1 << 20
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard's namespace for urls
_ENTRY = "surt string, id long, file string, offset long, length long"


def surt(url: Column) -> Column:
    """Sort key of a url: the host's labels reversed, then path and query; empty for a null url."""
    host = url_host(url)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    key = F.concat(F.concat_ws(",", F.reverse(F.split(host, r"\."))), F.lit(")"), rest)
    return F.when(url.isNull(), "").when(url.contains("://"), key).otherwise(url)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{page}:{digest}')}>"


def warc_record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One uncompressed record. A revisit has the response's HTTP header and no body."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page, digest)}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page is not None:
        head.append(f"X-Page-Id: {page}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of a record; its payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    block = rest[: int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length: (\d+)", http)[1])
    digest = h["warc-payload-digest"].removeprefix("sha256:")
    kind = h["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {h['warc-record-id']}")
    number = lambda x: int(x) if x is not None else None
    return {"id": number(h.get("x-page-id")), "url": h.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": number(h.get("x-refers-to-page-id")), "payload": payload if kind == "response" else None}


def with_record_types(pages: DataFrame, id_col: str, url_col: str, payload: Column, least: int = 100,
                      max_bits: int = 1 << 26) -> DataFrame:
    """(id, url, payload, digest, refers_to, revisit) per page."""
    body = F.coalesce(payload, F.lit(b""))
    rows = pages.select(col(id_col).cast("long").alias("id"), col(url_col).alias("url"), body.alias("payload"),
                        F.unhex(F.sha2(body, 256)).alias("digest"))
    long = materialize(rows.filter(F.octet_length("payload") >= least).select("id", "digest"), "payload-digests")
    filters = repeat_filter(long, max_bits)
    groups = probe(long, *filters).filter("maybe").groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    groups = materialize(groups.filter("n > 1").drop("n"), "payload-groups")
    flagged = probe(rows, *filters).withColumn("maybe", F.col("maybe") & (F.octet_length("payload") >= least))
    alone = flagged.filter(~F.col("maybe")).withColumn("first", F.lit(None).cast("long"))
    more = flagged.filter("maybe").join(groups, "digest", "left").select(*alone.columns)
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return alone.unionByName(more).select(
        "id", "url", "payload", F.lower(F.hex("digest")).alias("digest"), F.when(revisit, F.col("first")).alias("refers_to"),
        revisit.alias("revisit"), surt(F.col("url")).alias("surt"))


def write_archives(captures: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", level: int = 3) -> DataFrame:
    """Write all captures below ``folder``; the index entries (surt, id, file, offset, length)."""
    fs, path = _open(folder)
    fs.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        out = name = None
        at = 0
        try:
            for batch in batches:
                rows = []
                for r in (x for part in byte_slices(batch, "payload") for x in part.to_pylist()):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(name, compression=None)  # the members are compressed already
                    raw = warc_record(r["id"], r["url"], r["payload"], r["digest"], r["refers_to"], r["revisit"], date)
                    z = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = z.compress(raw) + z.flush()
                    out.write(member)
                    rows.append((r["surt"], r["id"], name, at, len(member)))
                    at += len(member)
                yield _batch(rows, ["surt", "id", "file", "offset", "length"], [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()])
        finally:
            if out is not None:
                out.close()

    return materialize(captures.select("id", "url", "payload", "digest", "refers_to", "revisit", "surt").mapInArrow(run, _ENTRY), "entries")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _pack(entries: list[list]) -> bytes:
    return zlib.compress("\n".join(json.dumps(e) for e in entries).encode(), 6)


def _unpack(raw: bytes) -> list[list]:
    return [json.loads(x) for x in zlib.decompress(raw).decode().split("\n")]


def build_index(entries: DataFrame, folder: str, block_rows: int = 1000) -> DataFrame:
    """Write shards and their directories below ``folder``; one row per shard, with its first and last key."""
    fs, path = _open(folder)
    fs.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        name, out, at, blocks, waiting = f"{base}/{uuid.uuid4().hex}", None, 0, [], []

        def flush() -> None:
            nonlocal out, at, waiting
            out = out or store.open_output_stream(f"{name}.blocks", compression=None)
            raw = _pack(waiting)
            out.write(raw)
            blocks.append([waiting[0][0], waiting[-1][0], at, len(raw)])
            at, waiting = at + len(raw), []

        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                waiting.append(list(r))
                if len(waiting) == block_rows:
                    flush()
        if waiting:
            flush()
        if out is not None:
            out.close()
            directory = _pack(blocks)
            with store.open_output_stream(f"{name}.directory", compression=None) as f:
                f.write(struct.pack("<q", len(blocks)) + directory)
            yield _batch([(name, blocks[0][0], blocks[-1][1], len(blocks))], ["shard", "first", "last", "blocks"],
                         [pa.string(), pa.string(), pa.string(), pa.int64()])

    ordered = entries.repartitionByRange("surt", "id", "file", "offset").sortWithinPartitions("surt", "id", "file", "offset")
    return materialize(ordered.select("surt", "id", "file", "offset", "length").mapInArrow(
        run, "shard string, first string, last string, blocks long"), "shards")


def _reducers(spark: SparkSession) -> int:
    """The session's shuffle partitions, stated: a few bytes of an entry stand for a whole block or record,
    so adaptive execution must not merge partitions by the size of their entries."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _reach(lasts: list[str], firsts: list[str], key: str) -> range:
    """Places of the sorted ranges [first, last] that can hold the key."""
    lo = bisect.bisect_left(lasts, key)
    hi = bisect.bisect_right(firsts, key)
    return range(lo, hi)


def find_entries(keys: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """Index entries of the distinct keys (surt), by binary search in shards, directories and blocks."""
    rows = sorted((r["first"], r["last"], r["shard"]) for r in shards.collect())  # one row per shard
    shared = keys.sparkSession.sparkContext.broadcast(rows)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _open(folder)
        firsts, lasts = [r[0] for r in shared.value], [r[1] for r in shared.value]
        held, directory = None, ([], [], [])
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                for s in _reach(lasts, firsts, key):
                    if held != s:  # keys come in order, so a shard's directory is read once
                        with store.open_input_stream(f"{shared.value[s][2]}.directory", compression=None) as f:
                            blocks = _unpack(f.read()[8:])
                        held, directory = s, ([b[1] for b in blocks], [b[0] for b in blocks], blocks)
                    for b in _reach(directory[0], directory[1], key):
                        found.append((key, shared.value[s][2], directory[2][b][2], directory[2][b][3]))
            yield _batch(found, ["surt", "shard", "offset", "length"], [pa.string(), pa.string(), pa.int64(), pa.int64()])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _open(folder)
        held, lines, names, f, opened = None, [], [], None, None
        for batch in batches:
            found = []
            for key, shard, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if opened != shard:
                    f, opened = store.open_input_file(f"{shard}.blocks"), shard
                if held != (shard, offset):
                    lines = _unpack(f.read_at(length, offset))
                    held, names = (shard, offset), [x[0] for x in lines]
                found += [tuple(x) for x in lines[bisect.bisect_left(names, key):bisect.bisect_right(names, key)]]
            yield _batch(found, ["surt", "id", "file", "offset", "length"], [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()])

    ordered = keys.select("surt").filter(F.col("surt").isNotNull()).distinct().repartitionByRange("surt").sortWithinPartitions("surt")
    blocks = ordered.mapInArrow(locate, "surt string, shard string, offset long, length long")
    blocks = blocks.repartition(_reducers(keys.sparkSession), "shard", "offset").sortWithinPartitions("shard", "offset", "surt")
    return blocks.mapInArrow(search, _ENTRY)


def read_records(entries: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records that the entries name, by range reads in file order."""
    kinds = {"id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
             "record_type": pa.string(), "refers_to": pa.int64()} | ({"payload": pa.binary()} if with_payload else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _open(folder)
        f, opened, start, held = None, None, 0, b""
        for batch in batches:
            found, size = [], 0
            for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                if opened != name:
                    f, opened, start, held = store.open_input_file(name), name, 0, b""
                if not (start <= offset and offset + length <= start + len(held)):
                    start, held = offset, f.read_at(max(length, READ_AHEAD), offset)
                raw = zlib.decompress(memoryview(held)[offset - start: offset - start + length], 31)
                r = parse_record(raw)
                found.append(tuple(r[k] for k in kinds))
                size += len(raw)
                if with_payload and size > 32 << 20:
                    yield _batch(found, list(kinds), list(kinds.values()))
                    found, size = [], 0
            yield _batch(found, list(kinds), list(kinds.values()))

    types = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    ordered = entries.repartitionByRange(_reducers(entries.sparkSession), "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.select("file", "offset", "length").mapInArrow(run, ", ".join(f"{k} {types[t]}" for k, t in kinds.items()))


def lookup(urls: DataFrame, url_col: str, shards: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """All captures of the given urls, through the index."""
    keys = urls.select(surt(col(url_col)).alias("surt"))
    return read_records(find_entries(keys, shards, folder), folder, with_payload)


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages, build the index, and read every page's capture back through it."""
    pages = table(spark, sf_dir, "pages")
    folder = scratch(spark, "warc")
    captures = with_record_types(pages, "page_id", "url", F.col("html").cast("binary"))
    shards = build_index(write_archives(captures, f"{folder}/archives"), f"{folder}/index")
    return lookup(pages, "url", shards, folder).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


OP1_SQL = """
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to, url
FROM f
"""
