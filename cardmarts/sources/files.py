"""Raw file sources: explicit-schema CSV and key/value JSON dictionaries.

CSV: the header line is skipped and columns are matched by position against
a fixed all-string schema; an empty field is null, a short row is padded
with nulls and extra fields are dropped. Nothing is inferred.

JSON dictionaries (``{"k": "v", ...}`` or ``{"target": {"k": "v", ...}}``) are
read in splits by ``read_json_dictionary``, so one large file keeps many tasks
busy. A first pass over the text summarises each split (``json_lexer``): what it
does to the reader's state, whether it starts inside a string or not. A scan over
these summaries, one small row per split, gives every split's true state; the
second pass cuts each split into whole members of the dictionary, and the
pieces of members that lie across splits are joined. ``from_json`` decodes the
members, many at a time, so escapes, numbers, nulls and nested values are read
as JSON has them. The rows are those of ``read_json_dictionary_whole``, which
parses each file in one task, for every legal file: strings may hold quote-commas,
members may stand beside, before and after the root, a byte-order mark is skipped.
Malformed text, a file that breaks off (also inside a string), a second document
in a file and a missing root fail the job with the file's name. Files of zero
bytes are left out, as Spark's scans leave them out.

Every reader takes all files matching ``file_glob`` (``*.json``) in the folder
and below, and fails when there is none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cardmarts.schemas import CSV_ENTITIES, STRING_MAP
from cardmarts.sources import json_lexer as L

SOURCE_FILE = "__source_file"
FAIL = {"mode": "FAILFAST", "allowSingleQuotes": "false"}


class SourceMissing(FileNotFoundError):
    """The landing folder or its files are not there."""


def read_csv_entity(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """A CSV entity with its fixed schema plus ``__source_file`` from the scan."""
    if entity not in CSV_ENTITIES:
        raise ValueError(f"not a CSV entity: {entity}")
    df = (
        spark.read.schema(CSV_ENTITIES[entity])
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def _json_text(spark: SparkSession, path: str, file_glob: str, **options) -> DataFrame:
    # text() resets wholetext to its own keyword default, so options go in as keywords
    df = spark.read.text(path, pathGlobFilter=file_glob, **options)
    if not df.inputFiles():
        raise SourceMissing(f"no {file_glob} file in {path}")
    return df


def _pairs(text: Column, root: str | None) -> Column:
    """The string map in a JSON object, or in its member ``root``; fails on other text."""
    schema = StructType([StructField(root, STRING_MAP)]) if root else STRING_MAP
    parsed = F.from_json(text, schema, FAIL)
    return _or_fail(parsed[root] if root else parsed, f"JSON dictionary without its member {root!r}")


def _or_fail(value: Column, reason: str) -> Column:
    return F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit(f"{reason} in "), F.col(SOURCE_FILE))))


def read_json_dictionary_whole(
    spark: SparkSession, path: str, key_col: str, value_col: str, root: str | None = None,
    file_glob: str = "*.json",
) -> DataFrame:
    """Rows ``(key_col, value_col, __source_file)``, each file parsed whole in one task.

    A repeated key gives one row per occurrence; malformed JSON fails the job.
    """

    def one_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, text in zip(*(batch.column(c).to_pylist() for c in (SOURCE_FILE, "value")), strict=True):
                summary, lines = L.Summary(root), text.encode().split(L.SEPARATOR)
                for part in L.chunks(lines, False):
                    summary.add(part)
                cutter = L.Cutter(file, L.compose(file, root, [(0, summary.pack())])[0][1], root)
                for part in L.chunks(lines, False):
                    for _ in cutter.add(part):
                        pass
            yield batch

    raw = _json_text(spark, path, file_glob, wholetext=True).select(
        F.regexp_replace("value", "^\ufeff", "").alias("value"), F.col("_metadata.file_path").alias(SOURCE_FILE))
    raw = raw.mapInArrow(one_document, raw.schema)  # the parser alone would not look behind the first document
    return raw.select(F.explode(_pairs(F.col("value"), root)).alias(key_col, value_col), SOURCE_FILE)


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, list[bytes], bool]]:
    """(values of ``columns``, lines, is this the split's last part) of consecutive lines that agree in ``columns``."""
    key, lines = None, []
    for batch in batches:
        marks = [batch.column(c).dictionary_encode() for c in columns]
        codes = np.stack([m.indices.to_numpy(zero_copy_only=False) for m in marks])
        cut = [0, *(np.flatnonzero((np.diff(codes, axis=1) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
        value = batch.column("value").cast(pa.binary())
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if a == b:
                continue
            own = tuple(m[a].as_py() for m in marks)
            if lines:
                yield key, lines, own != key
            key, lines = own, value.slice(a, b - a).to_pylist()
    if lines:
        yield key, lines, True


def read_json_dictionary(
    spark: SparkSession, path: str, key_col: str, value_col: str, root: str | None = None,
    file_glob: str = "*.json",
) -> DataFrame:
    """The rows of ``read_json_dictionary_whole``, read in parallel splits; see the module's text.

    The list of states is broadcast: a row of some hundred bytes for each split, as the scan itself lists them.
    """
    if root and L.SEPARATOR.decode() in root:
        raise ValueError("the root's name may not hold a quote-comma")

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = L.Summary(root)
        for (file, start), lines, ends in _runs(batches, ["file", "start"]):
            for part in L.chunks(lines, not ends):
                summary.add(part)
            if ends:
                yield pa.RecordBatch.from_pydict({"file": [file], "start": [start], "summary": [summary.pack()]})
                summary = L.Summary(root)

    def states(rows: pa.Table) -> pa.Table:
        file = rows.column("file")[0].as_py()
        done = L.compose(file, root, sorted(zip(*(rows.column(c).to_pylist() for c in ("start", "summary")), strict=True)))
        return pa.table({"file": [file] * len(done), "start": [s for s, _, _ in done], "state": [s for _, s, _ in done], "torn": [t for _, _, t in done]})

    def cut(torn: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cutter = None
            for (file, start, state), lines, ends in _runs(batches, ["file", "start", "state"]):
                if state is None:
                    raise L.BrokenJson(f"the splits of {file} have changed during the read")
                cutter = cutter or L.Cutter(file, state, root)
                found = [x for part in L.chunks(lines, not ends or cutter.more) for x in cutter.add(part)]
                if ends:
                    found += cutter.close()
                    cutter = None
                for kind, text in found:
                    if (kind != "whole") == torn:
                        yield pa.RecordBatch.from_pydict({"file": [file], "start": [start], "kind": [kind], "text": pa.array([text], pa.binary())})

        return run

    def joined(rows: pa.Table) -> pa.Table:
        members = L.stitch(list(zip(*(rows.column(c).to_pylist() for c in ("start", "kind", "text")), strict=True)))
        return pa.table({"file": pa.array(rows.column("file").to_pylist()[:1] * len(members), pa.string()), "text": pa.array(members, pa.binary())})

    raw = _json_text(spark, path, file_glob, lineSep=L.SEPARATOR.decode()).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    known = raw.mapInArrow(summaries, "file string, start long, summary string").groupBy("file").applyInArrow(
        states, "file string, start long, state string, torn boolean")
    piece = "file string, start long, kind string, text binary"
    whole = raw.join(F.broadcast(known.drop("torn")), ["file", "start"], "left").mapInArrow(cut(False), piece)
    # splits whose borders cut a member are few; mostly there are none, and this part reads nothing
    across = raw.join(F.broadcast(known.filter("torn").drop("torn")), ["file", "start"]).mapInArrow(cut(True), piece)
    across = across.groupBy("file").applyInArrow(joined, "file string, text binary")
    members = whole.select("file", "text").unionByName(across).select(
        F.concat(F.lit("{"), F.col("text").cast("string"), F.lit("}")).alias("text"), F.col("file").alias(SOURCE_FILE))
    return members.select(F.explode(_pairs(F.col("text"), None)).alias(key_col, value_col), SOURCE_FILE)
