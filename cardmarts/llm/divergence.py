"""Source divergence audit: how far each source's use of words is from the other sources and from its language.

A translate-table tokenizer: ``bytes.translate`` lowers A-Z and blanks every
other ASCII byte in one pass, ``bytes.split`` cuts the terms (letters and all
bytes beyond ASCII), and a ``Counter`` per document gives its sparse counts.
Each task adds the documents' counts up per (language, source) before anything
is shuffled and hands them on whenever it holds ``entries`` of them, so neither
a common term nor a hot source reaches a task row by row. One shuffle by
(language, term) brings a term's sources together: at most one number for each
source of the language.

Each language keeps the terms that at least ``least_docs`` of its rows hold
(V of them). A group is a (language, source), a language stands for all its
groups. Smoothed shares are whole numbers,

    p = 1 + floor(10^9 (count + 1) / (N + V)),    N = sum of the group's counts

and the divergence of p from q is floor((p - q)^2 / q) term by term. For pairs
of sources it is summed over all kept terms, also those that neither holds.
Terms whose counts agree in every source are worked out once, times their
number; the rest is a matrix of blocks of terms by sources, in numpy integers.

Defined results: a null text, language or source counts as ''. A group without
kept terms has N = 0; a language without kept terms gives pairs of value 0 and
no terms; one with a single source gives no pairs. Repeated rows count each
time. Ties in value go to the smaller item in UTF-8. A very long text is cut
between terms into pieces, so memory does not grow with it. An empty table
gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardmarts.llm.common import byte_slices, col, materialize, table

UNIT = 1_000_000_000
PIECE = 1 << 22  # bytes of one text that are split at a time
BLOCK = 2_048  # distinct rows of counts worked on at a time
_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Letters in lower case, bytes beyond ASCII as they are, all others blank.
TABLE = bytes(b + 32 if b in _LETTERS else b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The text's terms in order, a bounded piece at a time."""
    clean, at = text.translate(TABLE), 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end + 1


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                entries: int = 400_000) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents per group, added up within tasks."""
    kind = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def drain(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, seen) in held.items():
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(n)), pa.repeat(source, len(n)), pa.array(n.keys(), pa.binary()), pa.array(n.values(), pa.int64()),
                     pa.array([seen[t] for t in n], pa.int64())], schema=kind)
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for part in byte_slices(batch, "text"):
                for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                    n, seen = held.setdefault((lang, source), (Counter(), Counter()))
                    before, own = len(n), Counter()
                    for piece in terms(text):
                        own.update(piece)
                    n.update(own)
                    seen.update(own.keys())
                    size += len(n) - before
                    if size >= entries:
                        yield from drain(held)
                        size = 0
        yield from drain(held)

    blank = lambda c: F.coalesce(col(c).cast("string"), F.lit(""))
    rows = docs.select(blank(lang_col).alias("lang"), blank(source_col).alias("source"), blank(text_col).cast("binary").alias("text"))
    counted = rows.mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return counted.withColumn("term", F.col("term").cast("string"))


def kept_terms(counts: DataFrame, least_docs: int = 3) -> DataFrame:
    """(lang, term, sources) of the kept terms; ``sources`` has a (source, n) for each source that holds the term.

    All three steps share the one shuffle by (lang, term).
    """
    near = counts.repartition("lang", "term")
    per_source = near.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    found = F.sum("docs").over(Window.partitionBy("lang", "term"))
    kept = per_source.withColumn("found", found).filter(F.col("found") >= least_docs)
    return kept.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("sources"))


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / total) digit by digit: exact in 64 bits for totals below 9 * 10^17."""
    rest = count + 1
    p = rest // total
    rest = rest % total
    for _ in range(9):
        rest = rest * 10
        p = p * 10 + rest // total
        rest = rest % total
    return p + 1


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, groups, v, rows) to (lang, source, item, value): one block's part of each pair's sum."""
    kind = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
    for batch in batches:
        for k in range(batch.num_rows):
            lang, v = batch.column("lang")[k].as_py(), batch.column("v")[k].as_py()
            groups, rows = batch.column("groups")[k].values, batch.column("rows")[k].values
            names, total = groups.field("source"), groups.field("total").to_numpy(zero_copy_only=False) + v
            lists, times = rows.field("sources"), rows.field("times").to_numpy(zero_copy_only=False)
            held = lists.flatten()
            at = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            count = np.zeros((len(lists), len(names)), np.int64)
            count[at, pc.index_in(held.field("source"), value_set=names).to_numpy(zero_copy_only=False)] = held.field("n").to_numpy(zero_copy_only=False)
            p = shares(count, total)
            for g in range(len(names)):
                gap = p[:, g, None] - p
                value = (gap * gap // p * times[:, None]).sum(axis=0)
                others = np.delete(np.arange(len(names)), g)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(others)), pa.repeat(names[g], len(others)), names.take(pa.array(others)), pa.array(value[others])], schema=kind)


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 3,
          top: int = 200, entries: int = 400_000) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank; see the module's text.

    ``top`` bounds the ranks of part ``term``; part ``pair`` is whole.
    """
    kept = materialize(kept_terms(term_counts(docs, lang_col, source_col, text_col, entries), least_docs), "kept-terms")
    blank = lambda c: F.coalesce(col(c).cast("string"), F.lit(""))
    found = docs.select(blank(lang_col).alias("lang"), blank(source_col).alias("source")).distinct()
    single = kept.select("lang", "term", F.explode("sources").alias("s")).select("lang", "term", F.col("s.source"), F.col("s.n"))
    totals = single.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    groups = found.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["total", "v"])
    groups = materialize(groups, "groups")  # a row per group

    # one row per language, with its groups: fewer than the rows of part `pair`
    langs = groups.groupBy("lang").agg(F.first("v").alias("v"), F.sum("total").alias("lang_total"),
                                       F.array_sort(F.collect_list(F.struct("source", "total"))).alias("groups"))
    langs = materialize(langs, "langs")
    alike = materialize(kept.groupBy("lang", "sources").agg(F.count("*").alias("times")), "alike")
    blocks = -(-max(1, alike.count()) // BLOCK)
    dealt = alike.withColumn("block", F.pmod(F.xxhash64("sources"), F.lit(blocks)))
    packed = dealt.groupBy("lang", "block").agg(F.collect_list(F.struct("sources", "times")).alias("rows"))
    sums = packed.join(langs, "lang").select("lang", "groups", "v", "rows").mapInArrow(
        _pair_sums, "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # every pair of a language's sources, whether or not it has kept terms
    each = langs.select("lang", F.explode("groups.source").alias("source"), F.col("groups.source").alias("all"))
    each = each.select("lang", "source", F.explode("all").alias("item")).filter("source <> item")
    pairs = each.join(sums, ["lang", "source", "item"], "left").na.fill(0, ["value"]).withColumn("part", F.lit("pair"))

    wide = "decimal(38,0)"
    share = lambda count, total: F.expr(f"1 + (cast({UNIT} as {wide}) * (cast({count} as decimal(20,0)) + 1)) div cast({total} + v as {wide})")
    whole = kept.select("lang", "term", F.explode("sources").alias("s"),
                        F.aggregate("sources", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("lang_n"))
    whole = whole.select("lang", "term", "lang_n", F.col("s.source").alias("source"), F.col("s.n").alias("n"))
    rated = whole.join(groups, ["lang", "source"]).join(langs.select("lang", "lang_total"), "lang")
    rated = rated.select("lang", "source", "term", share("n", "total").alias("p"), share("lang_n", "lang_total").alias("q")).filter("p > q")
    words = rated.select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"), F.lit("term").alias("part"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    words = words.withColumn("rank", rank).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).select(columns).unionByName(words.select(columns))


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the others of its language, and its 200 most telling terms."""
    return audit(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
t AS (SELECT k, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
dense AS (
  SELECT g.lang, g.source, kept.term, coalesce(n.n, 0)::HUGEINT AS n, sum(coalesce(n.n, 0)) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS total,
         sum(coalesce(n.n, 0)) OVER (PARTITION BY g.lang, kept.term)::HUGEINT AS lang_n, sum(coalesce(n.n, 0)) OVER (PARTITION BY g.lang)::HUGEINT AS lang_total
  FROM g JOIN kept USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term),
p AS (
  SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 1) // (total + v) AS p, 1 + 1000000000::HUGEINT * (lang_n + 1) // (lang_total + v) AS q
  FROM dense JOIN v USING (lang)),
pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
