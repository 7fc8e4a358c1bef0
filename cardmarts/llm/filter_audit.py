"""Filter interaction audit: what every order of five filters removes, and what each filter is worth.

A table-driven byte transducer reads the UTF-8 bytes of a text once. Its class
table tells blanks, capitals, the symbols looked for, other ASCII, lead and
continuation bytes; its state is inside or outside a word; the action table
gives for each state and class whether the byte starts or ends a word, begins a
code point, and is a capital or a symbol. A task runs it over the joined texts
of a bounded slice at a time (numpy lookups), the blank between two texts
bringing it back to its first state. The word spans go into a hash table with
open addressing, keyed by document and hash; a span is taken for a word met
before only after its bytes have been compared, so a collision moves on to the
next slot and never hides a word.

The filters' failures are bits of a mask: A too few words, B too few distinct
words, C too many capitals, D a symbol (``Limits``), E a text identical to that
of a row with a smaller id, table-wide. E is settled on digests: the rows of a
text are counted per group before they are shuffled, and meet as one row per
group with its smallest id, so a text that a third of all rows hold costs no
more than any other. What is then left of the table is a count per part, mask
and label (at most 128 for each part); the 120 orders and their steps are
sums over those counts.

Defined results: a null text is empty, a null part is ''. Empty texts fail A
only. A row with a null id fails E never and makes no other row fail it; rows
that share the smallest id of a text all pass E. Labels: a row counts as good
or toxic if any of its id's labels says 1; null ids have none. Repeated rows
count each time. An empty table gives an empty result. A text longer than
``PIECE`` bytes is read in pieces cut at blanks, its words united over the
pieces; a longer run without blanks is one word. Other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.llm.common import byte_slices, col, materialize, table
from cardmarts.llm.prob_minhash import mix64

PIECE = 1 << 21  # bytes worked on at a time
BLANK, PLAIN, CAPITAL, SYMBOL, LEAD, REST = range(6)
START, END, POINT, IS_CAPITAL, IS_SYMBOL = 1, 2, 4, 8, 16
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


@dataclass(frozen=True)
class Limits:
    """Failure conditions of the filters A to D."""

    words: int = 100  # A: fewer words
    distinct_percent: int = 80  # B: a smaller share of distinct words
    capital_percent: int = 10  # C: a larger share of A-Z among the code points
    symbols: str = "#$%&*|"  # D: any of them (ASCII)


def class_table(symbols: str) -> np.ndarray:
    kinds = np.full(256, PLAIN, np.uint8)
    kinds[[0x20, *range(0x09, 0x0E)]] = BLANK
    kinds[ord("A"):ord("Z") + 1] = CAPITAL
    kinds[list(symbols.encode("ascii"))] = SYMBOL
    kinds[0x80:0xC0], kinds[0xC0:] = REST, LEAD
    return kinds


def action_table() -> np.ndarray:
    """Actions by state (0 outside a word, 1 inside) and class; the next state is 1 but for a blank."""
    out = np.zeros((2, 6), np.uint8)
    out[:, :] = POINT
    out[:, REST] = 0
    out[:, CAPITAL] |= IS_CAPITAL
    out[:, SYMBOL] |= IS_SYMBOL
    out[0, PLAIN:] |= START
    out[1, BLANK] |= END
    return out


ACTIONS = action_table()


def _eight(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each place on, as one number; ``data`` is padded by eight."""
    word = np.zeros(len(at), np.uint64)
    for k in range(8):
        word |= np.where(left > k, data[at + k], 0).astype(np.uint64) << np.uint64(8 * k)
    return word


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Do the spans of equal length that start at ``a`` and ``b`` hold the same bytes?"""
    same = np.ones(len(a), bool)
    on = np.arange(len(a))
    for k in range(0, 64, 8):
        on = on[(length[on] > k) & same[on]]
        if not len(on):
            return same
        left = length[on] - k
        same[on] = _eight(data, a[on] + k, left) == _eight(data, b[on] + k, left)
    for i in on[(length[on] > 64) & same[on]]:
        same[i] = data[a[i]:a[i] + length[i]].tobytes() == data[b[i]:b[i] + length[i]].tobytes()
    return same


def first_spans(data: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Is a span the first of its document with these bytes? By a verified hash table."""
    slots = 1 << max(4, int(2 * len(start)).bit_length())
    owner = np.full(slots, -1, np.int64)
    slot = (mix64(hashed ^ mix64(doc.astype(np.uint64) + np.uint64(1))) & np.uint64(slots - 1)).astype(np.int64)
    first, on = np.zeros(len(start), bool), np.arange(len(start))
    while len(on):
        at = slot[on]
        free = on[owner[at] < 0][::-1]
        owner[slot[free]] = free  # of several, the earliest is written last
        held = owner[at]
        first[on[held == on]] = True
        maybe = (hashed[held] == hashed[on]) & (doc[held] == doc[on]) & (length[held] == length[on])
        met = np.zeros(len(on), bool)
        met[maybe] = same_bytes(data, start[held[maybe]], start[on[maybe]], length[on[maybe]])
        on = on[~met]
        slot[on] = (slot[on] + 1) & (slots - 1)
    return first


@dataclass
class Counts:
    """Per text: words, distinct words, capitals, code points and symbols."""

    words: np.ndarray
    distinct: np.ndarray
    capitals: np.ndarray
    points: np.ndarray
    symbols: np.ndarray


class Transducer:
    def __init__(self, symbols: str = Limits.symbols):
        self.kinds = class_table(symbols)
        self._power = self._back = np.ones(0, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._power) < n:
            for name, base in (("_power", _ODD), ("_back", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self._power[:n], self._back[:n]

    def read(self, texts: list[bytes]) -> tuple[Counts, np.ndarray, np.ndarray, np.ndarray]:
        """Counts per text, and the spans (document, start, end) of first words in the joined texts."""
        joined = b" ".join(texts) + b" "
        data = np.frombuffer(joined + bytes(8), np.uint8)
        n, docs = len(joined), len(texts)
        starts = np.zeros(docs, np.int64)
        starts[1:] = np.cumsum([len(t) + 1 for t in texts[:-1]])
        kinds = self.kinds[data[:n]]
        state = np.zeros(n, np.uint8)
        state[1:] = kinds[:-1] != BLANK
        act = ACTIONS[state, kinds]
        total = lambda bit: np.add.reduceat((act & bit) != 0, starts, dtype=np.int64)
        begin, end = np.flatnonzero(act & START), np.flatnonzero(act & END)
        doc = np.searchsorted(starts, begin, side="right") - 1
        power, back = self._powers(n)
        mass = np.zeros(n + 1, np.uint64)
        np.cumsum((data[:n].astype(np.uint64) + np.uint64(1)) * power, out=mass[1:])
        hashed = mix64((mass[end] - mass[begin]) * back[begin])
        first = first_spans(data, doc, begin, end - begin, hashed)
        doc, begin, end = doc[first], begin[first], end[first]
        counts = Counts(total(START), np.bincount(doc, minlength=docs), total(IS_CAPITAL), total(POINT) - 1, total(IS_SYMBOL))
        return counts, doc, begin, end

    def count(self, texts: list[bytes]) -> Counts:
        """Counts of all texts; one longer than ``PIECE`` is read by itself, in pieces."""
        short = [t if len(t) <= PIECE else b"" for t in texts]
        out = self.read(short)[0] if texts else Counts(*[np.zeros(0, np.int64)] * 5)
        for k, text in enumerate(texts):
            if len(text) > PIECE:
                self._long(text, k, out)
        return out

    def _long(self, text: bytes, k: int, out: Counts) -> None:
        at, words = 0, set()
        for name in ("words", "distinct", "capitals", "points", "symbols"):
            getattr(out, name)[k] = 0
        while at < len(text):
            end = at + PIECE
            while end < len(text) and self.kinds[text[end]] != BLANK:  # the cut falls on a blank
                end += 1
            piece = text[at:end]
            got, _, begins, ends = self.read([piece])
            words.update(piece[a:b] for a, b in zip(begins, ends, strict=True))
            for name in ("words", "capitals", "points", "symbols"):
                getattr(out, name)[k] += getattr(got, name)[0]
            at = end
        out.distinct[k] = len(words)


def document_counts(docs: DataFrame, id_col: str = "doc_id", part_col: str = "lang", text_col: str = "text",
                    symbols: str = Limits.symbols) -> DataFrame:
    """id, part, digest and the transducer's counts of every whole text."""
    names = ["words", "distinct", "capitals", "points", "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Transducer(symbols)
        for batch in batches:
            for rows in byte_slices(batch, "text", PIECE):
                got = reader.count(rows.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in ("id", "part", "digest")), *(pa.array(getattr(got, n)) for n in names)],
                    names=["id", "part", "digest", *names])

    text = F.coalesce(col(text_col), F.lit("")).cast("binary")
    rows = docs.select(col(id_col).cast("long").alias("id"), F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    return rows.mapInArrow(run, "id long, part string, digest binary, " + ", ".join(f"{n} long" for n in names))


def failure_cells(counts: DataFrame, labels: DataFrame, limits: Limits | None = None, id_col: str = "doc_id",
                  good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """(part, mask, good, toxic, n): the table's rows by what they fail (bit k for filter k) and their labels."""
    at = limits or Limits()
    tests = [F.col("words") < at.words, F.col("distinct") * 100 < F.col("words") * at.distinct_percent,
             F.col("capitals") * 100 > F.col("points") * at.capital_percent, F.col("symbols") > 0]
    mask = sum((t.cast("int") * (1 << k) for k, t in enumerate(tests)), F.lit(0))
    rows = counts.select("id", "part", "digest", mask.alias("mask")).groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    one = lambda c: F.coalesce(F.max(col(c) == 1), F.lit(False))
    marks = labels.filter(col(id_col).isNotNull()).groupBy(col(id_col).cast("long").alias("mark")).agg(
        one(good_col).alias("good"), one(toxic_col).alias("toxic")).filter("good OR toxic")
    named = rows.filter("id IS NOT NULL").join(marks, F.col("id") == F.col("mark"), "left").drop("mark").na.fill(False, ["good", "toxic"])
    nameless = rows.filter("id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    # one row for each text, part and label, with its smallest id and the rows that have it
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    texts = named.unionByName(nameless).groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), least.alias("least"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("free"))
    # at most a row per part and label for each text
    groups = F.collect_list(F.struct("part", "mask", "good", "toxic", "n", "least", "free"))
    whole = texts.groupBy("digest").agg(groups.alias("groups"), F.min("least.id").alias("first"))
    each = whole.select("first", F.explode("groups").alias("g")).select("first", "g.*")
    passed = F.col("free") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = each.withColumn("side", F.explode(F.array(
        F.struct(F.col("mask"), passed.alias("rows")),
        F.struct((F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - passed).alias("rows")))))
    return split.select("part", F.col("side.mask").alias("mask"), "good", "toxic", F.col("side.rows").alias("n")).filter("n > 0").groupBy(
        "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def interactions(cells: DataFrame) -> DataFrame:
    """One row per part, filter_order and step; see ``audit``."""
    bit = "shiftleft(1, instr('ABCDE', {0}) - 1)"
    step = cells.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS)))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    step = step.withColumn("own", F.expr(bit.format("substring(filter_order, step, 1)"))).withColumn(
        "before", F.expr(f"aggregate(sequence(1, step), 0, (a, k) -> a | if(k < step, {bit.format('substring(filter_order, k, 1)')}, 0))"))
    fails, early = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    only = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0)).cast("long")
    # a row that fails k filters is removed by each of them in 120 / k orders
    shapley = F.sum(F.when(fails, F.expr(f"n * {len(ORDERS)} div bit_count(mask)")).otherwise(0)).cast("long")
    return step.groupBy("part", "filter_order", "step").agg(
        only(~fails & ~early).alias("kept"), only(fails & ~early).alias("removed"), only(fails & early).alias("redundant"),
        only(F.col("mask") == F.col("own")).alias("unique_fails"), only(fails & ~early & F.col("good")).alias("good_lost"),
        only(fails & ~early & F.col("toxic")).alias("toxic_lost"), shapley.alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, limits: Limits | None = None, id_col: str = "doc_id", part_col: str = "lang",
          text_col: str = "text", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """part, filter_order, step and, of the part's documents: kept after the step, removed at it, redundant (failing its
    filter, removed earlier), unique_fails (failing its filter only), good_lost, toxic_lost and shapley (removed by its
    filter, summed over all orders)."""
    limits = limits or Limits()
    counts = materialize(document_counts(docs, id_col, part_col, text_col, limits.symbols), "transduced")
    cells = materialize(failure_cells(counts, labels, limits, id_col, good_col, toxic_col), "cells")
    return interactions(cells)


def op13_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all orders, per language."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
f AS (
  SELECT k, doc_id, part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
         100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE) AS e
  FROM w),
l AS (SELECT doc_id, coalesce(max(quality = 1), FALSE) AS good, coalesce(max(toxic = 1), FALSE) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic
  FROM f LEFT JOIN l USING (doc_id)),
cells AS (SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT p.c || q.c || r.c || s.c || u.c AS filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
  FROM x p, x q, x r, x s, x u
  WHERE p.bit + q.bit + r.bit + s.bit + u.bit = 31 AND p.bit | q.bit | r.bit | s.bit | u.bit = 31),
s AS (
  SELECT filter_order, step::INTEGER AS step, bits[step] AS own, coalesce(list_sum(bits[:step - 1]), 0)::INT AS before
  FROM o, range(1, 6) g(step)),
r AS (
  SELECT part, filter_order, step, own,
         sum(n) FILTER (mask & (own | before) = 0) AS kept, sum(n) FILTER (mask & own <> 0 AND mask & before = 0) AS removed,
         sum(n) FILTER (mask & own <> 0 AND mask & before <> 0) AS redundant, sum(n) FILTER (mask = own) AS unique_fails,
         sum(n) FILTER (mask & own <> 0 AND mask & before = 0 AND good) AS good_lost,
         sum(n) FILTER (mask & own <> 0 AND mask & before = 0 AND toxic) AS toxic_lost
  FROM cells, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM r
"""
