"""SentencePiece encoding by suffix-array matching, and decoding.

The model is a given SentencePiece BPE model (``path``); nothing is trained.
Its pieces are read on the driver and broadcast: a fixed vocabulary.

A task takes a batch of texts, puts the dummy prefix on and cuts them where no
piece can reach across: in front of a run of spaces and around characters
without a piece. Units met before are remembered (a bounded memo); the text of
the others is concatenated and indexed by a suffix array, cut at the longest
piece's length. Every piece is binary-searched for its range of suffixes; the
ranges are the edges from a piece's start to its end. The edges are sorted by
position and relaxed from left to right: the prefix that ends at an edge's end
has this piece last exactly if the piece can follow the last piece of the
prefix that ends at the edge's start. A pair of pieces can follow each other
if merging their joint text gives the same two pieces; that is read off the
order of merges, backwards, and remembered. So one edge wins at each position
and the path back from the end is the BPE segmentation, the same ids as
merging would give.

Defined results: null and empty texts have no ids and decode to the empty
text. Characters without a piece become the pieces of their UTF-8 bytes.
U+2581 stands for a space, as the model has it, so it decodes to a space; all
other texts decode to themselves. Bytes that are not UTF-8 (ids that no text
gives) decode to U+FFFD. Repeated rows are each encoded, an empty table gives
an empty result. A very long text is worked on in parts that begin in front of
a run of spaces, so its length does not set the memory needed (a single longer
run without spaces does). Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmarts.llm.common import byte_slices, col, releasing, sha256_hex, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_SPACES = f" {SPACE}"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # kinds of pieces in a model file
CHARS = 1_000_000  # of text worked on at a time in a task
INDEXED = 400_000  # characters of new units in one suffix array
MEMO_UNITS = 300_000
PACK = 4  # characters in one sort key
_IDS = 100_000  # decoded at a time


@dataclass
class Pieces:
    """A model's pieces and what is derived from them; plain arrays, to be broadcast."""

    text: list[str]
    score: np.ndarray
    kind: np.ndarray
    left: np.ndarray = field(default=None)  # the two pieces that a piece's last merge joins, or -1
    right: np.ndarray = field(default=None)
    reachable: np.ndarray = field(default=None)
    pair_key: np.ndarray = field(default=None)  # left * size + right of every pair whose joint text is a piece
    pair_score: np.ndarray = field(default=None)


def merged(units: list[str], score: dict[str, float]) -> tuple[list[str], list[tuple[str, str]]]:
    """Plain BPE: best score first, then leftmost. Also the joined pairs, in order. For short strings."""
    units, joined = list(units), []
    while True:
        best, at = None, -1
        for i in range(len(units) - 1):
            s = score.get(units[i] + units[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        if best is None:
            return units, joined
        joined.append((units[at], units[at + 1]))
        units[at:at + 2] = [units[at] + units[at + 1]]


def load_pieces(path: str = MODEL) -> Pieces:
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm = model.normalizer_spec
    if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
        raise ValueError("only BPE models with the identity normaliser and a dummy prefix are read")
    p = Pieces([x.piece for x in model.pieces], np.array([x.score for x in model.pieces]), np.array([x.type for x in model.pieces]))
    ids = {t: i for i, t in enumerate(p.text) if p.kind[i] == NORMAL}
    if any(re.search(f"[^{SPACE}]{SPACE}", t) for t in ids):
        raise ValueError("a piece reaches across a space")
    score = {t: float(p.score[i]) for t, i in ids.items()}
    n = len(p.text)
    p.left, p.right, p.reachable = np.full(n, -1), np.full(n, -1), np.zeros(n, bool)
    keys, scores = [], []
    for t, i in ids.items():
        units, joined = merged(list(t), score)
        p.reachable[i] = len(units) == 1
        if joined and len(units) == 1:
            p.left[i], p.right[i] = ids[joined[-1][0]], ids[joined[-1][1]]
        for cut in range(1, len(t)):
            a, b = ids.get(t[:cut]), ids.get(t[cut:])
            if a is not None and b is not None:
                keys.append(a * n + b)
                scores.append(score[t])
    order = np.argsort(keys)
    p.pair_key, p.pair_score = np.array(keys, np.int64)[order], np.array(scores)[order]
    return p


def can_follow(p: Pieces, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Does merging the joint text of pieces a and b give just a and b?

    Backwards in time: the piece whose last merge came later is undone, and
    before that merge no pair across the border may have been better. Of equal
    scores the leftmost merge comes first.
    """
    n = len(p.text)
    a, b = a.copy(), b.copy()
    ok = np.ones(len(a), bool)
    limit = np.full(len(a), -np.inf)  # score of the merge that ended the present state
    strict = np.zeros(len(a), bool)  # must a pair across the border beat it, not just equal it?
    on = np.arange(len(a))
    while len(on):
        x, y = a[on], b[on]
        key = x * n + y
        at = np.minimum(np.searchsorted(p.pair_key, key), len(p.pair_key) - 1)
        s = np.where(p.pair_key[at] == key, p.pair_score[at], np.nan)
        lost = np.where(strict[on], s > limit[on], s >= limit[on])
        ok[on[lost]] = False
        sx = np.where(p.left[x] >= 0, p.score[x], np.inf)  # a single character was there from the start
        sy = np.where(p.left[y] >= 0, p.score[y], np.inf)
        go = ~lost & (np.minimum(sx, sy) < np.inf)
        on, x, y, sx, sy = on[go], x[go], y[go], sx[go], sy[go]
        undo_left = sx < sy  # of equal scores the left merge came first, so the right one is undone first
        limit[on] = np.where(undo_left, sx, sy)
        strict[on] = undo_left  # a's own merge lies left of the border pair and wins ties
        a[on] = np.where(undo_left, p.right[x], x)
        b[on] = np.where(undo_left, y, p.left[y])
    return ok


class _PairMemo:
    """Open-addressing table from pair keys to verdicts, on arrays."""

    def __init__(self, pieces: Pieces, bits: int = 20):
        self.p, self.used = pieces, 0
        self._clear(bits)

    def _clear(self, bits: int) -> None:
        self.mask, self.key, self.value = (1 << bits) - 1, np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, bool)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((h ^ (h >> np.uint64(29))) & np.uint64(self.mask)).astype(np.int64)

    def _insert(self, key: np.ndarray, value: np.ndarray) -> None:
        slot = self._slot(key)
        left = np.arange(len(key))
        while len(left):
            s = slot[left]
            free = self.key[s] == -1
            self.key[s[free]] = key[left[free]]  # of several that meet here the last one stays
            got = self.key[s] == key[left]
            self.value[s[got]] = value[left[got]]
            left = left[~got]
            slot[left] = (slot[left] + 1) & self.mask
        self.used += len(key)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * len(self.p.text) + b
        out, slot = np.zeros(len(key), bool), self._slot(key)
        left, missing = np.arange(len(key)), []
        while len(left):
            s = slot[left]
            there = self.key[s]
            hit = there == key[left]
            out[left[hit]] = self.value[s[hit]]
            empty = there == -1
            missing.append(left[empty])
            left = left[~hit & ~empty]
            slot[left] = (slot[left] + 1) & self.mask
        miss = np.concatenate(missing) if missing else left
        if len(miss):
            new, back = np.unique(key[miss], return_inverse=True)
            value = can_follow(self.p, new // len(self.p.text), new % len(self.p.text))
            out[miss] = value[back]
            if self.used + len(new) > len(self.key) // 2:
                old = self.key >= 0
                k, v = self.key[old], self.value[old]
                bits = int(self.mask).bit_length() + 1
                if bits > 23:  # bounded: start anew
                    k, v, bits = k[:0], v[:0], 20
                self._clear(max(bits, (2 * (len(k) + len(new))).bit_length() + 1))
                self.used = 0
                self._insert(k, v)
            self._insert(new, value)
        return out


class Encoder:
    def __init__(self, pieces: Pieces):
        self.p = pieces
        normal = [i for i in range(len(pieces.text)) if pieces.reachable[i]]
        alphabet = sorted({c for i in normal for c in pieces.text[i]})
        self.code = np.zeros(0x110000, np.uint64)
        for k, c in enumerate(alphabet):
            self.code[ord(c)] = k + 1
        known = "".join(re.escape(c) for c in alphabet if c != SPACE)
        self.cut = re.compile(f"{SPACE}+[{known}]*|[{known}]+|[^{known}{SPACE}]", re.S)
        self.known = set(alphabet)
        self.bytes = {pieces.text[i]: i for i in range(len(pieces.text)) if pieces.kind[i] == BYTE}
        self.length = max(len(pieces.text[i]) for i in normal)
        self.keys = -(-self.length // PACK)
        self.ids = np.array(normal, np.int64)
        self.sizes = np.array([len(pieces.text[i]) for i in normal], np.int32)
        packed = np.zeros((len(normal), self.keys * PACK), np.uint64)
        for r, i in enumerate(normal):
            packed[r, : len(pieces.text[i])] = [self.code[ord(c)] for c in pieces.text[i]]
        fill = np.arange(self.keys * PACK)[None, :] >= self.sizes[:, None]
        self.low = self._pack_rows(packed)
        self.high = self._pack_rows(np.where(fill, np.uint64(0xFFFF), packed))
        self.pairs = _PairMemo(pieces)
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.tokens, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    @staticmethod
    def _pack_rows(x: np.ndarray) -> list[np.ndarray]:
        x = x.reshape(len(x), -1, PACK)
        return [sum(x[:, k, j] << np.uint64(16 * (PACK - 1 - j)) for j in range(PACK)) for k in range(x.shape[1])]

    def _bound(self, keys: list[np.ndarray], wanted: list[np.ndarray], right: bool) -> np.ndarray:
        """Binary search of many packed strings among sorted packed suffixes."""
        lo, hi = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(keys[0]), np.int64)
        while True:
            on = lo < hi
            if not on.any():
                return lo
            mid = np.where(on, (lo + hi) >> 1, 0)
            less, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
            for k, w in zip(keys, wanted, strict=True):
                x = k[mid]
                less |= same & (x < w)
                same &= x == w
            if right:
                less |= same
            lo = np.where(on & less, mid + 1, lo)
            hi = np.where(on & ~less, mid, hi)

    def _segment(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units of known characters, and each unit's end among them."""
        joined = "\0".join(units) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        c = self.code[points]
        n = len(c)
        padded = np.concatenate([c, np.zeros(self.keys * PACK, np.uint64)])
        four = sum(padded[j: n + (self.keys - 1) * PACK + j] << np.uint64(16 * (PACK - 1 - j)) for j in range(PACK))
        keys = [four[k * PACK: k * PACK + n] for k in range(self.keys)]
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        del c, four, padded, points
        lo, hi = self._bound(keys, self.low, False), self._bound(keys, self.high, True)
        # one edge for every suffix in a piece's range
        del keys
        count = hi - lo
        piece = np.repeat(np.arange(len(count), dtype=np.int32), count)
        start = order[np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count) + lo[piece]].astype(np.int32)
        del order
        stop = start + self.sizes[piece]
        sizes = np.array([len(u) for u in units], np.int32)
        begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int32)
        unit_of = np.repeat(np.arange(len(units), dtype=np.int32), sizes + 1)
        depth = stop - begin[unit_of[start]]
        by = np.argsort(depth.astype(np.uint16) if depth.max(initial=0) < 65536 else depth, kind="stable")
        start, stop, piece, depth = start[by], stop[by], self.ids[piece[by]], depth[by]
        del by, unit_of
        # relax: last[x] is the last piece of the text up to x, back[x] where it starts
        last, back = np.full(n, -2, np.int64), np.zeros(n, np.int64)
        last[begin] = -1
        cuts = np.flatnonzero(np.diff(depth, prepend=-1))
        for x, y in zip(cuts, np.append(cuts[1:], len(depth)), strict=True):
            s, e, i = start[x:y], stop[x:y], piece[x:y]
            prev = last[s]
            ok = prev == -1
            mid = np.flatnonzero(prev >= 0)
            ok[mid] = self.pairs.get(prev[mid], i[mid])
            last[e[ok]] = i[ok]
            back[e[ok]] = s[ok]
        # walk all units back from their ends at once
        at = begin + sizes
        unit = np.arange(len(units))
        steps = []
        while len(at):
            steps.append((unit, last[at]))
            at = back[at]
            more = last[at] >= 0
            at, unit = at[more], unit[more]
        who = np.concatenate([u for u, _ in steps[::-1]])
        what = np.concatenate([w for _, w in steps[::-1]])
        by = np.argsort(who, kind="stable")
        return what[by].astype(np.int32), np.cumsum(np.bincount(who, minlength=len(units)))

    def _learn(self, units: list[str]) -> None:
        """Put units into the memo."""
        plain = [u for u in units if u[0] in self.known]
        odd = [u for u in units if u[0] not in self.known]
        tokens, ends = [self.tokens], [self.ends]
        total = len(self.tokens)
        if plain:
            t, e = self._segment(plain)
            tokens.append(t)
            ends.append(e + total)
            total += len(t)
        if odd:
            raw = [[self.bytes[f"<0x{b:02X}>"] for b in u.encode("utf-8", "surrogatepass")] for u in odd]
            t = np.array([b for r in raw for b in r], np.int32)
            tokens.append(t)
            ends.append(np.cumsum([len(r) for r in raw]) + total)
        for u in plain + odd:
            self.memo[u] = len(self.memo)
        self.tokens, self.ends = np.concatenate(tokens), np.concatenate(ends)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the end of each text among them."""
        ids, sizes = [np.empty(0, np.int32)], np.zeros(len(texts), np.int64)
        for group in text_groups(texts):
            flat, count = self._encode([x for _, x in group])
            ids.append(flat)
            np.add.at(sizes, [k for k, _ in group], count)
        return np.concatenate(ids), np.cumsum(sizes)

    def _encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of parts of texts that begin at unit borders, and their number in each part."""
        if len(self.memo) > MEMO_UNITS:
            self._forget()
        units, counts = [], []
        for t in parts:
            mine = self.cut.findall(t)
            units += mine
            counts.append(len(mine))
        new, size = [], 0
        for u in dict.fromkeys(units):
            if u not in self.memo:
                new.append(u)
                size += len(u)
                if size >= INDEXED:
                    self._learn(new)
                    new, size = [], 0
        if new:
            self._learn(new)
        memo = self.memo
        seq = np.fromiter((memo[u] for u in units), np.int64, len(units))
        del units
        first, size = self.ends[seq], self.ends[seq + 1] - self.ends[seq]
        stops = np.cumsum(size)
        flat = self.tokens[np.arange(int(size.sum())) + np.repeat(first - (stops - size), size)]
        return flat, np.diff(np.concatenate([[0], stops])[np.cumsum([0, *counts])])


def text_groups(texts: list[str | None], size: int = CHARS) -> Iterator[list[tuple[int, str]]]:
    """(text's place, part) of all texts with spaces as the model has them, in groups of about ``size`` characters.

    A longer text is cut in front of a run of spaces, where a unit begins.
    """
    group, total = [], 0
    for k, t in enumerate(texts):
        at = 0
        while t and at < len(t):
            end = at + size
            while end < len(t) and not (t[end] in _SPACES and t[end - 1] not in _SPACES):
                end += 1
            part = t[at:end].replace(" ", SPACE)
            group.append((k, part if at else SPACE + part))
            total += len(part)
            at = end
            if total >= size:
                yield group
                group, total = [], 0
    if group:
        yield group


class Decoder:
    def __init__(self, pieces: Pieces):
        self.raw = []
        for t, kind in zip(pieces.text, pieces.kind, strict=True):
            if kind == BYTE:
                self.raw.append(bytes([int(t[3:5], 16)]))
            elif kind == CONTROL:
                self.raw.append(b"")
            elif kind == UNKNOWN:
                self.raw.append(" ⁇ ".encode())
            else:
                self.raw.append(t.replace(SPACE, " ").encode())

    def decode(self, ids) -> str:
        raw, ids = self.raw, np.asarray(ids, np.int64)
        blocks = [b"".join([raw[i] for i in ids[k:k + _IDS].tolist()]) for k in range(0, len(ids), _IDS)]
        return b"".join(blocks).decode("utf-8", "replace").removeprefix(" ")


def encode_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL,
                 decoded: bool = False) -> DataFrame:
    """(id, ids) of every row; ``decoded`` adds the text that the ids decode to, in the same pass."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = decoder = None
        for batch in batches:
            encoder, decoder = encoder or Encoder(shared.value), decoder or Decoder(shared.value)
            for rows in byte_slices(batch, "text", CHARS):
                flat, ends = encoder.encode(rows.column("text").to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
                out = [rows.column("id"), lists]
                if decoded:
                    starts = np.concatenate([[0], ends[:-1]])
                    out.append(pa.array([decoder.decode(flat[x:y]) for x, y in zip(starts, ends, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=["id", "ids", "decoded"][: len(out)])

    rows = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(releasing(run), "id long, ids array<int>" + ", decoded string" * decoded)


def decode_table(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded`` (id, ids) plus the decoded text."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = None
        for batch in batches:
            decoder = decoder or Decoder(shared.value)
            lists = batch.column(1)
            for a in range(0, batch.num_rows, 256):  # a few texts at a time
                part = lists.slice(a, 256)
                offsets, flat = part.offsets.to_numpy(), part.values.to_numpy()
                texts = [decoder.decode(flat[x:y]) for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, 256), part, pa.array(texts, pa.string())],
                                                 names=["id", "ids", "decoded"])

    return encoded.select("id", "ids").mapInArrow(releasing(run), "id long, ids array<int>, decoded string")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, their number, and the digest of the text that they decode to."""
    rows = encode_table(table(spark, sf_dir, "documents"), decoded=True)
    return rows.select(F.col("id").alias("doc_id"), "ids", F.size("ids").cast("long").alias("n_ids"),
                       sha256_hex(F.col("decoded")).alias("decoded_sha256"))
