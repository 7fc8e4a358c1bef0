import os
import random

import numpy as np
import pytest
from helpers import awkward, empty, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from cardmarts.llm import sentencepieces as S

pytestmark = pytest.mark.skipif(not os.path.exists(S.MODEL), reason="no tokenizer files")


@pytest.fixture(scope="module")
def parts():
    import sentencepiece

    pieces = S.load_pieces()
    return pieces, S.Encoder(pieces), S.Decoder(pieces), sentencepiece.SentencePieceProcessor(model_file=S.MODEL)


def agree(parts, texts):
    _, encoder, decoder, library = parts
    flat, ends = encoder.encode(texts)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else []
    for t, a, b in zip(texts, starts, ends, strict=True):
        ids = flat[a:b].tolist()
        assert ids == library.encode(t or ""), repr(t)
        assert decoder.decode(ids) == (t or "").replace(S.SPACE, " ")


def test_same_ids_as_merging(parts):
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(0, 300)) for _ in range(200)]
    texts += ["".join(rng.choice("ab the  in   é𝄞\n\t▁ 0123.,!ße日本\0") for _ in range(rng.randint(0, 70))) for _ in range(1500)]
    texts += [" " * k + "x" * j for k in range(40) for j in (0, 1, 30)]
    texts += [None, "", " ", "the" * 5000, "a" * 70_000, "𝄞" * 300]
    agree(parts, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=50), max_size=6))
def test_any_text(parts, texts):
    agree(parts, [t.encode("utf-8", "ignore").decode() for t in texts])


def test_memo_is_bounded(parts, monkeypatch):
    monkeypatch.setattr(S, "MEMO_UNITS", 50)
    encoder = S.Encoder(parts[0])
    rng = random.Random(4)
    for _ in range(5):
        agree((parts[0], encoder, parts[2], parts[3]), [prose(rng, 200)])
    assert len(encoder.memo) < 300


def test_pair_rule_is_that_of_merging(parts):
    pieces = parts[0]
    score = {t: float(pieces.score[i]) for i, t in enumerate(pieces.text) if pieces.kind[i] == S.NORMAL}
    rng = random.Random(5)
    ok = np.flatnonzero(pieces.reachable)
    pairs = [(int(rng.choice(ok[:2000])), int(rng.choice(ok[:4000]))) for _ in range(800)]
    got = S.can_follow(pieces, np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    for (a, b), g in zip(pairs, got, strict=True):
        assert g == (S.merged(list(pieces.text[a] + pieces.text[b]), score)[0] == [pieces.text[a], pieces.text[b]])


def test_table_round_trip(spark):
    docs = awkward(spark)
    rows = S.decode_table(S.encode_table(docs)).collect()
    assert sorted((r["id"] or -1, r["decoded"]) for r in rows) == sorted((r["doc_id"] or -1, r["text"] or "") for r in docs.collect())
    assert S.decode_table(S.encode_table(empty(spark))).count() == 0
    once = {(r["id"], tuple(r["ids"]), r["decoded"]) for r in S.encode_table(docs, decoded=True).collect()}
    assert once == {(r["id"], tuple(r["ids"]), r["decoded"]) for r in rows}


def test_ids_that_no_text_gives(parts):
    _, _, decoder, library = parts
    assert decoder.decode([0, 1, 2, 264]).strip() == library.decode([0, 1, 2, 264]).strip()
    assert "�" in decoder.decode([233, 243])


def test_memory_does_not_grow_with_a_text(parts, monkeypatch):
    import tracemalloc

    rng = random.Random(3)
    peaks = []
    for chars in (300_000, 1_500_000):
        text = " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(chars // 7))
        encoder = S.Encoder(parts.p if hasattr(parts, "p") else S.load_pieces())
        monkeypatch.setattr(S, "CHARS", 100_000)
        tracemalloc.start()
        flat, ends = encoder.encode([text])
        peaks.append(tracemalloc.get_traced_memory()[1] - flat.nbytes * 2)
        tracemalloc.stop()
        assert ends.tolist() == [len(flat)] and S.Decoder(encoder.p).decode(flat) == text
    assert peaks[1] < 2 * peaks[0], peaks


def test_parts_give_the_ids_of_the_whole(monkeypatch):
    rng = random.Random(4)
    encoder = S.Encoder(S.load_pieces())
    texts = ["".join(rng.choice(["a", "the", " ", "  ", "é", "漢", "\n", "▁", "x" * 9]) for _ in range(200)) for _ in range(20)] + ["", None, " "]
    whole = encoder.encode(texts)
    for size in (1, 17, 300):
        monkeypatch.setattr(S, "text_groups", lambda t, size=size, groups=S_GROUPS: groups(t, size))
        again = S.Encoder(encoder.p).encode(texts)
        assert (whole[0] == again[0]).all() and (whole[1] == again[1]).all()


S_GROUPS = S.text_groups
