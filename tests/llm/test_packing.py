"""The cached tokenizer gives the tokenizer's own ids, whatever the text; batches of any size give the same pieces."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from pelagia.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    return packing.CachedTokenizer(PATH, max_chunks=20_000)  # starts anew many times


def differ(tok, texts):
    got = tok.encode(pa.array(texts, pa.string()), 1)
    want = tok.full.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [(t, g.tolist(), w.ids) for t, g, w in zip(texts, got, want, strict=True) if g.tolist() != [*w.ids, 1]]


def test_every_code_point(tok):
    points = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c <= 0xDFFF]
    for a in range(0, len(points), 10_000):
        assert not differ(tok, [f"ab{c}cd {c} Ef{c}, {c}{c}G" for c in points[a : a + 10_000]])


def test_mixed_texts(tok):
    rng = random.Random(1)
    letters = [chr(c) for c in range(1, 0x180)] + list("ſıİΣσςßéñ́̀İK'’…—　中") + ["'s", "'t", "<|", "|>", "<|endoftext|>", "<|startoftext|>", "  ", "\n\t", "\x1c\x1f"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 40))) for _ in range(20_000)]
    for a in range(0, len(texts), 5000):
        assert not differ(tok, [*texts[a : a + 5000], None, "", " "])


def test_nothing_to_encode(tok):
    assert tok.encode(pa.array([], pa.string()), 1) == []
    assert [x.tolist() for x in tok.encode(pa.array([None, "", "\n"], pa.string()), 7)] == [[7], [7], [7]]


def test_batches_are_put_together_and_cut():
    rng = random.Random(2)
    texts = [None if rng.random() < 0.1 else "x" * rng.choice((0, 1, 50, 3000)) for _ in range(500)]
    whole = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    cut = [whole.slice(a, 7) for a in range(0, 500, 7)]
    for batches in ([whole], cut, [whole.slice(0, 0), whole, whole.slice(0, 0)]):
        parts = list(packing._together(iter(batches), 9000))
        assert [d for ids, _ in parts for d in ids] == list(range(500)) and [t for _, x in parts for t in x.to_pylist()] == texts
        assert all(sum(len(t or "") for t in x.to_pylist()) <= 9000 + 3000 for _, x in parts)
    assert list(packing._together(iter([]))) == []


def test_open_windows_do_not_keep_their_batch(tok):
    state = packing.SumOfSquares(64)
    ids = np.arange(10, dtype="<u4")
    state.place((1, 0, ids[3:].copy(), 7), 7)
    assert state.close()[0][2].base is None
