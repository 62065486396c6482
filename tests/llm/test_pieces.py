"""The offset-preserving encoder against the library: ids, spans, decoded texts and normalisation."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece.sentencepiece_model_pb2 import ModelProto

from pelagia.llm import pieces
from tests.llm.test_llm import docs_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", "▁", " ▁ x", "\n\n a\tb\r\n", "\x00", "<s> </s> <unk> <0x41>", "é́ñ", "𝄞𝄞 日本語", "x" * 3000, "word " * 4000, "  lead and trail  ", "﻿​ ", "aaaa    bbbb", "don't", "\U0010ffff"]


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def fuzzed(n, seed=5):
    rng = random.Random(seed)
    alphabet = "abcdefghij THE the ing  \n\t.,'\"<>0123456789éüßñ日本▁𝄞\x00́"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 120))) for _ in range(n)]


def test_ids_and_spans_are_the_librarys(encoder, library):
    for text in [*ODD, *fuzzed(1500)]:
        ids, begins, ends = encoder.encode(text)
        theirs = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in theirs] == library.encode(text)
        assert [(a, b) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)] == [(p.begin, p.end) for p in theirs]
        assert encoder.decode(ids.tolist()) == library.decode(library.encode(text))


def test_long_parts_merge_like_short_ones(encoder):
    rng = random.Random(9)
    words = ["".join(rng.choices("▁abcdehinorst", k=rng.randrange(2, 33))) for _ in range(600)]
    symbols, sizes = encoder._merged(encoder.symbol[[ord(c) for w in words for c in w]], pieces.np.array([len(w) for w in words]))
    at = 0
    for w, n in zip(words, sizes.tolist(), strict=True):
        assert symbols[at : at + n].tolist() == encoder._merged_long([encoder.number[c] for c in w])
        at += n


def test_spans_cover_the_text(encoder):
    for text in [*ODD, *fuzzed(300, 6)]:
        ids, begins, ends = encoder.encode(text)
        raw = text.encode()
        if raw:
            assert begins[0] == 0 and ends[-1] == len(raw)
            assert (begins[1:] == ends[:-1]).all()


def test_longest_prefixes_of_a_character_map():
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = ModelProto()
    spec.ParseFromString(normaliser.serialized_model_proto())
    spec = spec.normalizer_spec
    own = pieces.Normaliser(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
    for text in ["ﬁx ①　Ａ", "  a  b  ", "Å Å é", "㍻ ｶﾞ", "\t\n x  ", "한글", " ", *fuzzed(400, 7)]:
        normal, source = own(text.encode())
        theirs, places = normaliser.normalize(text, with_offsets=True)
        assert normal.decode() == theirs, text
        # The library's places are characters of the text, one for each character of the result and its end.
        ours = []
        at = 0
        for c in normal.decode():
            ours.append(len(text.encode()[: source[at]].decode()))
            at += len(c.encode())
        assert [*ours, len(text.encode()[: source[at]].decode())] == list(places), text


def test_the_query_on_odd_rows(spark, library):
    rows = [(i, t) for i, t in enumerate([*ODD, *fuzzed(60, 8)])] + [(3, "again"), (3, "again"), (None, "no id"), (900, None), (901, "long " * 200_000)]
    docs = docs_of(spark, rows).withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded")
    got = pieces.digest(pieces.encoded(docs, MODEL)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(d, len(ids := library.encode(t or "")), sha(",".join(map(str, ids))), sha(library.decode(ids)), len((t or "").encode())) for d, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert pieces.encoded(docs.limit(0), MODEL).count() == 0
