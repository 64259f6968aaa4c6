import itertools
import os
import struct

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from heddle.llm import pieces

from .cases import awkward, empty

PATH = "/opt/tokenizers/piece_bpe_32k.model"


def field(number, kind, body):
    return bytes([number << 3 | kind]) + (bytes([len(body)]) + body if kind == 2 else body)


def build(vocabulary):
    """A model file: specials, all byte pieces, then the vocabulary with scores."""
    out = b""
    for text, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [(f"<0x{b:02X}>", 0, 6) for b in range(256)] + [(t, s, 1) for t, s in vocabulary]:
        out += field(1, 2, field(1, 2, text.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind])))
    trainer = field(3, 0, b"\x01") + bytes([35 << 3 & 127 | 128, 35 << 3 >> 7, 1])  # unigram, byte fallback
    return out + field(2, 2, trainer) + field(3, 2, field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00"))


VOCABULARY = [("▁", -3.0), ("▁a", -2.5), ("a", -4.0), ("b", -4.5), ("ab", -5.0), ("ba", -6.5), ("abab", -8.0), ("▁ab", -5.5), ("c", -7.0), ("▁▁", -4.0), ("é", -5.0)]
MODEL = pieces.Model(build(VOCABULARY))


def best_score(text):
    """By trying every split of a text whose characters are all pieces."""
    scores = dict(VOCABULARY)
    best = None
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, start = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                parts.append(text[start:i])
                start = i
        parts.append(text[start:])
        if all(p in scores for p in parts):
            total = sum(scores[p] for p in parts)
            best = total if best is None else max(best, total)
    return best


@settings(max_examples=150, deadline=None)
@given(st.text("abcé ", min_size=1, max_size=9))
def test_viterbi_is_best(text):
    ids = MODEL.encode(text)
    assert sum(MODEL.scores[i] for i in ids) == best_score("▁" + text.replace(" ", "▁"))


LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL.data)


@settings(max_examples=200, deadline=None)
@given(st.text("abcé x漢\n☃", max_size=25))
def test_equals_the_library(text):
    assert MODEL.encode(text) == LIBRARY.encode(text)
    assert MODEL.decode(MODEL.encode(text)) == text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_round_trip(text):
    assert MODEL.decode(MODEL.encode(text)) == text.replace("▁", " ")


@pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary")
def test_public_vocabulary(spark):
    data = pieces.read_model(PATH).replace(b"\x15" + struct.pack("<f", -1e9), b"\x15" + struct.pack("<f", -40000.0))
    own = pieces.Model(data)
    head = b"\x12\x06tok_v0\x18"
    library = sentencepiece.SentencePieceProcessor(model_proto=data.replace(head + b"\x02", head + b"\x01"))
    for text in ["The quick brown fox", "Ça va très bien, señor Müller?", "x" * 50, "tabs\tand  spaces  "]:
        assert own.encode(text) == library.encode(text)


def test_awkward(spark):
    rows, docs = awkward(spark)
    out = pieces.round_trip(docs, MODEL.data, keep=True).collect()
    assert len(out) == len(rows) and all(r.exact for r in out)
    assert sorted(r.n_tokens for r in out if r.n_chars == 0) == [0, 0, 0]
    encoded = pieces.encode(docs, MODEL.data)
    back = pieces.decode(encoded, MODEL.data).collect()
    assert sorted((r.text or "") for r in back) == sorted((r[1] or "") for r in rows) and sum(r.text is None for r in back) == 2
    assert pieces.round_trip(empty(spark), MODEL.data).count() == 0
