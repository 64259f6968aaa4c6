"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

At each position of a text the automaton stands at its longest suffix that begins a piece; its output links name all
pieces that end there, and each relaxes the best score of the position. Going back from the end gives the pieces.
Of equal scores the piece that begins first wins. Characters that no piece covers become their UTF-8 bytes.

Where no piece has a space mark after another character, the best path of a text is that of its words, so words are
worked out once and kept. The model file is read as it is; scores are used as a unigram model's log probabilities.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import batch_of, in_arrow, project
from ._common import pieces as slices

MARK = "▁"
# Piece types of a SentencePiece model.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
KEEP, LONGEST = 250_000, 64  # words kept by a worker, and their longest


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at += 1
            if data[at - 1] < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        key, at = number(at)
        kind = key & 7
        if kind == 0:
            value, at = number(at)
        elif kind == 2:
            size, at = number(at)
            value, at = data[at : at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"not a model file: wire type {kind}")
        yield key >> 3, value


class Model:
    """A piece vocabulary with its automaton."""

    def __init__(self, data: bytes):
        self.data = data
        self.texts: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.dummy_prefix, self.extra_spaces, charsmap = True, True, b""
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.texts.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 3:
                spec = dict(_fields(value))
                charsmap = spec.get(2, b"")
                self.dummy_prefix, self.extra_spaces = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if charsmap:
            raise ValueError("the model normalises characters, which is not supported")
        self.automaton = ahocorasick.Automaton()
        self.raw: list[bytes] = []
        self.byte_ids = [-1] * 256
        self.unknown = 0
        self.splits = True
        least = 0.0
        for i, (text, score, kind) in enumerate(zip(self.texts, self.scores, self.kinds, strict=True)):
            plain = text.replace(MARK, " ")
            if kind == BYTE:
                value = int(text[3:-1], 16)
                self.byte_ids[value] = i
                self.raw.append(bytes([value]))
                continue
            self.raw.append(b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else plain.encode())
            if kind == UNKNOWN:
                self.unknown = i
            if kind in (NORMAL, USER) and plain:
                self.automaton.add_word(plain, (len(plain), score, i))
                self.splits &= " " not in plain.lstrip(" ")
                least = min(least, score)
        self.automaton.make_automaton()
        self.unknown_score = least - 10
        self.known: dict[str, tuple[int, ...]] = {}
        self.words = re.compile(" *[^ ]+| +" if self.splits else r"(?s:.+)")

    def viterbi(self, text: str) -> tuple[int, ...]:
        """Ids of the best path over a text in which spaces stand for marks."""
        n = len(text)
        best = [0.0] + [float("-inf")] * n
        via = [(0, -1)] * (n + 1)  # length and id of the piece that ends here
        done = 0  # positions up to here have had their character tried as an unknown one
        single = [False] * (n + 1)  # whether a piece is the character that ends here

        def alone(start: int, stop: int) -> None:
            for e in range(start, stop):
                if not single[e] and best[e - 1] + self.unknown_score > best[e]:
                    best[e], via[e] = best[e - 1] + self.unknown_score, (1, -1)

        for last, (size, score, i) in self.automaton.iter(text):
            end = last + 1
            if end - 1 > done:
                alone(done + 1, end)
                done = end - 1
            if size == 1:
                single[end] = True
            over = best[end - size] + score
            if over > best[end]:
                best[end], via[end] = over, (size, i)
        alone(done + 1, n + 1)
        ids: list[int] = []
        while n:
            size, i = via[n]
            if i >= 0:
                ids.append(i)
            else:
                own = [self.byte_ids[b] for b in text[n - 1].encode()]
                ids.extend(reversed(own) if min(own) >= 0 else [self.unknown])
            n -= size
        return tuple(reversed(ids))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        plain = text.replace(MARK, " ")
        if self.extra_spaces:
            plain = re.sub(" +", " ", plain).strip(" ")
        known = self.known
        parts = []
        for word in self.words.findall(f" {plain}" if self.dummy_prefix else plain):
            ids = known.get(word)
            if ids is None:
                ids = self.viterbi(word)
                if len(word) <= LONGEST:
                    if len(known) >= KEEP:
                        known.clear()
                    known[word] = ids
            parts.append(ids)
        return list(chain.from_iterable(parts))

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; bytes that form no character become U+FFFD."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


_LOADED: dict[str, Model] = {}


def loaded(data: bytes) -> Model:
    """The model of these bytes, built once a worker."""
    key = hashlib.sha256(data).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Model(data)
    return _LOADED[key]


def read_model(path: str) -> bytes:
    """Bytes of a model file that the driver can open; its size is that of a vocabulary, and bounds what is broadcast."""
    with open(path, "rb") as f:
        data = f.read()
    if len(data) > 64 << 20:
        raise ValueError(f"{path} has {len(data)} bytes: too many for a vocabulary")
    Model(data)
    return data


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text; null for a null text, empty for an empty one. Repeated rows stay."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = loaded(shared.value)
        for batch in slices(batches, "text"):
            yield batch_of(schema, [batch.column(0), [None if t is None else m.encode(t) for t in batch.column(1).to_pylist()]])

    return in_arrow(project(docs, doc_id="long", text="string"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, text) of encode()'s rows; null for null ids. Exact but for U+2581, which decodes as a space."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = loaded(shared.value)
        for batch in batches:
            yield batch_of(schema, [batch.column(0), [None if i is None else m.decode(i) for i in batch.column(1).to_pylist()]])

    return in_arrow(project(encoded, doc_id="long", ids="array<int>"), run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: bytes, keep: bool = False) -> DataFrame:
    """Encodes every whole text and decodes its ids, in one pass.

    (doc_id, n_chars, n_tokens, ids_sha256 of the ids as little-endian 32-bit numbers, decoded_sha256, exact), and with
    `keep` the ids. A null text counts as empty; exact says whether the text came back.
    """
    names = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("exact", pa.bool_())]
    schema = pa.schema(names + ([("ids", pa.list_(pa.int32()))] if keep else []))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = loaded(shared.value)
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                ids = m.encode(text)
                back = m.decode(ids)
                rows.append((doc_id, len(text), len(ids), hashlib.sha256(array("i", ids).tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == text, ids))
            yield batch_of(schema, [list(c) for c in list(zip(*rows, strict=True))[: len(schema)]])

    wanted = "doc_id long, n_chars long, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean" + (", ids array<int>" if keep else "")
    return in_arrow(project(docs, doc_id="long", text="string"), run, wanted)
