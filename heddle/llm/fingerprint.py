"""Improbable-feature digests: rare byte windows in chained Bloom filters.

Every 32-byte window of the UTF-8 text gets a Shannon entropy and, by a fixed rule, a rarity rank: the density of
a normal law around the entropy that windows of prose have. Entropies in either tail are improbable, and so rare;
windows of nearly one symbol carry nothing and are passed over. A window that is the rarest of at least POPULAR
of the 32 runs of 32 neighbouring windows that hold it is a feature. Features go, in order, into a chain of Bloom filters of
2048 bits with five bits and at most 160 features each. Two digests are compared filter by filter by their bit
overlap beyond what chance gives.

The rule is fixed, so digests of different corpora can be compared, and a text's digest depends on nothing else.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import batch_of, in_arrow, pieces, project

WINDOW = 32
POPULAR = 8
BITS, HASHES, PER_FILTER = 2048, 5, 160
# Entropy in bits of a prose window: middle and spread of the normal law; windows under LEAST are passed over.
MIDDLE, SPREAD, LEAST = 3.55, 0.24, 1.5
# Texts under this many bytes have too few windows to choose from: all their SHORT_WINDOW-byte windows are features.
SHORT_TEXT, SHORT_WINDOW = 128, 8
_SCALE = 1 << 16
_NONE = np.int64(1 << 20)

_counts = np.arange(WINDOW + 1)
_PLOGP = np.round(np.where(_counts > 0, _counts * np.log2(np.maximum(_counts, 1)), 0) * _SCALE).astype(np.int64)
_GROW = np.concatenate([[0], np.diff(_PLOGP)])  # what the c-th copy of a byte adds


def _rarity_table() -> np.ndarray:
    """Rank by entropy in steps of 1/1024 of the largest; less is rarer."""
    bits = np.arange(1025) / 1024 * np.log2(WINDOW)
    rank = np.round(1000 * np.exp(-(((bits - MIDDLE) / SPREAD) ** 2) / 2)).astype(np.int64)
    return np.where(bits < LEAST, _NONE, rank)


_RARITY = _rarity_table()


def window_ranks(data: np.ndarray) -> np.ndarray:
    """Rank of the window that starts at each byte of data; windows are those that end inside."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64)
    ahead = np.ones(len(data), np.uint8)  # copies of a byte among it and the next 31
    behind = np.ones(len(data), np.uint8)
    for lag in range(1, WINDOW):
        same = data[lag:] == data[:-lag]
        ahead[:-lag] += same
        behind[lag:] += same
    first = _PLOGP[np.bincount(data[:WINDOW], minlength=256)].sum()
    steps = _GROW[behind[WINDOW:]] - _GROW[ahead[: n - 1]]
    total = np.concatenate([[first], first + np.cumsum(steps)])
    entropy = np.log2(WINDOW) - total / (_SCALE * WINDOW)
    return _RARITY[np.clip(np.rint(entropy / np.log2(WINDOW) * 1024).astype(np.int64), 0, 1024)]


def features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature positions in the texts joined in data, and 64-bit hashes. starts: of the texts, and the end.

    The 31 windows that run over a text's end have no rank, so no run of 32 windows sees two texts.
    """
    ranks = window_ranks(data)
    if not len(ranks):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    over = (starts[1:-1, None] - np.arange(1, WINDOW)).ravel()
    over = over[(over >= 0) & (over < len(ranks))]
    ranks[over] = _NONE
    wide = np.concatenate([np.full(WINDOW - 1, _NONE), ranks, np.full(WINDOW - 1, _NONE)])
    key = (wide << np.int64(40)) | np.arange(len(wide))
    span = 1
    while span < WINDOW:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    key = key[(key >> np.int64(40)) < _NONE]
    votes = np.bincount((key & np.int64((1 << 40) - 1)) - (WINDOW - 1), minlength=len(ranks))
    at = np.flatnonzero(votes >= POPULAR)
    words = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[at].copy().view("<u8")
    return at, mixed(words)


def mixed(words: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of four 64-bit words."""
    h = np.full(len(words), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h = h * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h


def digests(texts: list[bytes]) -> list[np.ndarray]:
    """For each text its chain of filters, as a bool array with a row for each filter.

    In a text under SHORT_TEXT bytes, or a longer one without a feature, each window of SHORT_WINDOW bytes (or the whole
    text) is one feature; an empty text has no filter.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    at, hashes = features(data, starts)
    owner = np.searchsorted(starts, at, side="right") - 1
    small = sizes < SHORT_TEXT
    if len(owner):
        keep = ~small[owner]
        owner, at, hashes = owner[keep], at[keep], hashes[keep]
    small |= np.bincount(owner, minlength=len(texts)) == 0  # longer, but of a symbol or two: no window has a rank
    small &= sizes > 0
    if small.any():
        found = [(i, starts[i] + k, texts[i][k : k + SHORT_WINDOW].ljust(WINDOW, b"\0")) for i in np.flatnonzero(small) for k in range(max(1, sizes[i] - SHORT_WINDOW + 1))]
        words = np.frombuffer(b"".join(f[2] for f in found), np.uint8).reshape(-1, WINDOW).copy().view("<u8")
        owner = np.concatenate([owner, [f[0] for f in found]])
        hashes, at = np.concatenate([hashes, mixed(words)]), np.concatenate([at, [f[1] for f in found]])
        order = np.argsort(at, kind="stable")
        owner, hashes = owner[order], hashes[order]
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))  # a feature counts once a text, where it comes first
    again = np.zeros(len(order), bool)
    again[1:] = (owner[order][1:] == owner[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    keep = np.sort(order[~again])
    owner, hashes = owner[keep], hashes[keep]
    begin = np.searchsorted(owner, np.arange(len(texts) + 1))
    n_filters = -(-np.diff(begin) // PER_FILTER)
    base = np.concatenate([[0], np.cumsum(n_filters)])
    which = base[owner] + (np.arange(len(owner)) - begin[owner]) // PER_FILTER
    bits = np.zeros((base[-1], BITS), bool)
    for k in range(HASHES):
        bits[which, ((hashes >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
    return [bits[base[i] : base[i + 1]] for i in range(len(texts))]


def encoded(filters: np.ndarray) -> str:
    """The digest as text: number of filters, then their bits in base 64."""
    return f"{len(filters)}:" + base64.b64encode(np.packbits(filters, axis=1).tobytes()).decode("ascii")


def decoded(digest: str) -> np.ndarray:
    count, _, body = digest.partition(":")
    return np.unpackbits(np.frombuffer(base64.b64decode(body), np.uint8).reshape(int(count), BITS // 8), axis=1).astype(bool)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1. Each filter of the shorter chain takes its best match in the other; the mean counts. Equal: 1."""
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    common = a.astype(np.float32) @ b.T.astype(np.float32)
    of_a, of_b = a.sum(1, dtype=np.float64)[:, None], b.sum(1, dtype=np.float64)[None, :]
    chance, most = of_a * of_b / BITS, np.minimum(of_a, of_b)
    floor = chance + 0.3 * (most - chance)
    return float(np.clip((common - floor) / np.maximum(most - floor, 1e-9), 0, 1).max(1).mean())


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint string) of every whole text. Null and empty texts have the empty chain; repeated rows stay."""
    schema = pa.schema([(id_col, pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col):
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            yield batch_of(schema, [batch.column(0), [encoded(d) for d in digests(texts)]])

    return in_arrow(project(docs, **{id_col: "long", text_col: "string"}), run, f"`{id_col}` long, fingerprint string")


def compare_neighbours(docs: DataFrame, rows_per_bucket: int = 5000) -> DataFrame:
    """Fingerprints of each document and of an edit of it, and their likeness; also that of the next document.

    The edit puts the first floor(n/4) code points (or all) of the next document, in ascending doc_id, in place of
    as many at the end; the next of the last is the first. Ties in doc_id go by text; rows without doc_id come first.
    One shuffle of the texts, by ranges of id and of the text's beginning; a task holds a few megabytes of them at a
    time. What a range's last document is compared with is the first of the next range. Empty table: no rows.
    """
    ids = project(docs, doc_id="long")
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    base = project(docs, doc_id="long", text="string")
    ranged = base.repartitionByRange(max(1, -(-ids.count() // rows_per_bucket)), order[0], F.substring("text", 1, 64).asc_nulls_first())
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def compared(pairs: list[tuple]) -> pa.RecordBatch:
        """pairs: a document and the next one, as (doc_id, text, digest)."""
        edits = []
        for a, b in pairs:
            k = len(a[1]) // 4
            edits.append((a[1][: len(a[1]) - k] + b[1][:k]).encode())
        edited = digests(edits)
        return batch_of(
            schema,
            [
                [a[0] for a, _ in pairs],
                [len(a[1]) for a, _ in pairs],
                [hashlib.sha256(e).hexdigest() for e in edits],
                [encoded(a[2]) for a, _ in pairs],
                [encoded(m) for m in edited],
                [likeness(a[2], m) for (a, _), m in zip(pairs, edited, strict=True)],
                [likeness(a[2], b[2]) for a, b in pairs],
            ],
        )

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = []  # the document that waits for the next one
        for batch in pieces(batches, "text"):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            chain = last + list(zip(batch.column(0).to_pylist(), texts, digests([t.encode() for t in texts]), strict=True))
            last = chain[-1:]
            if len(chain) > 1:
                yield compared(list(zip(chain, chain[1:])))

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            columns = [batch.column(i).to_pylist() for i in range(4)]
            one, two = (list(zip(columns[i], texts, digests([t.encode() for t in texts]), strict=True)) for i in (0, 2) for texts in [[t or "" for t in columns[i + 1]]])
            yield compared(list(zip(one, two, strict=True)))

    wanted = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    row = F.struct("doc_id", "text")  # in order, nulls first
    ends = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min(row).alias("head"), F.max(row).alias("tail"))
    parts = ends.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(Window.orderBy("part"))).alias("next"))  # a number for each range
    heads = ends.select(F.col("part").alias("next"), "head")
    borders = ends.select("part", "tail").join(parts, "part").join(heads, "next").select("tail.doc_id", "tail.text", F.col("head.doc_id").alias("next_id"), F.col("head.text").alias("next_text"))
    return in_arrow(ranged.sortWithinPartitions(*order), within, wanted).unionByName(in_arrow(borders, between, wanted))
