"""Hashes of words and word shingles of many texts at once."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.default_rng(20240601)
_SYMBOL = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, at least n of each."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BACK)):
            steps = np.full(n + (n >> 2), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same for the same bytes."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SYMBOL[data] * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all white-space-separated words: text number, start and end within its text, hash."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    gap = _SPACE[data]
    edge = np.diff(gap, prepend=True)
    starts, ends = np.flatnonzero(edge & ~gap), np.flatnonzero(edge & gap)
    owner = np.searchsorted(begin, starts, side="right") - 1
    return owner, starts - begin[owner], ends - begin[owner], spans_hash(data, starts, ends)


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each text as hashes: (bounds, hashes); text i has hashes[bounds[i]:bounds[i+1]], ascending.

    A text with fewer words than k has its whole sequence as one shingle; one without words has none.
    """
    owner, _, _, word = words(texts)
    counts = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(counts) - counts
    if len(word) >= k:
        h = np.zeros(len(word) - k + 1, np.uint64)
        for j in range(k):
            h = mix(h + word[j : len(word) - k + 1 + j])
        whole = owner[: len(h)] == owner[k - 1 :]
        at, hashes = owner[: len(h)][whole], h[whole]
    else:
        at, hashes = np.empty(0, np.int64), np.empty(0, np.uint64)
    few = np.flatnonzero((counts > 0) & (counts < k))
    if len(few):
        own = np.zeros(len(few), np.uint64)
        for j in range(k - 1):
            has = counts[few] > j
            own[has] = mix(own[has] + word[first[few[has]] + j])
        at, hashes = np.concatenate([at, few]), np.concatenate([hashes, mix(own + counts[few].astype(np.uint64))])
    order = np.lexsort((hashes, at))
    at, hashes = at[order], hashes[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (hashes[1:] != hashes[:-1])
    at, hashes = at[fresh], hashes[fresh]
    return np.searchsorted(at, np.arange(len(texts) + 1)), hashes
