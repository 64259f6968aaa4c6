"""Benchmark decontamination by edit distance.

The CGK embedding walks along a text with random bits: each step gives out the current character and then stays or
moves on, as the bit for this step and character says. Texts a few edits apart meet again after each edit, so their
embeddings differ in few places. Hashes of a few sampled places of the embedding (bit sampling) then collide for near
texts; walks and samples are repeated until the target recall is reached. Windows of every document, as long as the
half the items of a size class up to WIDEST, are hashed at a stride; items are hashed at every offset, so aligned pairs
always exist. Such a window serves as well as one of the whole item: the share of its places that edits spoil is the
same, and an item has several aligned windows, of which one must collide. A collision whose windows are over LOCAL of
their length apart is left out; then the edit distance of the whole item is worked out exactly.

Texts are compared in lower case with each run of other characters than letters and digits as one space.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import batch_of, in_arrow, pieces, project, rows_kept, written

SHORT = 16  # items under so many characters are looked for as they are, at word bounds
WIDEST = 64  # of the size classes' windows; longer items are hashed by windows of this length at all offsets
SAMPLES = 8  # sampled places of a hash
WALKS = {16: 16, 32: 8, 64: 7}  # by window: an item of few windows hangs on the number of walks
STRIDE = {16: 4, 32: 16, 64: 32}
SURE = {16: 6, 32: 3, 64: 3}  # times the hashes that evenly spread edits would need
PAIRS = 1 << 19  # collisions that are looked at together
SLICE = 1 << 20  # characters that are searched together
GATHERED = 16 << 20  # characters of documents that go through the benchmark's blocks together
LOCAL = 0.35  # edits of a window, as a share of its length, up to which a collision is followed
SPOILED = 2.5  # places of an embedding that an edit changes, on average
_TABLE = 20  # bits of the table that is looked at first
_token = re.compile(r"[^\W_]+")


def normalised(text: str | None) -> str:
    return " ".join(_token.findall(text.lower())) if text else ""


def repeats(recall: float, fraction: float, windows: int) -> int:
    """Hashes with which a pair collides in one of its `windows` aligned windows with probability `recall`.

    windows: those that the shortest item of a class is sure of. Edits are taken to be as many as allowed and spread
    evenly. A walk of as many steps as its window is long reads about half the characters, and an edit spoils SPOILED
    of its places.
    """
    clean = max(0.05, 1 - SPOILED * fraction / 2)
    return math.ceil(math.log(1 - recall) / math.log(1 - clean**SAMPLES) / windows)


def edit_distance_within(item: str, region: str, most: int) -> int | None:
    """Least edit distance of item to any substring of region, if at most `most`; Myers' bit vectors."""
    if item in region:
        return 0
    n = len(item)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best = full, 0, n, n
    for c in region:
        eq = masks.get(c, 0)
        x = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (full & ~(x | plus)), plus & x
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~((eq | minus) | up)), up & (eq | minus)
        best = min(best, score)
    return best if best <= most else None


class SizeClass:
    """Hash index of the items of one size class; all arrays are as large as the items.

    Equal windows are indexed once: `places` of window k are entries bounds[k] to bounds[k + 1] of item and offset.
    """

    def __init__(self, items: list[tuple[int, str]], window: int, fraction: float, recall: float):
        rng = np.random.default_rng(window)
        self.window, self.stride, self.steps, self.walks = window, STRIDE[window], window, WALKS[window]
        offsets = max(0, min(len(t) for _, t in items) - (window - self.stride)) + 1  # at which the shortest is hashed
        reps = max(self.walks, SURE[window] * repeats(recall, fraction, max(1, offsets // self.stride)))
        self.bits = rng.integers(0, 2, (self.walks, self.steps, 256))
        self.places = [[np.arange(SAMPLES) * self.steps // SAMPLES + rng.integers(0, self.steps // SAMPLES, SAMPLES) for _ in range(-(-reps // self.walks))] for _ in range(self.walks)]  # one of each part: places side by side say the same
        text = "".join(t + "\0" * window for _, t in items)
        starts = np.cumsum([0] + [len(t) + window for _, t in items])[:-1]
        many = np.array([max(0, len(t) - (window - self.stride)) + 1 for _, t in items])
        item = np.repeat(np.arange(len(items), dtype=np.int32), many)
        offset = (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)).astype(np.int32)
        embedded = self.walked(low_bytes(text), starts[item] + offset)
        rows = np.ascontiguousarray(embedded.reshape(self.walks * self.steps, -1).T)
        _, first, content = np.unique(rows.view(np.dtype((np.void, rows.shape[1]))).ravel(), return_index=True, return_inverse=True)
        order = np.argsort(content, kind="stable")
        self.item, self.offset = item[order], offset[order]
        self.bounds = np.searchsorted(content[order], np.arange(len(first) + 1))
        low, last = low_bytes(text), starts[item[first]] + np.array([len(t) for _, t in items], np.int64)[item[first]]
        at = starts[item[first]] + offset[first]
        self.size = np.minimum(window, last - at)  # a window's part that lies in its item
        # Where each of 32 classes of characters occurs in the window; to take two for one only makes windows nearer.
        self.masks = np.zeros(len(first) * 32, np.uint64)
        for i in range(window):
            self.masks[np.arange(len(first)) * 32 + (low[at + i] & 31)] |= np.uint64(1 << i)
        self.index = []
        for h in self.hashes(embedded[:, :, first]):
            order = np.argsort(h, kind="stable")
            table = np.zeros(1 << _TABLE, bool)
            table[h >> np.uint64(64 - _TABLE)] = True
            self.index.append((h[order], order.astype(np.int32), np.packbits(table)))
        self.lengths = np.array([len(t) for _, t in items], np.int64)
        self.most = (fraction * self.lengths).astype(np.int64)

    def walked(self, low: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The embeddings of all windows, by walk, step and window. low ends with a window's length of zeros."""
        out, stay = np.empty((self.walks, self.steps, len(at)), np.uint8), np.empty(len(at), np.int64)
        for walk in range(self.walks):
            here = at.astype(np.int64)
            for step in range(self.steps):
                c = np.take(low, here, out=out[walk, step], mode="clip")
                here += np.take(self.bits[walk, step], c, out=stay, mode="clip")
        return out

    def hashes(self, embedded: np.ndarray) -> Iterator[np.ndarray]:
        """The hash of every window, for each repetition: a mix of the sampled places' bytes."""
        sample = np.empty((embedded.shape[2], SAMPLES), np.uint8)
        for walk in range(self.walks):
            for r, places in enumerate(self.places[walk]):
                for i, step in enumerate(places):
                    sample[:, i] = embedded[walk, step]
                h = sample.view(np.uint64).ravel() ^ np.uint64(0x9E3779B97F4A7C15 + r)
                h *= np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(31)
                h *= np.uint64(0xBF58476D1CE4E5B9)
                yield h

    def collisions(self, embedded: np.ndarray) -> Iterator[np.ndarray]:
        """Window x number of indexed windows + the indexed one it collides with, at most PAIRS and a window's at once."""
        if not hasattr(self, "_tables"):
            self._tables = [np.unpackbits(t).astype(bool) for _, _, t in self.index]
        for h, (keys, order, _), table in zip(self.hashes(embedded), self.index, self._tables, strict=True):
            hit = np.flatnonzero(table[h >> np.uint64(64 - _TABLE)])
            left, right = np.searchsorted(keys, h[hit], "left"), np.searchsorted(keys, h[hit], "right")
            n = right - left
            hit, left, n = hit[n > 0], left[n > 0], n[n > 0]
            for own, inner in expanded(n):
                yield hit[own] * np.int64(len(order)) + order[left[own] + inner]

    def candidates(self, low: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in `at`, number of the indexed window), once each, of the collisions whose windows are near."""
        found, held = [np.empty(0, np.int64)], []

        def near() -> np.ndarray:
            both = distinct(np.concatenate(held))
            k = both % len(self.size)
            keep = [self.apart(low, at[both[i : i + 8192] // len(self.size)], k[i : i + 8192]) for i in range(0, len(both), 8192)]
            return both[np.concatenate(keep) <= LOCAL * self.size[k]]

        for some in self.collisions(self.walked(low, at)):
            held.append(some)
            if sum(map(len, held)) > PAIRS:
                found.append(near())
                held = []
        if held:
            found.append(near())
        both = distinct(np.concatenate(found))
        return both // len(self.size), both % len(self.size)

    def apart(self, low: np.ndarray, at: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Least edit distance of each indexed window to a part of the text around each place; Myers' bit vectors."""
        base, size, reach, one = k * 32, self.size[k], self.window // 8, np.uint64(1)
        top = (size - 1).astype(np.uint64)
        plus, minus = np.full(len(k), ~np.uint64(0)), np.zeros(len(k), np.uint64)
        eq, x, up, down = (np.empty(len(k), np.uint64) for _ in range(4))
        c, score, best = np.empty(len(k), np.uint8), size.copy(), size.copy()
        at = at - reach
        for _ in range(self.window + 3 * reach):
            np.take(low, at, out=c, mode="clip")
            at += 1
            np.bitwise_and(c, 31, out=c)
            np.take(self.masks, base + c, out=eq, mode="clip")
            np.bitwise_and(eq, plus, out=x)
            x += plus
            x ^= plus
            x |= eq
            np.bitwise_or(x, plus, out=up)
            np.invert(up, out=up)
            up |= minus
            np.bitwise_and(plus, x, out=down)
            eq |= minus
            score += ((up >> top) & one).view(np.int64)
            score -= ((down >> top) & one).view(np.int64)
            np.minimum(best, score, out=best)
            up <<= one
            down <<= one
            np.bitwise_or(eq, up, out=x)
            np.invert(x, out=x)
            np.bitwise_or(down, x, out=plus)
            np.bitwise_and(up, eq, out=minus)
        return best

    def regions(self, low: np.ndarray, at: np.ndarray, owner: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rows (text number, item number, start): parts of texts where an item may begin, within its slack, once each."""
        w, k = self.candidates(low, at)
        out = [np.empty((0, 3), np.int64)]
        for own, inner in expanded(self.bounds[k + 1] - self.bounds[k]):
            entry = self.bounds[k[own]] + inner
            item = self.item[entry]
            slack = self.most[item] // 2 + 1  # beginnings that are so near share a region
            rows = np.stack([owner[w[own]], item, (place[w[own]] - self.offset[entry]) // slack * slack], 1)
            out.append(np.unique(rows, axis=0))
        return np.unique(np.concatenate(out), axis=0)


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.diff(x, prepend=x[:1] - 1) != 0]


def expanded(n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each i its number n[i] times, and the turn: parts of at most PAIRS, or of one i."""
    ends = np.cumsum(n)
    a = 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS, side="right")))
        part = n[a:b]
        own = np.repeat(np.arange(a, b), part)
        yield own, np.arange(len(own)) - np.repeat(np.cumsum(part) - part, part)
        a = b


def low_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint8)[::4].copy()


class Index:
    """All items of one block, by size class."""

    def __init__(self, items: list[tuple[int, str]], fraction: float, recall: float):
        self.fraction = fraction
        self.short = [(i, t) for i, t in items if 0 < len(t) < SHORT]
        groups: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for i, t in items:
            if len(t) >= SHORT:
                groups[max(SHORT, min(WIDEST, 1 << (len(t).bit_length() - 2)))].append((i, t))
        self.groups = {w: (own, SizeClass(own, w, fraction, recall)) for w, own in sorted(groups.items())}

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text number, item id, distance, item length) of each item that occurs in each normalised text."""
        found: list[tuple[int, int, int, int]] = []
        if self.short:
            exact = ahocorasick.Automaton()
            same = defaultdict(list)
            for i, t in self.short:
                same[t].append(i)
            for t, ids in same.items():
                exact.add_word(f" {t} ", (ids, len(t)))
            exact.make_automaton()
            for d, text in enumerate(texts):
                for n, i in {(n, i) for _, (ids, n) in exact.iter(f" {text} ") for i in ids}:
                    found.append((d, i, 0, n))
        first, at = [], 0
        for i, t in enumerate(texts):
            if not i or at + len(t) > SLICE:
                first.append(i)
                at = 0
            at += len(t)
        for a, b in zip(first, [*first[1:], len(texts)]):
            for items, size_class in self.groups.values():
                found += [(a + d, *rest) for d, *rest in self._near(texts[a:b], items, size_class)]
        return found

    @staticmethod
    def _near(texts: list[str], items: list[tuple[int, str]], size_class: SizeClass) -> list[tuple[int, int, int, int]]:
        sizes = np.array([len(t) for t in texts], np.int64)
        low = low_bytes("".join(t + "\0" for t in texts) + "\0" * (size_class.window + 3))
        starts = np.cumsum(sizes + 1) - sizes - 1
        many = np.where(sizes > 0, (sizes - 1) // size_class.stride + 1, 0)
        owner = np.repeat(np.arange(len(texts)), many)
        place = (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)) * size_class.stride
        best: dict[tuple[int, int], int] = {}
        for d, i, begin in size_class.regions(low, starts[owner] + place, owner, place).tolist():
            if best.get((d, i)) == 0:
                continue
            item, most = items[i][1], int(size_class.most[i])
            distance = edit_distance_within(item, texts[d][max(0, begin - most) : begin + most // 2 + 1 + len(item) + most], most)
            if distance is not None and distance < best.get((d, i), most + 1):
                best[d, i] = distance
        return [(d, items[i][0], n, len(items[i][1])) for (d, i), n in best.items()]


class Blocks:
    """The benchmark in blocks of about block_chars characters. A task builds one block's index at a time, and keeps it
    if there is no other.
    """

    def __init__(self, items: list[tuple[int, str]], fraction: float, recall: float, block_chars: int):
        self.fraction, self.recall, self.blocks = fraction, recall, [[]]
        held = 0
        for item in items:
            if held and held + len(item[1]) > block_chars:
                self.blocks.append([])
                held = 0
            self.blocks[-1].append(item)
            held += len(item[1])
        self._index: Index | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_index": None}

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        found = []
        for block in self.blocks:
            index = self._index or Index(block, self.fraction, self.recall)
            if len(self.blocks) == 1:
                self._index = index
            found += index.search(texts)
        return found


def leaks(docs: DataFrame, benchmark: DataFrame, fraction: float = 0.2, recall: float = 0.95, block_chars: int = 200_000, pass_chars: int = 1 << 25) -> DataFrame:
    """(doc_id, item_id, distance, item_chars): each item within `fraction` x its length edits of a part of a document.

    Lengths and distances are of normalised texts. Items under SHORT characters must occur as they are; items without
    any letter or digit occur nowhere. Every document is searched for every item. The documents are read once for each
    pass_chars characters of the benchmark, which is what the driver holds and broadcasts; tasks build indexes of blocks
    of about block_chars. Null and empty documents have no leak; repeated rows give repeated results; of an item's
    occurrences the one of least distance counts, and items tie freely, for each has a row of its own.
    """
    base = project(docs, doc_id="long", text="string")
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("item_chars", pa.int32())])
    out = None
    for blocks, last in passes(benchmark, fraction, recall, block_chars, pass_chars):

        def run(batches: Iterator[pa.RecordBatch], blocks=blocks) -> Iterator[pa.RecordBatch]:
            known = blocks.value
            most = SLICE if len(known.blocks) == 1 else GATHERED
            ids, texts, held = [], [], 0

            def found() -> pa.RecordBatch:
                hits = sorted(known.search(texts))
                return batch_of(schema, [[ids[h[0]] for h in hits], [h[1] for h in hits], [h[2] for h in hits], [h[3] for h in hits]])

            for batch in pieces(batches, "text"):
                ids += batch.column(0).to_pylist()
                texts += [normalised(t) for t in batch.column(1).to_pylist()]
                held = sum(map(len, texts))
                if held >= most:
                    yield found()
                    ids, texts = [], []
            if ids:
                yield found()

        part = in_arrow(base, run, "doc_id long, item_id long, distance int, item_chars int")
        if out is not None or not last:  # one pass after the other
            part = written(part, "leaks")
            blocks.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def passes(benchmark: DataFrame, fraction: float, recall: float, block_chars: int, pass_chars: int) -> Iterator[tuple[Broadcast[Blocks], bool]]:
    """Broadcasts of the benchmark's parts, at least one, each with whether it is the last."""
    items = project(benchmark, item_id="long", text="string").where("item_id is not null and text is not null")
    parts = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // pass_chars))
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).distinct()
        known = sorted((r.item_id, normalised(r.text)) for r in own.toLocalIterator())
        yield benchmark.sparkSession.sparkContext.broadcast(Blocks(known, fraction, recall, block_chars)), part == parts - 1


def without_leaks(docs: DataFrame, benchmark: DataFrame, fraction: float = 0.2, recall: float = 0.95, block_chars: int = 200_000, pass_chars: int = 1 << 25) -> DataFrame:
    """The rows of docs, with all their columns, in whose texts leaks() finds no item."""
    for blocks, last in passes(benchmark, fraction, recall, block_chars, pass_chars):

        def chooser(blocks=blocks) -> Callable[[list[str | None]], list[bool]]:
            def keep(texts: list[str | None]) -> list[bool]:
                hit = {h[0] for h in blocks.value.search([normalised(t) for t in texts])}
                return [i not in hit for i in range(len(texts))]

            return keep

        docs = rows_kept(docs, chooser, most=1 << 19)
        if not last:
            docs = written(docs, "clean")
            blocks.destroy()
    return docs
