"""Suffix-array dedup: column-wise construction of a collection's Burrows-Wheeler transform and common prefixes.

Whether a 100-byte string starts earlier elsewhere is settled in groups that all its occurrences reach. Each window of
that length has an anchor, the leftmost least hash among its GRAM-byte strings; equal windows have equal anchors at
equal places. Windows of a document that share one anchor place form a segment of under 2 x length bytes. Segments
are grouped by their anchor's bytes. Equal segments are settled by their hash: all but the first are covered whole.
The different segments of a group are a collection of short documents, whose transform is built column by column: each
round inserts one symbol of every document, from the last to the first, reading and writing the transform and the
common prefixes as sequential files. Neighbouring suffixes with a common prefix of the length are one repeated string,
of which only the earliest occurrence stays.
"""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import batch_of, in_arrow, pieces, project, release, written
from .shingles import mix, spans_hash

GRAM = 24
ROUND_BYTES = 2 << 20  # bytes of segments in one collection, unless a single group has more
HOT = 20_000  # different segments of an anchor, beyond which its group is dealt out by single windows
CHUNK = 4 << 20  # a longer text is cut into chunks that overlap by a window
PLACE_BITS = 24  # of the keys that find anchors: fewer bytes than 2^24 are worked on at once
NO_ID = -(1 << 63)


class Columns:
    """Transform and common prefixes of a growing collection, in sequential files of two turns that rounds write anew.

    Files stay open and are written over, for they only grow: what is cut off first would be flushed at each round.
    """

    def __init__(self, folder: str):
        self.turn, self.size = 0, 0
        self.files = {(kind, turn): open(os.path.join(folder, f"{kind}{turn}"), "w+b", buffering=0) for kind in ("symbols", "common") for turn in (0, 1)}

    def __enter__(self) -> Columns:
        return self

    def __exit__(self, *_: object) -> None:
        for f in self.files.values():
            f.close()

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(self._read(self.files[kind, self.turn]) for kind in ("symbols", "common"))

    def _read(self, f: io.FileIO) -> np.ndarray:
        f.seek(0)
        out = np.empty(self.size, np.uint8)
        got = 0
        while got < self.size:
            got += f.readinto(memoryview(out)[got:])
        return out

    def write(self, symbols: np.ndarray, common: np.ndarray) -> None:
        self.turn, self.size = 1 - self.turn, len(symbols)
        for kind, values in (("symbols", symbols), ("common", common)):
            f = self.files[kind, self.turn]
            f.seek(0)
            left = memoryview(values)
            while len(left):
                left = left[f.write(left) :]


NONE = 0xFF  # no symbol before: a byte that UTF-8 never has, greater than all it has


def range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low:high] for ranges that are not empty."""
    if not len(low):
        return np.empty(0, values.dtype)
    padded = np.append(values, values[:1])
    return np.minimum.reduceat(padded, np.stack([low, high], 1).ravel())[::2]


def sorted_suffixes(texts: list[bytes], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column-wise construction over UTF-8 texts: (text number, start, common prefix with the suffix before, at most `most`).

    Rows are all non-empty suffixes in order; ends of texts are less than any byte and differ from each other. Round j
    inserts the suffixes of length j: with the symbol c before a text's suffix of length j - 1 and that suffix's place,
    the new place is the number of lesser symbols and of c's before it (the transform's own rank). The common prefix of
    two neighbours that begin with the same c is one more than the least one between the places they come from.
    """
    m = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    joined = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(sizes)
    with tempfile.TemporaryDirectory() as folder, Columns(folder) as files:
        # Round 0: the empty suffixes; the transform holds the last symbol of each text.
        last = np.full(m, NONE, np.uint8)
        last[sizes > 0] = joined[ends[sizes > 0] - 1]
        files.write(last, np.zeros(m, np.uint8))
        place, alive = np.arange(m), np.arange(m)
        for j in range(1, int(sizes.max(initial=0)) + 1):
            symbols, common = files.read()
            going = sizes[alive] >= j
            alive, place = alive[going], place[going]
            # In stable order the transform's symbols are the first symbols of all suffixes; those of earlier rounds are
            # in already, and those at `place`, which ascends, begin this round's.
            order = np.argsort(symbols, kind="stable")
            fresh = np.zeros(len(symbols), bool)
            fresh[place] = True
            rank = np.flatnonzero(fresh[order])
            moved = order[rank]
            place, alive = moved, alive[np.searchsorted(place, moved)]
            target = m + rank
            # Common prefixes of neighbours in the new order, from the ranges between where they come from.
            own = symbols[place]
            before, after = order[np.maximum(rank - 1, 0)], order[np.minimum(rank + 1, len(order) - 1)]
            same = (rank > 0) & (symbols[before] == own)
            follows = (rank + 1 < len(order)) & (symbols[after] == own)
            shared_before, shared_after = np.zeros(len(place), np.uint8), np.zeros(len(place), np.uint8)
            shared_before[same] = np.minimum(range_min(common, before[same] + 1, place[same] + 1) + 1, most)
            shared_after[follows] = np.minimum(range_min(common, place[follows] + 1, after[follows] + 1) + 1, most)
            old = np.ones(len(symbols) + len(place), bool)
            old[target] = False
            put, shared = np.empty(len(old), np.uint8), np.empty(len(old), np.uint8)
            put[old], shared[old] = symbols, common
            more = sizes[alive] > j
            put[target] = NONE
            put[target[more]] = joined[ends[alive[more]] - j - 1]
            shared[target] = shared_before
            inner = target + 1 < len(old)
            shared[target[inner] + 1] = shared_after[inner]
            files.write(put, shared)
            place = target
        symbols, common = files.read()
    # Each text's suffixes, one symbol longer at each step, lie where the transform's ranks lead.
    final = np.empty(len(symbols), np.int64)
    final[np.argsort(symbols, kind="stable")] = np.arange(len(symbols)) + m
    owner, length = np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64)
    place, alive = np.arange(m), np.arange(m)
    for j in range(1, int(sizes.max(initial=0)) + 1):
        place, alive = final[place[sizes[alive] >= j]], alive[sizes[alive] >= j]
        owner[place], length[place] = alive, j
    full = slice(m, None)
    return owner[full], (sizes[owner] - length)[full], common[full]


def segments(texts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """Of all segments: text number, start, number of windows, anchor's place, anchor's hash, segment's hash.

    Texts are worked on as many at once as places have bits for; none may be longer than that.
    """
    parts, first, held = [], 0, 0
    for i, text in enumerate([*texts, None]):
        if text is not None and len(text) >= 1 << PLACE_BITS:
            raise ValueError(f"a text of {len(text)} bytes has places of more than {PLACE_BITS} bits")
        if text is None or held + len(text) >= 1 << PLACE_BITS:
            own, *rest = joined_segments(texts[first:i], width)
            parts.append((own + first, *rest))
            first, held = i, 0
        held += len(text or b"")
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def joined_segments(texts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """segments() of texts with fewer bytes than 2^PLACE_BITS in all."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    span = width - GRAM + 1
    grams = len(data) - GRAM + 1
    if len(data) < width:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    place = np.arange(grams)
    gram = spans_hash(data, place, place + GRAM)
    key = (gram & ~np.uint64((1 << PLACE_BITS) - 1)) | place.astype(np.uint64)
    reach = 1
    while reach * 2 <= span:
        key = np.minimum(key[:-reach], key[reach:])
        reach *= 2
    if reach < span:
        key = np.minimum(key[: len(key) - (span - reach)], key[span - reach :])
    anchor = (key & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)  # of the window that starts at each byte
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    whole = np.arange(len(anchor)) + width <= (begin + sizes)[owner]
    starts = np.flatnonzero(whole)
    if not len(starts):
        return tuple(np.empty(0, np.int64) for _ in range(6))
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (np.diff(starts) != 1) | (anchor[starts[1:]] != anchor[starts[:-1]]) | (owner[starts[1:]] != owner[starts[:-1]])
    at = np.flatnonzero(fresh)
    first = starts[at]
    count = np.diff(np.append(at, len(starts)))
    own = owner[first]
    return own, first - begin[own], count, anchor[first] - first, gram[anchor[first]].view(np.int64), spans_hash(data, first, first + count - 1 + width).view(np.int64)


def packed(start: np.ndarray, count: np.ndarray, at: np.ndarray, gone: np.ndarray | int) -> np.ndarray:
    """A segment's start, windows and anchor's place in it, in one number that sorts by start."""
    return (start << 23) | (count << 12) | (at << 1) | gone


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return place >> 23, (place >> 12) & 0x7FF, (place >> 1) & 0x7FF, place & 1


def chunks(ids: list[int], texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The texts in chunks that are short enough to work on: ids, offsets, chunks. Each window is in one chunk."""
    out = [(k, at, t[at : at + CHUNK + width - 1]) for k, t in zip(ids, texts, strict=True) for at in range(0, max(1, len(t) - width + 1), CHUNK)]
    return np.array([o[0] for o in out], np.int64), np.array([o[1] for o in out], np.int64), [o[2] for o in out]


def postings(docs: DataFrame, width: int) -> DataFrame:
    """(anchor, segment, key, place) of every document's segments.

    Before anything moves, equal segments of the documents at hand are settled: all but the first are sent on as gone,
    under a number of their own instead of the anchor, so a frequent passage gives a row or two for each batch.
    """
    schema = pa.schema([(n, pa.int64()) for n in ("anchor", "segment", "key", "place")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            keys, base, texts = chunks(batch.column(0).to_pylist(), [(t or "").encode() for t in batch.column(1).to_pylist()], width)
            own, start, count, at, anchor, segment = segments(texts, width)
            if not len(own):
                continue
            key, start = keys[own], start + base[own]
            order = np.lexsort((start, key, segment, anchor))
            key, start, count, at, anchor, segment = (a[order] for a in (key, start, count, at, anchor, segment))
            head = np.ones(len(key), bool)
            head[1:] = (anchor[1:] != anchor[:-1]) | (segment[1:] != segment[:-1])
            first = np.flatnonzero(head)[np.cumsum(head) - 1]
            gone = (key != key[first]) | (start != start[first])
            spread = mix(key.view(np.uint64) ^ mix(start.astype(np.uint64))).view(np.int64)
            yield batch_of(schema, [pa.array(np.where(gone, spread, anchor)), pa.array(segment), pa.array(key), pa.array(packed(start, count, at, gone.astype(np.int64)))])

    return in_arrow(docs, run, "anchor long, segment long, key long, place long")


def settled(rows: DataFrame) -> DataFrame:
    """(gone, anchor, key, start, count, at): segments that equal an earlier one, and the first of each of the different
    segments of an anchor that has several. Reads sorted rows; keeps two of them between batches.
    """
    schema = pa.schema([("gone", pa.bool_()), ("anchor", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("count", pa.int64()), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 4
        sent = np.empty(0, bool)  # whether a held row is already out
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = [batch.column(i).to_numpy() for i in range(4)]
            past = unpacked(fresh[3])[3] == 1
            anchor, segment, key, place = (np.concatenate([h, f[~past]]) for h, f in zip(held, fresh, strict=True))
            was_sent = np.concatenate([sent, np.zeros((~past).sum(), bool)])
            carried = np.arange(len(key)) < len(held[0])
            gone_parts = [(fresh[0][past], fresh[2][past], fresh[3][past])]
            if len(key):
                new_anchor = np.ones(len(key), bool)
                new_anchor[1:] = anchor[1:] != anchor[:-1]
                head = new_anchor.copy()
                head[1:] |= segment[1:] != segment[:-1]
                first = np.flatnonzero(head)[np.cumsum(head) - 1]
                gone = ~carried & ((key != key[first]) | (place != place[first]))
                gone_parts.append((anchor[gone], key[gone], place[gone]))
                group = np.cumsum(new_anchor) - 1
                several = np.bincount(group, head)[group] > 1
                compare = head & several & ~was_sent
                last = group == group[-1]
                keep = np.unique([np.flatnonzero(last & head)[0], np.flatnonzero(last & head)[-1]])
                held = [a[keep] for a in (anchor, segment, key, place)]
                sent = (was_sent | compare)[keep]
                parts = (anchor[compare], key[compare], place[compare])
            else:
                parts = (key, key, key)
            flags = np.concatenate([np.ones(sum(len(g[0]) for g in gone_parts), bool), np.zeros(len(parts[0]), bool)])
            a, k, p = (np.concatenate([g[i] for g in gone_parts] + [parts[i]]) for i in range(3))
            start, count, at, _ = unpacked(p)
            yield batch_of(schema, [pa.array(c) for c in (flags, a, k, start, count, at)])

    ordered = rows.repartition("anchor").sortWithinPartitions("anchor", "segment", "key", "place")
    return in_arrow(ordered, run, "gone boolean, anchor long, key long, start long, count long, at long")


def collections(docs: DataFrame, compare: DataFrame, width: int) -> DataFrame:
    """(anchor, key, start, at, bytes) of the segments to compare; those of a hot anchor window by window."""
    schema = pa.schema([("anchor", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("at", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out = []
            for key, text, parts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data = (text or "").encode()
                for p in parts:
                    own = data[p["start"] : p["start"] + p["count"] - 1 + width]
                    if len(own) != p["count"] - 1 + width:  # of another text that shares the id
                        continue
                    if p["hot"]:
                        for i in range(p["count"]):
                            window = own[i : i + width]
                            number = int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True)
                            out.append((number, key, p["start"] + i, 0, window))
                    else:
                        out.append((p["anchor"], key, p["start"], p["at"], own))
            yield batch_of(schema, [[o[i] for o in out] for i in range(5)])

    hot = compare.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("anchor", F.lit(True).alias("hot"))
    marked = compare.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    # A document has at most as many parts as segments.
    wanted = marked.groupBy("key").agg(F.collect_list(F.struct("anchor", "start", "count", "at", "hot")).alias("parts"))
    return in_arrow(docs.join(wanted, "key").select("key", "text", "parts"), run, "anchor long, key long, start long, at long, bytes binary")


def alike(group: list[tuple[int, int, bytes, int]], width: int) -> list[tuple[int, int, bytes]]:
    """(key, start, bytes) of the segments of one anchor that may share a window with another.

    A window reaches over its anchor by some bytes to the left and the rest to the right. By how many, in steps of a
    quarter, it covers one of four strings around the anchor, nearly as long as itself; segments that share a window
    share that string. This cuts what the transform is built from, and never a shared window.
    """
    if len(group) < 2:
        return []
    slack = width - GRAM
    step = slack // 4 + 1
    seen: dict[tuple[int, bytes], int] = {}
    spans = []
    for _, _, own, at in group:
        mine = []
        for i in range(4):
            low, high = at - i * step, at + GRAM + slack - (i + 1) * step + 1
            if low >= 0 and high <= len(own) and i * step <= slack:
                mine.append((i, own[low : max(high, at + GRAM)]))
        spans.append(mine)
        for m in mine:
            seen[m] = seen.get(m, 0) + 1
    return [g[:3] for g, mine in zip(group, spans, strict=True) if any(seen[m] > 1 for m in mine)]


def repeated(rows: DataFrame, width: int) -> DataFrame:
    """(key, start, count) of the runs of windows in collections() that equal an earlier one, by the suffix order of each collection."""
    schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("count", pa.int64())])

    def later(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        owner, at, common = sorted_suffixes([h[2] for h in held], width)
        run = np.cumsum(common < width)  # suffixes of one number begin with the same window
        fit = np.flatnonzero(np.append(common[1:] >= width, False) | (common >= width))
        key = np.array([h[0] for h in held], np.int64)[owner[fit]]
        start = np.array([h[1] for h in held], np.int64)[owner[fit]] + at[fit]
        order = np.lexsort((start, key, run[fit]))
        key, start, run = key[order], start[order], run[fit][order]
        head = np.ones(len(run), bool)
        head[1:] = run[1:] != run[:-1]
        first = np.flatnonzero(head)[np.cumsum(head) - 1] if len(run) else np.empty(0, np.int64)
        gone = (key != key[first]) | (start != start[first])
        key, start = key[gone], start[gone]
        order = np.lexsort((start, key))
        key, start = key[order], start[order]
        head = np.ones(len(key), bool)
        head[1:] = (key[1:] != key[:-1]) | (np.diff(start) > 1)
        at = np.flatnonzero(head)
        count = start[np.append(at[1:], len(start)) - 1] - start[at] + 1 if len(at) else at
        return batch_of(schema, [pa.array(key[at]), pa.array(start[at]), pa.array(count)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        group: list[tuple[int, int, bytes, int]] = []
        size, last = 0, None
        for batch in batches:
            for anchor, key, start, at, own in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if anchor != last:
                    fit = alike(group, width)
                    held += fit
                    size += sum(len(f[2]) for f in fit)
                    group, last = [], anchor
                    if size >= ROUND_BYTES:
                        yield later(held)
                        held, size = [], 0
                group.append((key, start, own, at))
        held += alike(group, width)
        if held:
            yield later(held)

    return in_arrow(rows.repartition("anchor").sortWithinPartitions("anchor"), run, "key long, start long, count long")


def joined_runs(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of cut() with runs of one document that overlap or touch made one. Sorted by key, texts first, then start."""
    n = batch.num_rows
    key, is_gone = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
    start, end = (pa.compute.fill_null(batch.column(i), -1).to_numpy() for i in (2, 3))
    base = np.zeros(n, np.int64)
    base[1:] = np.cumsum(key[1:] != key[:-1]) * (int(end.max(initial=0)) + 2)
    reach = np.maximum.accumulate(base + end)
    fresh = ~is_gone
    fresh[:1] = True
    fresh[1:] |= (base + start)[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], n) - 1
    kept = batch.take(pa.array(at))
    return pa.RecordBatch.from_arrays([*kept.columns[:3], pa.array(reach[last] - base[last]), *kept.columns[4:]], schema=batch.schema)


def cut(docs: DataFrame, gone: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) from (key, start, count) runs of windows that are covered.

    Documents and runs meet in one shuffle by key and are read in sorted order, a document at a time.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def finish(key: int, texts: list[tuple[int | None, bytes]], starts: list[int], ends: list[int]) -> Iterator[tuple]:
        for doc_id, data in texts:
            parts, at, spans, removed = [], 0, 0, 0
            reach = -1  # end of the last removed run
            for s, e in zip(starts, ends, strict=True):
                e = min(e, len(data))
                if s >= e:
                    continue
                if s > reach:
                    parts.append(data[at:s])
                    spans += 1
                    removed += e - s
                    reach = e
                elif e > reach:
                    removed += e - reach
                    reach = e
                at = reach
            yield doc_id, len(data), removed, spans, b"".join([*parts, data[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, texts, starts, ends, out, size = None, [], [], [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            joined = joined_runs(batch)
            for key, is_gone, start, end, doc_id, text in zip(*(joined.column(i).to_pylist() for i in range(6)), strict=True):
                if key != current:
                    out += finish(current, texts, starts, ends)
                    current, texts, starts, ends = key, [], [], []
                if is_gone:
                    starts.append(start)
                    ends.append(end)
                else:
                    texts.append((doc_id, (text or "").encode()))
                    size += len(texts[-1][1])
            if size >= 4 << 20:
                yield batch_of(schema, [[o[i] for o in out] for i in range(5)])
                out, size = [], 0
        out += finish(current, texts, starts, ends)
        yield batch_of(schema, [[o[i] for o in out] for i in range(5)])

    none = F.lit(None).cast("long")
    rows = docs.select("key", F.lit(False).alias("is_gone"), none.alias("start"), none.alias("end"), "doc_id", "text")
    runs = gone.select("key", F.lit(True), "start", (F.col("start") + F.col("count") - 1 + width), none, F.lit(None).cast("string"))
    both = rows.union(runs).repartition("key").sortWithinPartitions("key", "is_gone", "start")
    return in_arrow(both, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, width: int = 100) -> DataFrame:
    """Removes every byte that a string of `width` bytes covers which also starts earlier, in a smaller doc_id or before
    it in the same document: (doc_id, n_bytes, n_removed, n_spans, kept).

    Texts are UTF-8; null is empty; strings never cross documents and are judged on the input. Rows without doc_id come
    first. Rows that share a doc_id are one document with several texts, of which none is earlier than another at the
    same place, so a repeated row stays as its twin does. Segments are told apart by 128 bits of hashes.
    """
    if not GRAM < width <= 250:
        raise ValueError(f"width must be over {GRAM} and at most 250")
    base = project(docs, doc_id="long", text="string").withColumn("key", F.coalesce("doc_id", F.lit(NO_ID)))
    plain = base.select("key", "text")
    found = written(settled(postings(plain, width)), "segments")
    release(docs.sparkSession)
    few = written(repeated(collections(plain, found.where("not gone"), width), width), "windows")
    release(docs.sparkSession)
    return cut(base, found.where("gone").select("key", "start", "count").unionByName(few), width)


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
