"""N-gram Jaccard join by token-combination prefixes.

Tokens are hashed k-word shingles in one global order: rare ones first, then a class of frequent ones, by hash within
each. Sets with an overlap of t share two tokens among their first n - t + 2. So they share a rare token of this
extended prefix, or else two frequent ones: rare tokens are indexed singly, and what proves frequent there, in more
than SMALL prefixes, goes with the frequent class into combinations of two. Longer sets, whose combinations would be
too many, keep single frequent tokens; sets near the bound have both, so no partner is missed.

Equal sets are one class from the start. A group of a signature gives all pairs of fitting sizes while it is small;
a larger one first links its members to pivots. Of large groups with the same members one stands for all, and those with
the same first member are merged. In those that hold several components, which are dealt out in pairs of blocks, each member meets its nearest ones of other components,
and again while it has more that fit. Candidates are cut by a parity sketch, as long as the set is large, whose bits
bound the symmetric difference from below, and verified on their whole texts: of a pair one text moves to the other's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import batch_of, column_at, dropped, in_arrow, pieces, project, release, written
from .components import components, extended
from .shingles import mix, shingle_sets

SMALL = 16  # a larger group is linked by pivots; tokens that more sets have are frequent
MOST_FREQUENT = 1 << 20  # tokens of the frequent class, the most frequent ones: bounds what is broadcast
PAIRED = 2000  # sets of more tokens have no combinations
SKETCH = (256, 8192)  # fewest and most bits of a sketch, which has two to four for each token between these
PART = 1 << 19  # bytes of text that are hashed at once
BROADCAST = 1 << 18  # rows of a few numbers that may be broadcast, 8 MB of them; more are joined
FILTER = 1 << 23  # bits of the filter of document numbers whose texts are wanted
COUNTED = 8 << 20  # bytes of text in which tokens are counted together
BLOCK = 4096  # members of a large group that meet each other in one task
NEAREST = 1  # partners that a member of a large group gets at once
FEW = 512  # members of large groups that get all their partners at once
HUB = 512  # texts that are verified against one other in a task
LOCAL, SEEN = 2, 6  # counts there that are added up, and the sum from which a token is of the frequent class


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Smallest intersection x of sets of n and m tokens with 100 x >= percent (n + m - x)."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int, more: int = 2) -> int:
    """Tokens that hold at least `more` common ones with every partner: the least overlap is with a partner of percent n."""
    least = -(-percent * n // 100)
    return min(n, n - least + more)


def sketch(hashes: np.ndarray) -> bytes:
    """Parity of the tokens that fall on each bit: a common token changes no bit of two sketches' difference.

    The longer sketch of a larger set folds onto a shorter one by exclusive or, for a bit's place is the token's rest.
    """
    bits = min(SKETCH[1], max(SKETCH[0], 1 << (2 * len(hashes)).bit_length()))
    return np.packbits((np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches as rows of `size` bytes, in 64-bit numbers; none is shorter."""
    out = np.empty((len(sketches), size // 8), np.uint64)
    lengths = np.array([len(x) for x in sketches])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        rows = np.frombuffer(b"".join(sketches[i] for i in at), np.uint64).reshape(len(at), n // size, size // 8)
        out[at] = np.bitwise_xor.reduce(rows, axis=1)
    return out


def set_rows(docs: DataFrame, k: int) -> DataFrame:
    """One pass with two kinds of rows: of each document (doc_id, n, s1, s2, sketch), its set's size, two sums that tell
    sets apart, and its sketch; and of tokens (token, seen), counts of those that LOCAL or more sets nearby have.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("sketch", pa.binary()), ("token", pa.int64()), ("seen", pa.int64())])

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.sort(np.concatenate(held))
        at = np.flatnonzero(np.diff(tokens, prepend=tokens[:1] - np.uint64(1)))
        seen = np.diff(np.append(at, len(tokens)))
        at, seen = at[seen >= LOCAL], seen[seen >= LOCAL]
        none = [pa.nulls(len(at), f.type) for f in list(schema)[:5]]
        return batch_of(schema, [*none, pa.array(tokens[at].view(np.int64)), pa.array(seen)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in pieces(batches, "text", PART):
            texts = [(t or "").encode().lower() for t in batch.column(1).to_pylist()]
            bounds, hashes = shingle_sets(texts, k)
            out = []
            for a, b in zip(bounds, bounds[1:]):
                own = hashes[a:b]
                out.append((int(b - a), int(mix(own).view(np.int64).sum()), int(mix(own ^ np.uint64(0x5851F42D4C957F2D)).view(np.int64).sum()), sketch(own)))
            none = pa.nulls(len(out), pa.int64())
            yield batch_of(schema, [batch.column(0), *[list(c) for c in zip(*out, strict=True)], none, none])
            held.append(hashes)
            size += sum(map(len, texts))
            if size >= COUNTED:
                yield counted(held)
                held, size = [], 0
        if held:
            yield counted(held)

    return in_arrow(docs, run, "doc_id long, n long, s1 long, s2 long, sketch binary, token long, seen long")


def signatures(docs: DataFrame, k: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """(signature, doc_id, n, token) of every document's extended prefix in the order that puts frequent tokens last.

    Of rare tokens the signature is the token. Frequent ones are named in token, and their signature only spreads them.
    """
    schema = pa.schema([("signature", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("token", pa.int64())])
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in pieces(batches, "text", PART):
            ids = batch.column(0).to_pylist()
            bounds, hashes = shingle_sets([(t or "").encode().lower() for t in batch.column(1).to_pylist()], k)
            at = np.searchsorted(known, hashes)
            often = (known[np.minimum(at, len(known) - 1)] == hashes) if len(known) else np.zeros(len(hashes), bool)
            chosen = []
            for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                if b > a and ids[i] is not None:
                    mark = often[a:b]
                    chosen.append(a + np.concatenate([np.flatnonzero(~mark), np.flatnonzero(mark)])[: prefix_length(int(b - a), percent)])
            if not chosen:
                continue
            chosen = np.concatenate(chosen)
            owner = np.searchsorted(bounds, chosen, side="right") - 1
            sizes, numbers = np.diff(bounds), np.array([d or 0 for d in ids], np.int64)
            for at in range(0, len(owner), 1 << 18):
                own, part = owner[at : at + (1 << 18)], chosen[at : at + (1 << 18)]
                token, mark = hashes[part], often[part]
                spread = np.where(mark, mix(token ^ mix(numbers[own].view(np.uint64))), token)
                yield batch_of(schema, [pa.array(spread.view(np.int64)), pa.array(numbers[own]), pa.array(sizes[own]), pa.array(token.view(np.int64), mask=~mark)])

    return in_arrow(docs, run, "signature long, doc_id long, n long, token long")


def combined(hot: DataFrame, percent: int) -> DataFrame:
    """(signature, doc_id, n, token) of the combinations of each document's frequent tokens (token, doc_id, n).

    The single tokens of longer sets go with the set's size band and with the next one: partners are in the same band or
    in neighbouring ones, so they share a signature.
    A document has at most as many frequent tokens as its prefix is long; reads sorted rows, a document at a time.
    """
    schema = pa.schema([("signature", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("token", pa.int64())])

    wide = 1.0001 * math.log(100 / percent) if percent < 100 else 1.0

    def of_documents(token: np.ndarray, ids: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        found, owner, held = [], [], 0
        for a, b in zip(start, np.append(start[1:], len(ids))):
            own, size = token[a:b].view(np.uint64), int(n[a])
            if size <= PAIRED:
                one, two = np.triu_indices(len(own), 1)
                found.append(mix(own[one] + np.uint64(1)) ^ own[two])
            if 100 * size > percent * PAIRED or size == 1:
                band = int(math.log(size) / wide)
                found += [mix(mix(own ^ np.uint64(0x2545F4914F6CDD1D)) + np.uint64(b)) for b in (band, band + 1)]
            owner.append(np.full(sum(map(len, found)) - held, a))
            held += len(owner[-1])
            if held >= 1 << 18 or b == len(ids):
                at = np.concatenate(owner)
                yield batch_of(schema, [pa.array(np.concatenate(found).view(np.int64)), pa.array(ids[at]), pa.array(n[at]), pa.nulls(len(at), pa.int64())])
                found, owner, held = [], [], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int64)] * 3
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(kept)]
            cut = int(np.flatnonzero(rows[1] == rows[1][-1])[0])
            kept = [r[cut:] for r in rows]
            if cut:
                yield from of_documents(*(r[:cut] for r in rows))
        if len(kept[0]):
            yield from of_documents(*kept)

    rows = hot.select("token", "doc_id", "n").repartition("doc_id").sortWithinPartitions("doc_id", "token")
    return in_arrow(rows, run, "signature long, doc_id long, n long, token long")


def all_pairs(ids: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within each row of ids whose sizes fit; sizes ascend along a row."""
    one, two = np.triu_indices(ids.shape[1], 1)
    fit = 100 * n[:, one] >= percent * n[:, two]
    return ids[:, one][fit], ids[:, two][fit]


def candidates(rows: DataFrame, percent: int, pivots: bool) -> DataFrame:
    """Rows (hot, x, y, n): hot false, a pair of documents of a group; hot true, signature and document of a large group
    (or of a token named as frequent) and the document's n, or with `pivots` the group's first document.

    Reads the groups in sorted order; holds a group of SMALL rows, or with `pivots` of a larger one the pivot to which
    its next rows are linked. A row that is too large for the pivot becomes the next.
    """
    schema = pa.schema([("hot", pa.bool_()), ("x", pa.int64()), ("y", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        open_group, first, pivot = None, 0, (0, 0)  # a large group that goes on, its first id, and its pivot's id and size

        def star(sig: int, ids: np.ndarray, n: np.ndarray, out: list) -> None:
            nonlocal open_group, first, pivot
            at = 0
            if open_group != sig:
                open_group, first, pivot = sig, ids[0], (ids[0], n[0])
            while at < len(ids):
                end = at + int(np.searchsorted(percent * n[at:], 100 * pivot[1], side="right"))
                if pivots:
                    out.append((False, ids[at:end], np.full(end - at, pivot[0]), n[at:end]))
                if end < len(ids):
                    pivot = (ids[end], n[end])
                at = end
            out.append((True, np.full(len(ids), sig), ids, np.full(len(ids), first) if pivots else n))

        def groups(sig: np.ndarray, ids: np.ndarray, n: np.ndarray, ends: bool) -> tuple[list, list[np.ndarray]]:
            out: list = []
            start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            size = np.diff(np.append(start, len(sig)))
            keep = [a[:0] for a in (sig, ids, n)]
            whole = np.ones(len(start), bool)
            if not ends and size[-1] <= SMALL and sig[-1] != open_group:
                whole[-1] = False
                keep = [a[start[-1] :] for a in (sig, ids, n)]
            for g in np.flatnonzero(whole & ((size > SMALL) | (sig[start] == (open_group if open_group is not None else sig[start] + 1)))):
                star(sig[start[g]], ids[start[g] : start[g] + size[g]], n[start[g] : start[g] + size[g]], out)
                whole[g] = False
            for s in range(2, SMALL + 1):
                at = start[whole & (size == s)]
                if len(at):
                    index = at[:, None] + np.arange(s)
                    one, two = all_pairs(ids[index], n[index], percent)
                    out.append((False, one, two, one))
            return out, keep

        def packed(out: list) -> pa.RecordBatch:
            pairs = [o for o in out if not o[0] and len(o[1])]
            both = np.concatenate([np.stack([np.minimum(o[1], o[2]), np.maximum(o[1], o[2])], 1) for o in pairs]) if pairs else np.empty((0, 2), np.int64)
            both = np.unique(both[both[:, 0] != both[:, 1]], axis=0)
            large = [np.concatenate([o[i] for o in out if o[0]] or [np.empty(0, np.int64)]) for i in (1, 2, 3)]
            n = len(both)
            hot = pa.array(np.arange(n + len(large[0])) >= n)
            x, y = np.concatenate([both[:, 0], large[0]]), np.concatenate([both[:, 1], large[1]])
            return batch_of(schema, [hot, pa.array(x), pa.array(y), pa.array(np.concatenate([np.zeros(n, np.int64), large[2]]))])

        for batch in batches:
            if not batch.num_rows:
                continue
            named = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            sig, ids, n = (batch.column(i).to_numpy() for i in range(3))
            held = [np.concatenate([h, a[~named]]) for h, a in zip(held, (sig, ids, n), strict=True)]
            out, held = groups(*held, False) if len(held[0]) else ([], held)
            if named.any():
                out.append((True, batch.column(3).filter(pa.array(named)).to_numpy(), ids[named], n[named]))
            if out:
                yield packed(out)
        if len(held[0]):
            out, _ = groups(*held, True)
            if out:
                yield packed(out)

    ordered = rows.repartition("signature").sortWithinPartitions("signature", "n", "doc_id")
    return in_arrow(ordered, run, "hot boolean, x long, y long, n long")


def near_enough(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) those that their sizes and sketches don't rule out; exact links are never ruled out."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            one, two = (batch.column(i).to_pylist() for i in (3, 5))
            size = np.array([min(len(x), len(y)) for x, y in zip(one, two, strict=True)])
            apart = np.zeros(len(n), np.int64)
            for s in np.unique(size):
                at = np.flatnonzero(size == s)
                apart[at] = np.bitwise_count(folded([one[i] for i in at], s) ^ folded([two[i] for i in at], s)).sum(1, dtype=np.int64)
            fit = n + m - 2 * least_overlap(n, m, percent) >= apart
            yield batch_of(schema, [batch.column(0).filter(pa.array(fit)), batch.column(1).filter(pa.array(fit))])

    own = sets.select("doc_id", "n", "sketch")
    both = pairs.join(own.toDF("a", "n", "sketch_a"), "a").join(own.toDF("b", "m", "sketch_b"), "b")
    return in_arrow(both.select("a", "b", "n", "sketch_a", "m", "sketch_b"), run, "a long, b long")


def filter_of(ids: DataFrame) -> np.ndarray:
    """A one-hash Bloom filter of FILTER bits of the numbers in column doc_id, made by the tasks and joined here."""
    schema = pa.schema([("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER, bool)
        for batch in batches:
            bits[_places(batch.column(0).to_numpy())] = True
        yield batch_of(schema, [[np.packbits(bits).tobytes()]])

    out = np.zeros(FILTER // 8, np.uint8)
    for row in in_arrow(ids.select("doc_id").coalesce(16), run, "bits binary").toLocalIterator():
        out |= np.frombuffer(row.bits, np.uint8)
    return out


def _places(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(FILTER)).astype(np.int64)


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is wanted, and some others.

    The wanted numbers go along as a filter of a fixed size, so that no text is moved; joins leave out the others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filter_of(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            if batch.num_rows:
                ids = batch.column(0)
                yield batch.filter(pa.array(bits[_places(ids.fill_null(0).to_numpy())] & ids.is_valid().to_numpy(zero_copy_only=False)))

    return in_arrow(docs, run, docs.schema)


def moves_of(pairs: DataFrame) -> DataFrame:
    """(hub, doc_id, copy, turn) of pairs (a, b), for links(), dealt by one task."""
    schema = pa.schema([("hub", pa.int64()), ("doc_id", pa.int64()), ("copy", pa.int64()), ("turn", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.stack([b.column(i).to_numpy() for i in range(2)]) for b in batches if b.num_rows]
        if not rows:
            return
        a, b = np.unique(np.concatenate(rows, 1), axis=1)
        _, at, seen = np.unique(np.concatenate([a, b]), return_inverse=True, return_counts=True)
        n, m = seen[at[: len(a)]], seen[at[len(a) :]]
        hub, doc = np.where(n >= m, a, b), np.where(n >= m, b, a)
        copy = (mix(doc.view(np.uint64)) % (-(-np.maximum(n, m) // HUB)).astype(np.uint64)).astype(np.int64)
        own, own_copy = np.unique(np.stack([hub, copy]), axis=1)
        turn = np.arange(len(own) + len(doc)) >= len(own)
        yield batch_of(schema, [pa.array(np.concatenate(c)) for c in ((own, hub), (own, doc), (own_copy, copy))] + [pa.array(turn.astype(np.int32))])

    return in_arrow(pairs.repartition(1), run, "hub long, doc_id long, copy long, turn int")


def links(pairs: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """Of pairs (a, b) those whose whole sets are similar enough.

    The document of a pair that has more partners is its hub. The others' texts move to it, HUB of them to each copy of
    it, and a task holds a hub's set and a few texts. An id with several texts has several sets; it counts as linked
    where any of them is.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    if pairs.count() <= BROADCAST:
        moves = written(moves_of(pairs), "moves")
    else:
        pairs = pairs.distinct()
        seen = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").count()
        sides = pairs.join(seen.toDF("a", "n"), "a").join(seen.toDF("b", "m"), "b")
        first = F.col("n") >= F.col("m")
        stars = sides.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("doc_id"), F.greatest("n", "m").alias("n"))
        stars = stars.select("hub", "doc_id", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / HUB)).alias("copy"))
        hubs = stars.select("hub", "copy").distinct().select("hub", F.col("hub").alias("doc_id"), "copy", F.lit(0).alias("turn"))
        moves = written(hubs.unionByName(stars.withColumn("turn", F.lit(1))), "moves")
    few = moves.count() <= BROADCAST
    moved = texts.join(F.broadcast(moves) if few else moves, "doc_id").select("hub", "copy", "turn", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own = None, []
        for batch in pieces(batches, "text", PART):
            bounds, hashes = shingle_sets([(t or "").encode().lower() for t in batch.column(4).to_pylist()], k)
            out = []
            for i, (hub, copy, turn, doc) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)):
                found = hashes[bounds[i] : bounds[i + 1]]
                if (hub, copy) != current:
                    current, own = (hub, copy), []
                if not turn:
                    own.append(found.copy())
                elif len(found) and any(linked(found, x, percent) for x in own):
                    out.append((min(hub, doc), max(hub, doc)))
            if out:
                yield batch_of(schema, [[o[i] for o in out] for i in (0, 1)])

    return in_arrow(moved.repartition("hub", "copy").sortWithinPartitions("hub", "copy", "turn"), run, "a long, b long").distinct()


def linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sets, as ascending hashes, are similar enough."""
    if not len(two) or 100 * min(len(one), len(two)) < percent * max(len(one), len(two)):
        return False
    at = np.searchsorted(two, one)
    common = int(np.count_nonzero(two[np.minimum(at, len(two) - 1)] == one))
    return 100 * common >= percent * (len(one) + len(two) - common)


def join(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; see the contract of op9.

    Words are split at ASCII white space after lower-casing A-Z. Sets with intersection x 100 >= percent x union are
    linked, where percent is over 50; component_id is the smallest doc_id that links reach. Null, empty and blank texts
    have no shingle and no link. Rows without doc_id have no component; rows that share one count as one document and
    are linked. Repeated rows stay. Sets are compared as 64-bit hashes of their shingles.
    """
    if not 50 < percent <= 100:
        raise ValueError(f"percent must be over 50 and at most 100, not {percent}")
    spark = docs.sparkSession
    base = project(docs, doc_id="long", text="string")
    rows = written(set_rows(base, k), "sets")
    sets = rows.where("n is not null").drop("token", "seen")
    counts = rows.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= SEEN)
    frequent = np.sort(counts.orderBy(F.desc("seen"), "token").limit(MOST_FREQUENT).select("token").toArrow()["token"].to_numpy().view(np.uint64))
    real = sets.where("doc_id is not null and n > 0")
    classes = real.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"))
    member = written(real.join(classes, ["s1", "s2", "n"]).select("doc_id", "rep"), "classes")
    # A document stands for its class; one that shares its id with another text is a class of each.
    reps = member.where("doc_id = rep").select("doc_id").distinct()
    others = member.where("doc_id <> rep").select("doc_id").distinct().join(reps, "doc_id", "left_anti")
    every = signatures(base, k, percent, frequent)
    every = every.join(F.broadcast(others), "doc_id", "left_anti") if others.count() <= BROADCAST else every.join(reps, "doc_id", "left_semi")
    one = sets.where("doc_id is not null").select("doc_id", "n", "sketch").distinct()
    single = written(candidates(every.select("signature", "doc_id", "n", "token"), percent, False), "candidates")
    release(spark)
    hot = single.where("hot").select(F.col("x").alias("token"), F.col("y").alias("doc_id"), "n")
    double = written(candidates(combined(hot, percent), percent, True), "combinations")
    release(spark)
    pairs = single.where("not hot").select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(double.where("not hot").select(F.col("x").alias("a"), F.col("y").alias("b"))).distinct()
    pairs = written(near_enough(pairs, one, percent), "pairs")
    apart = written(unlike_groups(double.where("hot").select(F.col("x").alias("signature"), F.col("y").alias("id"), F.col("n").alias("first"))), "groups")
    rest = written(merged_groups(apart), "groups")
    dropped(single, double, apart)
    same = member.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    grouped = rest.select(F.col("id").alias("doc_id")).distinct()
    own = written(one.join(F.broadcast(grouped) if rest.count() <= BROADCAST else grouped, "doc_id", "left_semi"), "own")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).unionByName(rest.select(F.col("id").alias("doc_id"))).distinct()
    texts = written(texts_of(base, wanted), "texts")
    found = written(links(pairs, texts, percent, k), "links")
    known = components(found.unionByName(same))
    dropped(found, pairs)
    release(spark)
    # Large groups: pairs of different components, first of each member and its nearest ones, while these link any.
    linking = True
    while True:
        most = NEAREST if linking and rest.count() > FEW else None
        labelled = rest.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
        split = labelled.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("low <> high").select("signature", "size")
        near = written(cross_pairs(labelled.join(split, "signature"), own, percent, most), "near")
        pairs = near.where("signature is null").select("a", "b")
        more = written(links(pairs, texts, percent, k), "links")
        linking = not more.isEmpty()
        if linking:
            before, known = known, extended(known, more)
            dropped(before)
        before, rest = rest, written(near.where("signature is not null").select("signature", F.col("a").alias("id")).distinct(), "groups")
        dropped(before, more, near)
        release(spark)
        if most is None or rest.isEmpty():
            break
    dropped(texts, rest, own)
    out = sets.select("doc_id", F.col("n").alias("n_shingles")).join(known.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def unlike_groups(rows: DataFrame) -> DataFrame:
    """Of (signature, id, first) one signature of all that have the same members, told by their number and two sums of hashes."""
    print_of = rows.groupBy("signature").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    return rows.join(print_of.groupBy("c", "x", "y").agg(F.min("signature").alias("signature")).select("signature"), "signature", "left_semi")


def merged_groups(rows: DataFrame) -> DataFrame:
    """(signature, id) of groups (signature, id, first): those with one first member are one group.

    Copies have as many groups as combinations of their tokens, with nearly the same members. A group's pairs are in the
    merged one, so none is lost. Where it has more than twice as many pairs as its parts together, these stay apart.
    """
    size = rows.groupBy("first", "signature").agg(F.count("*").cast("double").alias("c")).groupBy("first").agg(F.sum(F.col("c") * F.col("c")).alias("pairs"))
    once = rows.select("first", "id").distinct()
    whole = once.groupBy("first").agg(F.count("*").cast("double").alias("u")).join(size, "first").select("first", (F.col("u") * F.col("u") <= 2 * F.col("pairs")).alias("whole"))
    one = once.join(whole.where("whole"), "first", "left_semi").select(F.xxhash64("first").alias("signature"), "id")
    return one.unionByName(rows.join(whole.where("not whole"), "first", "left_semi").select("signature", "id"))


def cross_pairs(rows: DataFrame, sets: DataFrame, percent: int, most: int | None) -> DataFrame:
    """Of large groups' members (signature, id, component, size of the group), two kinds of rows (signature, a, b): with
    no signature, pairs of members of different components that sizes and sketches allow, of each member those with its
    `most` nearest smaller ones; and (signature, id, null) of members with more such partners, and of these.

    A group is dealt out in pairs of blocks of about BLOCK members; reads sorted rows and holds one such pair.
    """
    schema = pa.schema([("signature", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    full = rows.join(sets.withColumnRenamed("doc_id", "id"), "id").select("signature", "id", "component", "n", "sketch", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    full = full.select("signature", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "id", "component", "n", "sketch", "own")

    def of_group(sig: int, cross: bool, ids: np.ndarray, part: np.ndarray, n: np.ndarray, own: np.ndarray, bits: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if (part == part[0]).all() or cross and (own == own[0]).all():
            return
        sizes = np.array([len(b) for b in bits])
        level, words = 0, np.empty((0, 0), np.uint64)
        start, at = 0, 0
        while at < len(ids):
            start = int(np.searchsorted(100 * n, percent * n[at], side="left"))
            if sizes[start] != level:  # sizes ascend along a group
                level, first = int(sizes[start]), int(np.searchsorted(sizes, sizes[start]))
                words = folded(bits[first:], level)
            end = min(len(ids), at + max(1, (1 << 19) // ((len(ids) - start) * (level // 8))))
            end = max(at + 1, min(end, int(np.searchsorted(n, n[at] + n[at] // 50, side="right"))))
            i, j = np.arange(at, end)[:, None], np.arange(start, end)[None, :]
            fit = (j < i) & (100 * n[j] >= percent * n[i]) & (part[j] != part[i])
            if cross:
                fit &= own[j] != own[i]
            row, col = np.nonzero(fit)
            if len(row):
                row, col = row + at, col + start
                apart = np.concatenate([np.bitwise_count(words[row[p : p + 65536] - first] ^ words[col[p : p + 65536] - first]).sum(1, dtype=np.int64) for p in range(0, len(row), 65536)])
                keep = n[row] + n[col] - 2 * least_overlap(n[row], n[col], percent) >= apart
                row, col, apart = row[keep], col[keep], apart[keep]
                order = np.lexsort((col, apart, row))
                row, col = row[order], col[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
                close = np.full(len(row), True) if most is None else rank < most
                yield np.full(close.sum(), -1), np.minimum(ids[row], ids[col])[close], np.maximum(ids[row], ids[col])[close]
                if not close.all():
                    again = np.isin(row, row[~close])
                    stay = np.unique(np.concatenate([ids[row[again]], ids[col[again]]]))
                    yield np.full(len(stay), sig), stay, np.full(len(stay), -1)
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = [np.empty(0, np.int64)] * 7 + [[]]  # signature, low, high, id, component, n, own, sketch

        def out_of(rows: list) -> Iterator[pa.RecordBatch]:
            fresh = np.any([np.diff(r, prepend=r[:1] - 1) != 0 for r in rows[:3]], axis=0)
            cuts = np.append(np.flatnonzero(fresh), len(fresh))
            out, size = [], 0
            for a, b in zip(cuts[:-1], cuts[1:]):
                for sig, one, two in of_group(int(rows[0][a]), rows[1][a] != rows[2][a], *(r[a:b] for r in rows[3:])):
                    out.append((sig, one, two))
                    size += len(one)
                if size > 1 << 16:
                    yield packed(out)
                    out, size = [], 0
            if out:
                yield packed(out)

        def packed(out: list) -> pa.RecordBatch:
            rows = np.unique(np.stack([np.concatenate(c) for c in list(zip(*out, strict=True))[:3]], 1), axis=0)
            sig, one, two = (np.ascontiguousarray(rows[:, i]) for i in range(3))
            stays = sig != -1
            return batch_of(schema, [pa.array(sig, mask=~stays), pa.array(one), pa.array(two, mask=stays)])

        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = [batch.column(i).to_numpy() for i in range(7)]
            rows = [np.concatenate([h, f]) for h, f in zip(held, fresh)] + [held[7] + batch.column(7).to_pylist()]
            cut = int(np.flatnonzero((rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]) & (rows[2] == rows[2][-1]))[0])
            held = [r[cut:] for r in rows]
            if cut:
                yield from out_of([r[:cut] for r in rows])
        if len(held[0]):
            yield from out_of(held)

    full = full.select("signature", "low", "high", "id", "component", "n", "own", "sketch")
    return in_arrow(full.repartition("signature", "low", "high").sortWithinPartitions("signature", "low", "high", "n", "id"), run, "signature long, a long, b long")


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns, without those whose group of near copies holds a smaller doc_id.

    Rows without doc_id stay, and rows that share one stay or go together.
    """
    gone = written(join(docs, k, percent).where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    at = column_at(docs, "doc_id")
    plain = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    few = gone.count() <= BROADCAST  # else both sides move
    return plain.join(F.broadcast(gone) if few else gone, F.col(f"_{at}").cast("long") == F.col("doc_id"), "left_anti").toDF(*docs.columns)
