import hashlib
import random

import numpy as np

from heddle.llm import fingerprint as fp

from .cases import SCHEMA, awkward, empty, prose


def brute_ranks(data):
    out = []
    for i in range(len(data) - fp.WINDOW + 1):
        counts = np.unique(np.frombuffer(data[i : i + fp.WINDOW], np.uint8), return_counts=True)[1]
        bits = float(-(counts / fp.WINDOW * np.log2(counts / fp.WINDOW)).sum())
        out.append(fp._RARITY[round(bits / np.log2(fp.WINDOW) * 1024)])
    return out


def brute_features(data):
    """Positions that win at least POPULAR runs of 32 windows, text by text."""
    ranks = brute_ranks(data)
    votes = [0] * len(ranks)
    for i in range(-(fp.WINDOW - 1), len(ranks)):
        own = [(r, k) for k, r in enumerate(ranks) if i <= k < i + fp.WINDOW and r < fp._NONE]
        if own:
            votes[min(own)[1]] += 1
    return [k for k, v in enumerate(votes) if v >= fp.POPULAR]


def test_features_equal_brute_force():
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(20, 60)).encode() for _ in range(6)] + [b"a" * 200, prose(rng, 30, "äöü").encode()]
    starts = np.cumsum([0] + [len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    ranks = fp.window_ranks(data)
    for t, s in zip(texts, starts, strict=False):
        assert np.abs(ranks[s : s + len(t) - fp.WINDOW + 1] - brute_ranks(t)).max(initial=0) <= 12  # of 1000: rounding of the entropy
    at, _ = fp.features(data, starts)
    for t, s in zip(texts, starts, strict=False):
        mine, theirs = {int(a - s) for a in at if s <= a < s + len(t)}, set(brute_features(t))
        assert len(mine ^ theirs) <= 0.2 * max(1, len(mine | theirs))


def test_batches_do_not_matter():
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(1, 400)).encode() for _ in range(30)]
    together = fp.digests(texts)
    for t, d in zip(texts, together, strict=True):
        assert np.array_equal(fp.digests([t])[0], d)
        assert np.array_equal(fp.decoded(fp.encoded(d)), d)


def test_likeness():
    rng = random.Random(5)
    a, b = prose(rng, 800).encode(), prose(rng, 800).encode()
    near = a[: len(a) * 3 // 4] + b[: len(b) // 4]
    da, db, dn, none = fp.digests([a, b, near, b""])
    assert fp.likeness(da, da) == 1 and fp.likeness(none, none) == 1 and fp.likeness(da, none) == 0
    assert fp.likeness(da, dn) > 0.4 and fp.likeness(da, db) < 0.1


def brute_rows(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for i, (d, t, *_) in enumerate(rows):
        t, n = t or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(t) // 4
        e = t[: len(t) - k] + n[:k]
        da, de, dn = fp.digests([t.encode(), e.encode(), n.encode()])
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), fp.encoded(da), fp.encoded(de), fp.likeness(da, de), fp.likeness(da, dn)))
    return sorted(out, key=repr)


def test_neighbours_equal_brute_force(spark):
    rng = random.Random(7)
    rows = [(i * 3, prose(rng, rng.randint(0, 80)), None, None, 0) for i in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for size in (1000, 7):
        assert sorted(map(tuple, fp.compare_neighbours(docs, rows_per_bucket=size).collect()), key=repr) == brute_rows(rows)


def test_awkward(spark):
    rows, docs = awkward(spark)
    assert sorted(map(tuple, fp.compare_neighbours(docs, rows_per_bucket=3).collect()), key=repr) == brute_rows(rows)
    assert fp.compare_neighbours(empty(spark)).count() == 0
    assert fp.fingerprint(docs).count() == len(rows)
    one = spark.createDataFrame([rows[0]], SCHEMA)
    assert fp.compare_neighbours(one).first().near_next == 1


def test_long_texts_of_one_or_two_symbols_are_told_apart():
    a, b, c, empty, again = fp.digests([b"a" * 300, b"b" * 300, b"xy" * 200, b"", b"a" * 300])
    assert len(a) and len(b) and len(c) and not len(empty)
    assert fp.likeness(a, again) == 1.0 and max(fp.likeness(a, b), fp.likeness(a, c), fp.likeness(a, empty)) < 1.0
