import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from heddle.llm import suffix_dedup as S

from .cases import SCHEMA, awkward, empty, prose


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=6).map(str.encode) | st.text("ab", max_size=12).map(str.encode), min_size=1, max_size=8))
def test_construction_equals_sorting(texts):
    suffixes = sorted((t[s:], i, s) for i, t in enumerate(texts) for s in range(len(t)))
    common = []
    for (a, *_), (b, *_) in zip([(b"",), *suffixes], suffixes, strict=False):
        n = 0
        while n < min(len(a), len(b), 5) and a[n] == b[n]:
            n += 1
        common.append(n)
    owner, start, got = S.sorted_suffixes(texts, 5)
    assert [(i, s) for _, i, s in suffixes] == list(zip(owner.tolist(), start.tolist(), strict=True))
    assert got.tolist() == common


def brute(rows, width=100):
    """Every window of the input, in order of document and start."""
    seen, gone = {}, []
    ordered = sorted(((S.NO_ID if d is None else d), k, (t or "").encode()) for k, (d, t, *_) in enumerate(rows))
    for d, _, data in ordered:
        for i in range(len(data) - width + 1):
            w = data[i : i + width]
            seen[w] = min(seen.get(w, (d, i)), (d, i))
    by_key = {}
    for d, _, data in ordered:
        by_key.setdefault(d, set()).update(i for i in range(len(data) - width + 1) if seen[data[i : i + width]] < (d, i))
    for d, t, *_ in rows:
        data, covered = (t or "").encode(), set()
        for i in by_key[S.NO_ID if d is None else d]:
            if i + width <= len(data) and data[i : i + width] in seen and seen[data[i : i + width]] < ((S.NO_ID if d is None else d), i):
                covered.update(range(i, i + width))
        runs = sum(i - 1 not in covered for i in covered)
        gone.append((d, len(data), len(covered), runs, hashlib.sha256(bytes(b for i, b in enumerate(data) if i not in covered)).hexdigest()))
    return sorted(gone, key=repr)


def collection():
    rng = random.Random(11)
    shared = [prose(rng, 60) for _ in range(4)]
    texts = []
    for i in range(60):
        t = f"{prose(rng, rng.randint(0, 30))} {rng.choice(shared)} {prose(rng, rng.randint(0, 30))}"
        if i % 3 == 0:
            at = rng.randrange(len(t))
            t = t[:at] + "#" + t[at + 1 :]
        texts.append(t)
    texts += [texts[0], texts[0], "z" * 500, "z" * 130, shared[0] * 3, "é" * 120]
    return [(i, t, None, None, 0) for i, t in enumerate(texts)]


def test_equals_brute_force(spark):
    rows = collection()
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, S.digest(S.remove_repeats(docs)).collect()), key=repr) == brute(rows)
    assert sorted(map(tuple, S.digest(S.remove_repeats(docs.repartition(7))).collect()), key=repr) == brute(rows)


def test_hot_groups_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 3)
    rows = collection()
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, S.digest(S.remove_repeats(docs)).collect()), key=repr) == brute(rows)
    keys, base, parts = S.chunks([1, 2], [b"x" * 10, b"y" * (2 * S.CHUNK + 50)], 100)
    assert keys.tolist() == [1, 2, 2] and base.tolist() == [0, 0, S.CHUNK] and len(parts[2]) == S.CHUNK + 50


def test_awkward(spark):
    rows, clashing = awkward(spark)
    assert S.remove_repeats(clashing).count() == len(rows)
    rows = [r for r in rows if not (r[0] == 0 and r[1].startswith("another"))]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, S.digest(S.remove_repeats(docs)).collect()), key=repr) == brute(rows)
    assert S.digest(S.remove_repeats(empty(spark))).count() == 0


def test_texts_beyond_the_bits_of_a_place(spark, monkeypatch):
    """A text of more bytes than a place has bits for is worked on in parts; repeats far into it are found."""
    monkeypatch.setattr(S, "CHUNK", 4_000)
    monkeypatch.setattr(S, "PLACE_BITS", 13)
    rng = random.Random(17)
    shared = prose(rng, 40)
    rows = [(0, f"{prose(rng, 30)} {shared}", None, None, 0), (1, f"{prose(rng, 6_000)} {shared} {prose(rng, 100)} {shared}", None, None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, S.digest(S.remove_repeats(docs)).collect()), key=repr) == brute(rows)
    with pytest.raises(ValueError):
        S.segments([b"x" * (1 << 13)], 100)


def test_segments_do_not_depend_on_what_is_joined():
    """Segments of a text beyond the first 2^24 bytes of a batch equal those of the text alone."""
    rng = np.random.default_rng(3)
    parts = [rng.integers(97, 107, S.CHUNK).astype(np.uint8).tobytes() for _ in range(5)]
    together, alone = S.segments(parts, 100), S.segments(parts[4:], 100)
    last = together[0] == 4
    assert all((a[last] == b).all() for a, b in zip(together[1:], alone[1:], strict=True)) and (together[3] >= 0).all()


def test_joined_runs_cover_the_same_bytes():
    """Whatever batch a document's runs are split into, the joined ones cover the same bytes of it, and texts stay."""
    rng = random.Random(5)
    rows = []
    for key in range(6):
        rows += [(key, False, None, None, key, "x" * 40)] * (key % 3)
        rows += [(key, True, s, s + rng.randint(1, 6), None, None) for s in sorted(rng.randrange(40) for _ in range(rng.randint(0, 12)))]
    rows.append((6, True, 0, 3, None, None))
    schema = S.pa.schema([("key", S.pa.int64()), ("is_gone", S.pa.bool_()), ("start", S.pa.int64()), ("end", S.pa.int64()), ("doc_id", S.pa.int64()), ("text", S.pa.string())])
    covered = lambda rs: {(r[0], b) for r in rs if r[1] for b in range(r[2], r[3])}
    for size in (1, 2, 5, len(rows)):
        got = []
        for at in range(0, len(rows), size):
            batch = S.joined_runs(S.batch_of(schema, [list(c) for c in zip(*rows[at : at + size], strict=True)]))
            got += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        assert covered(got) == covered(rows)
        assert [r[4:] for r in got if not r[1]] == [r[4:] for r in rows if not r[1]]
    runs = [r for r in got if r[1]]
    assert all(a[0] != b[0] or a[3] < b[2] for a, b in zip(runs, runs[1:], strict=False))
