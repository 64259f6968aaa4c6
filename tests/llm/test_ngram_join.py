import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from heddle.llm import components as C
from heddle.llm import ngram_join as J
from heddle.llm.components import components

from .cases import SCHEMA, awkward, empty, prose


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent):
    sets = [shingles(r[1], k) for r in rows]
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, *_) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            if a == b or 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted(((r[0], len(s), None if r[0] is None else find(r[0])) for r, s in zip(rows, sets, strict=True)), key=repr)


def family(rng, n, words=60):
    base = prose(rng, words).split()
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = prose(rng, 1)
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize(("k", "percent", "small", "paired"), [(3, 90, 16, 2000), (3, 90, 3, 2000), (5, 80, 3, 2000), (3, 80, 2, 40), (2, 60, 4, 30)])
def test_equals_brute_force(spark, monkeypatch, k, percent, small, paired):
    rng = random.Random(k * percent)
    texts = family(rng, 40) + family(rng, 12, 40) + [prose(rng, rng.randint(1, 60)) for _ in range(40)] + ["a", "a b", "a b", "A B", "b a", "", "c"]
    line = prose(rng, 12)
    texts += [f"{prose(rng, 30)} {line} {prose(rng, 30)}" for _ in range(25)]
    rng.shuffle(texts)
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    monkeypatch.setattr(J, "SMALL", small)
    monkeypatch.setattr(J, "PAIRED", paired)
    monkeypatch.setattr(J, "SKETCH", (64, 256) if small < 16 else J.SKETCH)
    monkeypatch.setattr(J, "BLOCK", 7)
    monkeypatch.setattr(J, "NEAREST", small % 3 + 1)
    monkeypatch.setattr(J, "HUB", 5)
    got = J.join(spark.createDataFrame(rows, SCHEMA), k, percent)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, k, percent)


def test_one_of_each(spark):
    rng = random.Random(1)
    texts = family(rng, 8, 200) + [prose(rng, 50) for _ in range(5)]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    kept = {r.doc_id for r in J.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept == {c for _, _, c in brute(rows, 5, 80)}


def test_low_similarity_is_refused(spark):
    with pytest.raises(ValueError):
        J.join(empty(spark), 3, 50)


def test_a_large_group_of_unlike_sets(spark, monkeypatch):
    """All share their frequent tokens' combinations, but only some pairs are similar enough."""
    monkeypatch.setattr(J, "SMALL", 2)
    monkeypatch.setattr(J, "BLOCK", 16)
    rng = random.Random(9)
    base = prose(rng, 100)
    texts = [f"{base} {prose(rng, 9)}" for _ in range(60)]
    texts += [f"{t} {prose(rng, 1)}" for t in texts[::7]]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    got = J.join(spark.createDataFrame(rows, SCHEMA), 3, 90)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 3, 90)


def test_combinations_of_the_same_copies_are_one_group(spark, monkeypatch):
    """Near copies share many combinations of tokens; what later steps read grows with the copies, not with these."""
    read, cross_pairs = [], J.cross_pairs
    monkeypatch.setattr(J, "cross_pairs", lambda rows, *rest: read.append(rows.count()) or cross_pairs(rows, *rest))
    rng = random.Random(4)
    base, texts = prose(rng, 300).split(), []
    for i in range(60):
        own = list(base)
        for at in rng.sample(range(300), 6):
            own[at] = f"other{i}x{at}"
        texts.append(" ".join(own))
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    got = J.join(spark.createDataFrame(rows, SCHEMA), 3, 90)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 3, 90)
    assert max(read) <= 10 * len(rows), read


def test_merged_groups_lose_no_pair(spark):
    """Groups with one first member become one, unless that has far more pairs than they."""
    groups = {1: (0, {0, 1, 2, 3}), 2: (0, {0, 1, 2, 4}), 3: (5, {5, 6, 7}), 4: (8, {8, 9, 10}), 5: (8, {8, 11, 12}), 6: (8, {8, 13, 14}), 7: (8, {8, 15, 16})}
    rows = [(g, i, first) for g, (first, ids) in groups.items() for i in ids]
    out = {}
    for r in J.merged_groups(spark.createDataFrame(rows, "signature long, id long, first long")).collect():
        out.setdefault(r.signature, []).append(r.id)
    assert sorted(map(sorted, out.values())) == [[0, 1, 2, 3, 4], [5, 6, 7], [8, 9, 10], [8, 11, 12], [8, 13, 14], [8, 15, 16]]


def test_awkward(spark):
    rows, docs = awkward(spark)
    assert sorted(map(tuple, J.join(docs).collect()), key=repr) == brute(rows, 3, 90)
    assert J.one_of_each(docs).columns == docs.columns
    assert J.join(empty(spark)).count() == 0 and J.one_of_each(empty(spark)).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, links):
    root = {x: x for pair in links for x in pair if pair[0] != pair[1]}
    for _ in root:
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == root


def test_few_links_take_one_task(spark, monkeypatch):
    """A long path and its extension are solved at once, not in steps over all links that each write a table."""
    tables, written = [], C.written
    monkeypatch.setattr(C, "written", lambda df, name: tables.append(name) or written(df, name))
    path = [(i, i + 1) for i in range(300)] + [(1000, 1001)]
    known = components(spark.createDataFrame(path, "a long, b long"))
    more = C.extended(known, spark.createDataFrame([(300, 1001), (5, 2000)], "a long, b long"))
    assert {(r.id, r.component) for r in more.collect()} == {(i, 0) for i in [*range(301), 1000, 1001, 2000]}
    assert tables == ["edges", "components", "components"]


def test_steps_and_rounds_equal_one_task(spark, monkeypatch):
    """What is too large for one task, and for all pairs at once, goes in steps and rounds, with the same result."""
    rng = random.Random(19)
    base = prose(rng, 100)
    texts = [t for _ in range(3) for t in family(rng, 25)] + [f"{base} {prose(rng, 9)}" for _ in range(40)]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(J, "SMALL", 2)
    monkeypatch.setattr(J, "BLOCK", 16)
    for large in (False, True):
        if large:
            monkeypatch.setattr(J, "FEW", 0)
            monkeypatch.setattr(J, "BROADCAST", -1)
            monkeypatch.setattr(C, "ONE_TASK", -1)
        assert sorted(map(tuple, J.join(docs).collect()), key=repr) == brute(rows, 3, 90)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-9, 20), st.integers(-9, 20)), max_size=30))
def test_least_reached(links):
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    nodes, least = C.least_reached(*np.array(links, np.int64).reshape(-1, 2).T)
    assert dict(zip(nodes.tolist(), least.tolist())) == root
