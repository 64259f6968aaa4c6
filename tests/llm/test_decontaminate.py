import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from heddle.llm import decontaminate as D

from .cases import SCHEMA, awkward, empty, prose


def distance(item, text):
    """Least edit distance of item to any substring, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(last + (a != b), row[j] + 1, row[j - 1] + 1)
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=20))
def test_edit_distance(item, region):
    exact = distance(item, region)
    assert D.edit_distance_within(item, region, len(item)) == exact
    if exact:
        assert D.edit_distance_within(item, region, exact - 1) is None


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        chars[at : at + 1] = rng.choice([[], [rng.choice("abcdefghij")], [chars[at], rng.choice("abcdefghij")]])
    return "".join(chars)


def test_leaks_equal_brute_force(spark):
    rng = random.Random(8)
    items = [prose(rng, 25) for _ in range(12)] + ["short one", "", None, "!!!", "tiny x"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = [f"{prose(rng, 40)} {edited(rng, items[i % 12], (i % 6) * 2)} {prose(rng, 40)}" for i in range(36)] + [prose(rng, 90) for _ in range(20)] + ["It is a SHORT,  one!"]
    frame = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(docs)], SCHEMA)
    got = {(r.doc_id, r.item_id): r.distance for r in D.leaks(frame, bench).collect()}
    expected = {}
    for d, text in enumerate(map(D.normalised, docs)):
        for i, item in enumerate(map(D.normalised, items)):
            if len(item) >= D.SHORT and (n := distance(item, text)) <= int(0.2 * len(item)):
                expected[d, i] = n
            elif 0 < len(item) < D.SHORT and f" {item} " in f" {text} ":
                expected[d, i] = 0
    assert got == expected
    clean = {r.doc_id for r in D.without_leaks(frame, bench).collect()}
    assert clean == set(range(len(docs))) - {d for d, _ in expected}
    blocks = {(r.doc_id, r.item_id): r.distance for r in D.leaks(frame, bench, block_chars=300).collect()}
    assert blocks == expected
    several = {(r.doc_id, r.item_id): r.distance for r in D.leaks(frame, bench, block_chars=300, pass_chars=700).collect()}
    assert several == expected
    assert {r.doc_id for r in D.without_leaks(frame, bench, pass_chars=700).collect()} == clean


def test_awkward(spark):
    rows, docs = awkward(spark)
    bench = spark.createDataFrame([(0, rows[0][1][:200]), (1, None), (None, "x"), (2, "")], "item_id long, text string")
    assert {r.doc_id for r in D.leaks(docs, bench).collect()} == {0, 1, 2, 9, None}
    assert D.without_leaks(docs, bench).columns == docs.columns
    assert D.leaks(empty(spark), bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.leaks(docs, none).count() == 0 and D.without_leaks(docs, none).count() == len(rows)


@pytest.mark.parametrize("size", [16, 32, 64, 80, 150, 450])
def test_recall_at_the_limit(size):
    """Items of each size class are found at 20 % of edits, which is all that the operator allows."""
    rng = random.Random(size)
    items = [prose(rng, size // 3)[:size].strip().ljust(size, "z") for _ in range(60)]
    index = D.Index(list(enumerate(items)), 0.2, 0.95)
    texts = [f"{prose(rng, 40)} {edited(rng, t, int(0.2 * size))} {prose(rng, 40)}" for t in items]
    found = {(d, i) for d, i, _, _ in index.search(texts)}
    assert sum((i, i) in found for i in range(len(items))) >= 0.95 * len(items)


def test_an_item_that_repeats_itself():
    """Equal windows of one item are indexed once, and collisions of a long text with it are looked at in bounded parts."""
    item = " ".join(["word"] * 200)
    index = D.Index([(7, item)], 0.2, 0.95)
    (size_class,) = (c for _, c in index.groups.values())
    assert len(size_class.size) < 200 < len(size_class.item)
    found = index.search([" ".join(["word"] * 4000), " ".join(["other"] * 4000), item[5:-5] + " end"])
    assert {(d, i) for d, i, _, _ in found} == {(0, 7), (2, 7)}


def test_very_long_text():
    rng = random.Random(4)
    item = prose(rng, 30)
    text = f"{prose(rng, 250_000)} {item} {prose(rng, 100)}"
    assert [(d, i) for d, i, n, _ in D.Index([(1, item)], 0.2, 0.95).search(["x", text]) if not n] == [(1, 1)]
