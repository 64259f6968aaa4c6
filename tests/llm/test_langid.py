import itertools
import random
import zlib

import numpy as np

from heddle.llm import langid

from .cases import SCHEMA, awkward, empty, prose

ALPHABETS = {"aa": "abcdef", "bb": "ghijkl", "cc": "äëöüms"}


def brute_marginals(emit, steps, first):
    n, k = emit.shape
    total = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        score = first[path[0]] + sum(emit[i, s] for i, s in enumerate(path)) + sum(steps[a, b] for a, b in itertools.pairwise(path))
        for i, s in enumerate(path):
            total[i, s] += np.exp(score)
    return total / total.sum(1, keepdims=True)


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = rng.integers(0, 6, 4)
        steps, first = rng.normal(size=(3, 3)), rng.normal(size=3)
        emit = rng.normal(size=(int(sizes.sum()), 3))
        got = langid.marginals(emit, sizes, steps, first) if len(emit) else emit
        at = 0
        for n in sizes:
            if n:
                assert np.allclose(got[at : at + n], brute_marginals(emit[at : at + n], steps, first))
            at += n


def test_slope_of_pairs():
    rng = np.random.default_rng(2)
    emit, steps, first = rng.normal(size=(4, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    _, pairs = langid.expected(emit, np.array([4]), steps, first)
    brute = np.zeros((2, 2))
    z = 0
    for path in itertools.product(range(2), repeat=4):
        w = np.exp(first[path[0]] + sum(emit[i, s] for i, s in enumerate(path)) + sum(steps[a, b] for a, b in itertools.pairwise(path)))
        z += w
        for a, b in itertools.pairwise(path):
            brute[a, b] += w
    assert np.allclose(pairs, brute / z)


def corpus(spark, n=240):
    rng = random.Random(6)
    rows = [(i, prose(rng, 60, ALPHABETS[k]), k, "s", 0) for i, k in enumerate(itertools.islice(itertools.cycle(ALPHABETS), n))]
    return spark.createDataFrame(rows, SCHEMA)


def test_held_out_accuracy_and_inputs(spark):
    docs = corpus(spark)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    out = langid.identify(docs, per_label=60).collect()
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in out if r.held_out]
    assert held and sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.95


def test_code_switched_words(spark):
    field = langid.learn(corpus(spark), per_label=60)
    rng = random.Random(9)
    text = prose(rng, 20, ALPHABETS["aa"]) + " " + prose(rng, 20, ALPHABETS["cc"])
    docs = spark.createDataFrame([(1, text, None, None, 0)], SCHEMA)
    words = langid.predict(docs, field, words=True).first().words
    assert sum(w == ("aa" if i < 20 else "cc") for i, w in enumerate(words)) >= 38


def test_awkward(spark):
    rows, docs = awkward(spark)
    out = langid.identify(docs)
    got = out.collect()
    assert len(got) == len(rows)
    lettered = {r[0]: any(c.isalpha() for c in r[1] or "") for r in rows}
    assert all((r.lang_pred == "und" and r.score == 0) != lettered[r.doc_id] for r in got if r.doc_id not in (0, None))
    kept = langid.determined(docs)
    assert kept.columns == docs.columns and kept.count() < len(rows)
    assert langid.identify(empty(spark)).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None, None, 0)], SCHEMA)
    assert [r.lang_pred for r in langid.identify(unlabelled).collect()] == ["und"]


def test_numerals_are_no_letters():
    assert langid.words_of("² ½ 10 Ⅷ x² a1b") == ["x", "a", "b"]
    assert not langid.words_of("² ½ ③ 10")
