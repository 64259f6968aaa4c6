import os

import pytest

import corpus_pipeline
from heddle.llm import decontaminate, langid, queries
from heddle.llm._common import table

from .test_ngram_join import brute
from .test_secrets import brute as base_spans

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_stages_one_by_one(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    one = stages["language"](spark, docs, FOLDER).cache()
    bad = {r.doc_id for r in langid.identify(docs).collect() if r.lang_pred == "und" or r.score < 0.35}
    assert one.columns == columns and {r.doc_id for r in one.collect()} == {r.doc_id for r in docs.collect()} - bad
    two = stages["near_copies"](spark, one, FOLDER).cache()
    rows = [tuple(r) for r in one.collect()]
    assert two.columns == columns and {r.doc_id for r in two.collect()} == {c for _, _, c in brute(rows, 5, 80)}
    three = stages["benchmark"](spark, two, FOLDER).cache()
    items = [decontaminate.normalised(r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    leaking = {r.doc_id for r in two.collect() if any(i in decontaminate.normalised(r.text) for i in items)}
    assert three.columns == columns and not leaking & {r.doc_id for r in three.collect()}
    assert {r.doc_id for r in two.collect()} - {r.doc_id for r in three.collect()} == leaking  # this table holds exact passages only
    four = stages["credentials"](spark, three, FOLDER).cache()
    assert four.columns == columns and four.count() == three.count()
    assert not any(base_spans(r.text) for r in four.collect()) and all(r.n_chars == len(r.text) for r in four.collect())
    five = stages["encode"](spark, four, FOLDER)
    assert five.where("exact").count() == four.count()


def test_run_and_names(spark):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 11))
    assert set(queries.oracle_sql()) <= set(queries.queries())
