"""The corpus pipeline: five stages over documents, each one of the training-data operators.

Each function takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's
docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heddle.llm import decontaminate, langid, ngram_join, pieces, secrets
from heddle.llm._common import table, written
from heddle.llm.queries import MODEL


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told."""
    return langid.determined(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return ngram_join.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def credentials(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts out secrets in the texts."""
    return secrets.masked(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and digests of the ids and of what they decode to."""
    return pieces.round_trip(docs, pieces.read_model(MODEL), keep=True)


STAGES = [("language", language), ("near_copies", near_copies), ("benchmark", benchmark), ("credentials", credentials), ("encode", encode)]

#: The stages learn models and hash at random; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result in the shared folder before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
