"""The registry of queries: a function of (spark, sf_dir) and, where SQL can say the same, its DuckDB twin."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def views(spark: SparkSession, sf_dir: str, text: str) -> None:
    """Registers the tables that a query names."""
    for name in TABLES:
        if re.search(rf"\b{name}\b", text):
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def sql(name: str, text: str, twin: str | None = None) -> None:
    """A query in SQL; without a twin the same text is the twin."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        views(spark, sf_dir, text)
        return spark.sql(text)

    run.__name__ = name
    QUERIES[name], TWINS[name] = run, twin or text


def frame(twin: str | None = None) -> Callable:
    """Registers a DataFrame function under its own name."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if twin:
            TWINS[f.__name__] = twin
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
