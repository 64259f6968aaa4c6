"""Connected components: of few links in one task, of more by alternating large-star and small-star steps; nothing is collected."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import batch_of, dropped, in_arrow, written

ONE_TASK = 1 << 18  # links that one task takes, 4 MB of them; each step over more is several shuffles


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links a, b all nodes, ascending, and the smallest one that each reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while len(one):
        low, high = np.minimum(root[one], root[two]), np.maximum(root[one], root[two])
        np.minimum.at(root, high, low)  # a root hangs on the smallest root that it is linked with
        while (further := root[root] != root).any():
            root[further] = root[root[further]]
        apart = root[one] != root[two]
        one, two = one[apart], two[apart]
    return nodes, nodes[root]


def in_one_task(edges: DataFrame) -> DataFrame:
    """(id, component) of edges (u, v)."""
    schema = pa.schema([("id", pa.int64()), ("component", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.stack([b.column(i).to_numpy() for i in range(2)]) for b in batches if b.num_rows]
        if rows:
            yield batch_of(schema, [pa.array(c) for c in least_reached(*np.concatenate(rows, 1))])

    return in_arrow(edges.repartition(1), run, "id long, component long")


def components(links: DataFrame) -> DataFrame:
    """(id, component), written, of every node of links (a, b): the smallest id that can be reached.

    Up to ONE_TASK links are solved by one task, and more in steps. A step hangs a node's neighbours on the smallest of them, which is a minimum that is combined before the shuffle
    and joined back. Steps end when nothing changes, after about as many as the logarithm of a component's size.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = written(edges, "edges")
    if edges.count() <= ONE_TASK:
        out = written(in_one_task(edges), "components")
        dropped(edges)
        return out
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        last, edges = edges, written(small.select(F.col("v").alias("u"), "m").unionByName(small.select("u", "m")).where("u <> m").select("u", F.col("m").alias("v")).distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        dropped(last)
        if now == before:
            break
        before = now
    hung = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    out = written(hung.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()), "components")
    dropped(edges)
    return out


def extended(known: DataFrame, links: DataFrame) -> DataFrame:
    """components() of the links that made `known` and of more links: only components are linked, not all nodes again, if they don't fit one task."""
    if known.count() + links.count() <= ONE_TASK:
        return written(in_one_task(known.toDF("u", "v").unionByName(links.toDF("u", "v"))), "components")
    nodes = links.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(known, "id", "left")
    nodes = written(nodes.select("id", F.coalesce("component", "id").alias("component")), "nodes")
    at_a, at_b = nodes.toDF("a", "p"), nodes.toDF("b", "q")
    joined = components(links.join(at_a, "a").join(at_b, "b").select(F.col("p").alias("a"), F.col("q").alias("b")))
    every = known.unionByName(nodes.join(known.select("id"), "id", "left_anti"))
    out = written(every.join(joined.toDF("component", "root"), "component", "left").select("id", F.coalesce("root", "component").alias("component")), "components")
    dropped(nodes, joined)
    return out
