import itertools
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from heddle.llm import sharding

from .cases import SCHEMA, awkward, empty, prose


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=3), st.lists(st.integers(0, 3), min_size=1, max_size=3), st.randoms())
def test_flow_is_cheapest(supply, capacity, rng):
    if sum(capacity) < sum(supply):
        capacity[0] += sum(supply) - sum(capacity)
    cost = [[rng.randint(0, 4) for _ in capacity] for _ in supply]
    flow = sharding.min_cost_flow(supply, capacity, cost)
    assert [sum(f) for f in flow] == supply
    assert all(sum(f[j] for f in flow) <= capacity[j] for j in range(len(capacity)))
    units = [i for i, n in enumerate(supply) for _ in range(n)]
    best = min((sum(cost[i][j] for i, j in zip(units, to, strict=True)) for to in itertools.product(range(len(capacity)), repeat=len(units)) if all(to.count(j) <= capacity[j] for j in range(len(capacity)))), default=0) if len(units) <= 6 else None
    if best is not None:
        assert sum(c * f for row, flows in zip(cost, flow, strict=True) for c, f in zip(row, flows, strict=True)) == best


def check(rows, out):
    got = out.collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in rows)
    for j in range(8):
        slots = sorted(r.slot for r in got if r.shard == j)
        assert slots == list(range(len(slots)))
    assert {r.shard for r in got} <= set(range(8)) and all(r.law == "bytes" and r.grown_shard is None for r in got)
    return [sum(r.size for r in got if r.shard == j) for j in range(8)]


def test_near_equal(spark):
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(1, 200)) for _ in range(800)]
    docs = spark.createDataFrame([(i, t, "en", "hot" if i % 3 else f"s{i % 7}", 0) for i, t in enumerate(texts)], SCHEMA)
    sizes = check(texts, sharding.near_equal(docs))
    assert max(sizes) - min(sizes) < 200


def test_files_and_moves(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, prose(rng, 40), "en", str(i % 4), 0) for i in range(400)], SCHEMA)
    out, plan, folder = sharding.reshard(docs, F.col("source").cast("int"), 4, file_bytes=20_000)
    assert plan.moved <= 0.1 * sum(plan.sizes)  # the old layout is near equal
    files = sharding.read_shards(spark, folder)
    assert {r.shard for r in files.select("shard").distinct().collect()} == set(plan.affected)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id] == r.text for r in files.collect())
    assert out.count() == 400


def test_awkward(spark):
    rows, docs = awkward(spark)
    check([r[1] for r in rows], sharding.near_equal(docs))
    assert sharding.near_equal(empty(spark)).count() == 0


def test_large_blocks_are_split(spark):
    """A block of many files' worth is written in parts, one file a task, and its slots stay gapless; a repeated id is dealt apart."""
    rng = random.Random(8)
    rows = [(i, prose(rng, 40), None, "hot", 0) for i in range(300)] + [(7, prose(rng, 40), None, "hot", 0) for _ in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out, plan, folder = sharding.reshard(docs, F.lit(9), 8, file_bytes=2_000)
    sizes = check([r[1] for r in rows], out.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None)}))
    assert max(sizes) - min(sizes) < 2_000
    held = sharding.read_shards(spark, folder).withColumn("name", F.input_file_name()).groupBy("name").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert len(held) > 40 and max(r.n for r in held) < 12_000
    first = sorted(map(tuple, out.collect()), key=repr)
    again, _, _ = sharding.reshard(docs.repartition(7), F.lit(9), 8, file_bytes=2_000)
    assert sorted(map(tuple, again.collect()), key=repr) == first


def test_equal_texts_are_rows_of_their_own(spark):
    """A group of copies larger than a shard is dealt out like other rows, and its checksums tell that texts are equal."""
    docs = spark.createDataFrame([(i, "the same text", None, "s", 0) for i in range(800)], SCHEMA)
    got = sharding.near_equal(docs).collect()
    assert len({r.text_crc32 for r in got}) == 1 and {r.shard for r in got} == set(range(8))
