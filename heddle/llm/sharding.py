"""Minimum-cost-flow resharding.

Old shards supply their bytes, new shards take their capacities, a byte that stays in its shard costs nothing and one
that moves costs one. The minimum-cost flow says how many bytes go from each old to each new shard; blocks, which are
hash buckets of one old shard's documents of one size class, are dealt to the flow's arcs, the largest first. Only
shards whose content changes are written again.

The driver holds a row for each block, and of these there are at most old shards x size classes x buckets, whatever
the data's size. A block's rows are dealt to as many parts, by hash, as it has files' worth of bytes: a task writes one
file, and slots are counted in parts.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import project, scratch_path

BUCKETS = 64
BLOCK = ["old", "class", "bucket"]


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Flow from suppliers to takers that sends all supply at least cost, by successive shortest paths.

    The capacities must hold the supply. The network has a node for each shard; amounts are exact integers.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("the capacities don't hold the supply")
    m, n = len(supply), len(capacity)
    flow = [[0] * n for _ in range(m)]
    left, room = list(supply), list(capacity)
    while any(left):
        far = float("inf")
        give, take = [0 if left[i] else far for i in range(m)], [far] * n
        came: dict[int, int] = {}  # taker -> supplier before it
        went: dict[int, int] = {}  # supplier -> taker before it, along a flow that is taken back
        for _ in range(m + n):  # Bellman-Ford over the residual network
            changed = False
            for i in range(m):
                for j in range(n):
                    if give[i] + cost[i][j] < take[j]:
                        take[j], came[j], changed = give[i] + cost[i][j], i, True
            for i in range(m):
                for j in range(n):
                    if flow[i][j] and take[j] - cost[i][j] < give[i]:
                        give[i], went[i], changed = take[j] - cost[i][j], j, True
            if not changed:
                break
        end = min((j for j in range(n) if room[j]), key=lambda j: (take[j], j))
        path, j, amount = [], end, room[end]
        while True:
            i = came[j]
            path.append((i, j, 1))
            if i not in went:
                amount = min(amount, left[i])
                break
            j = went[i]
            path.append((i, j, -1))
            amount = min(amount, flow[i][j])
        for i, j, sign in path:
            flow[i][j] += sign * amount
        left[path[-1][0]] -= amount
        room[end] -= amount
    return flow


@dataclass
class Plan:
    """Where each block goes: {(old, class, bucket): (new shard, first slot, first byte, bytes)}, and the bytes that move."""

    blocks: dict[tuple[int, int, int], tuple[int, int, int, int]]
    sizes: list[int]
    moved: int
    affected: list[int]


def even(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def plan(blocks: list[tuple[int, int, int, int, int]], capacity: list[int]) -> Plan:
    """Deals blocks, (old, class, bucket, bytes, rows) each, so that new shards get their capacity of bytes.

    What whole blocks leave uneven is mended by moving single blocks from the fullest to the emptiest shard, until no
    move makes these two nearer.
    """
    old = sorted({b[0] for b in blocks})
    supply = [sum(b[3] for b in blocks if b[0] == i) for i in old]
    flow = min_cost_flow(supply, capacity, [[int(i != j) for j in range(len(capacity))] for i in old])
    to: dict[tuple[int, int, int], int] = {}
    size = {b[:3]: b[3] for b in blocks}
    filled = [0] * len(capacity)
    for at, i in enumerate(old):
        left = {j: f for j, f in enumerate(flow[at]) if f}
        for b in sorted((b for b in blocks if b[0] == i), key=lambda b: (-b[3], b[:3])):
            j = max(left, key=lambda j: (left[j], i == j, -j))
            left[j] -= b[3]
            to[b[:3]] = j
            filled[j] += b[3]
    own: list[set[tuple[int, int, int]]] = [set() for _ in capacity]
    for b, j in to.items():
        own[j].add(b)
    while True:  # each move lessens the sum of squares
        over = [f - c for f, c in zip(filled, capacity, strict=True)]
        full, bare = max(range(len(over)), key=over.__getitem__), min(range(len(over)), key=over.__getitem__)
        half = (over[full] - over[bare]) / 2
        b = min((b for b in own[full] if size[b] < 2 * half), key=lambda b: (abs(size[b] - half), b), default=None)
        if b is None or half < 1:
            break
        own[full].remove(b)
        own[bare].add(b)
        to[b] = bare
        filled[full] -= size[b]
        filled[bare] += size[b]
    slot, used = [0] * len(capacity), [0] * len(capacity)
    placed = {}
    for o, c, k, n, rows in sorted(blocks):
        j = to[o, c, k]
        placed[o, c, k] = (j, slot[j], used[j], n)
        slot[j] += rows
        used[j] += n
    moves = [(o, to[o, c, k], n) for o, c, k, n, _ in blocks if to[o, c, k] != o]
    return Plan(placed, filled, sum(m[2] for m in moves), sorted({x for m in moves for x in m[:2] if x < len(capacity)}))


def blocked(docs: DataFrame, old: Column) -> DataFrame:
    """(doc_id, text, old, class, bucket, size): null texts are empty, a size is the UTF-8 bytes and 1."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), old.cast("int").alias("old"))
    size = F.octet_length("text").cast("long") + 1
    return rows.select("*", F.floor(F.log2(size)).cast("int").alias("class"), F.pmod(spread(0), F.lit(BUCKETS)).cast("int").alias("bucket"), size.alias("size"))


def spread(seed: int) -> Column:
    """A hash of a row's id and text: texts that share an id are dealt apart, too."""
    return F.xxhash64("doc_id", F.crc32("text"), F.octet_length("text"), F.lit(seed))


def reshard(docs: DataFrame, old: Column, shards: int = 8, file_bytes: int = 64 << 20) -> tuple[DataFrame, Plan, str]:
    """Reshards (doc_id, text) rows whose old shard is `old` into `shards` shards of near equal bytes.

    Writes the affected shards' files to a new folder, shard=N/ each, and returns every row as (doc_id, size,
    text_crc32, shard, slot), read from the new files where a shard was written and from docs where it stays; the
    plan; and the folder. slot counts a shard's rows from 0 in the order of the files. Repeated rows, and rows without
    doc_id, are rows like any other. Equal texts are told by their checksum and need not share a shard: a group of
    copies may be larger than a shard of near equal size. Empty table: no rows, nothing written.
    """
    spark = docs.sparkSession
    rows = blocked(project(docs.withColumn("_old", old), doc_id="long", text="string", _old="int"), F.col("_old"))
    made = [tuple(r) for r in rows.groupBy(*BLOCK).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()]
    done = plan(made, even(sum(b[3] for b in made), shards))
    folder = scratch_path(spark, "shards")
    files = [-(-n // file_bytes) for n in done.sizes]
    first = [sum(files[:j]) for j in range(shards)]
    where = [(*b, shard, slot, first[shard], start, size, max(1, -(-size // file_bytes))) for b, (shard, slot, start, size) in sorted(done.blocks.items())]
    kinds = {**dict.fromkeys(BLOCK, T.IntegerType()), "shard": T.IntegerType(), "offset": T.LongType(), "first": T.IntegerType(), "start": T.LongType(), "bytes": T.LongType(), "parts": T.IntegerType()}
    placed = rows.join(F.broadcast(spark.createDataFrame(where, T.StructType([T.StructField(c, t) for c, t in kinds.items()]))), BLOCK)  # a row for each block: bounded by BUCKETS, not by the data
    placed = placed.withColumn("part", F.pmod(spread(1), F.col("parts")).cast("int"))
    kept = placed.where(~F.col("shard").isin(done.affected)) if done.affected else placed
    digest = lambda df: df.select("doc_id", (F.octet_length("text").cast("long") + 1).alias("size"), F.crc32("text").alias("text_crc32"), "shard", "offset", *BLOCK, "part")
    out = digest(kept)
    if done.affected:
        at = F.col("start") + F.floor(F.col("bytes") * F.col("part") / F.col("parts"))
        changed = placed.where(F.col("shard").isin(done.affected)).withColumn("file", (F.col("first") + F.floor(at / file_bytes)).cast("int"))
        changed = changed.select("doc_id", "text", "shard", "offset", "file", *BLOCK, "part")
        dealt = changed.repartitionById(max(1, sum(files)), F.col("file")).sortWithinPartitions("shard", "offset", "part", "doc_id")
        dealt.write.partitionBy("shard").parquet(folder)
        out = digest(read_shards(spark, folder)).unionByName(out)
    own = [*BLOCK, "part", "shard", "offset"]
    slot = F.row_number().over(Window.partitionBy(*own).orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size"))
    before = F.sum("n").over(Window.partitionBy(*BLOCK).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = out.groupBy(*own).agg(F.count("*").alias("n")).select(*own, F.coalesce(before, F.lit(0)).alias("before"))  # a row for each file's worth
    out = out.withColumn("turn", slot).join(counts, own)
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("before") + F.col("turn") - 1).cast("long").alias("slot")), done, folder


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    schema = "doc_id long, text string, offset long, file int, old int, class int, bucket int, part int, shard int"
    return spark.read.schema(schema).parquet(folder)


def by_source(old_shards: int = 6) -> Column:
    """An old layout with a shard for a hash of the source, as uneven as the sources are."""
    return F.pmod(F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit(""))), F.lit(old_shards))


def near_equal(docs: DataFrame) -> DataFrame:
    """documents, in shards by source, resharded into eight shards of near equal bytes."""
    out, _, _ = reshard(project(docs, doc_id="long", text="string", source="string"), by_source())
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
