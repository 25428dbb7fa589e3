"""Resharding that moves the fewest bytes, solved as a minimum-cost flow.

Old shards supply bytes, new shards take them, and only a byte that changes its shard costs
anything. The flow between shards is then dealt out to blocks of rows, whose sizes are the only
thing the driver sees (a fixed number per shard), and only files that hold a moved block are
written again; the others stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import remove_path, scratch_path, written

#: Blocks of a shard; each holds about 1 in so many of its rows.
BLOCKS = 2048
#: Files folders of an old shard, each of consecutive blocks.
PARTS = 4
OWN = ("_old_shard", "_part", "_block", "_size", "_crc", "_shard")


def min_cost_flow(supply: np.ndarray, capacity: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Cheapest integer flow that sends all supply within the capacities; successive shortest paths.

    Bellman-Ford over the residual graph of sources and sinks, with a path's bottleneck per round.
    """
    supply, capacity = np.array(supply, dtype=object), np.array(capacity, dtype=object)
    if supply.sum() > capacity.sum():
        raise ValueError("capacities hold less than the supply")
    n, m = cost.shape
    flow = np.zeros((n, m), dtype=object)
    while supply.sum() > 0:
        to_source = np.where(supply > 0, 0.0, np.inf).astype(float)
        to_sink, from_source, from_sink = np.full(m, np.inf), np.full(m, -1), np.full(n, -1)
        while True:
            through = to_source[:, None] + cost
            best = through.argmin(0)
            closer = through[best, np.arange(m)] < to_sink - 1e-9
            to_sink[closer], from_source[closer] = through[best, np.arange(m)][closer], best[closer]
            back = np.where(flow > 0, to_sink[None, :] - cost, np.inf).astype(float)
            best = back.argmin(1)
            nearer = back[np.arange(n), best] < to_source - 1e-9
            to_source[nearer], from_sink[nearer] = back[np.arange(n), best][nearer], best[nearer]
            if not closer.any() and not nearer.any():
                break
        sink = int(np.where(capacity > 0, to_sink, np.inf).astype(float).argmin())
        steps, at, amount = [], sink, capacity[sink]
        while True:
            source = int(from_source[at])
            steps.append((source, at, 1))
            if from_sink[source] < 0:
                amount = min(amount, supply[source])
                break
            at = int(from_sink[source])
            steps.append((source, at, -1))
            amount = min(amount, flow[source, at])
        for source, at, sign in steps:
            flow[source, at] += sign * amount
        supply[steps[-1][0]] -= amount
        capacity[sink] -= amount
    return flow


@dataclass(frozen=True)
class Plan:
    """The new shard of each (old shard, block), and the bytes that move."""

    target: dict[tuple[int, int], int]
    moved: int


def plan_transfers(sizes: dict[tuple[int, int], int], old: int, new: int) -> Plan:
    """Deal the flow between shards out to blocks: a shard keeps its first blocks and gives its last.

    Block sizes make the flow inexact by less than a block per boundary; single blocks are then
    passed from the fullest to the emptiest shard while that brings the two closer.
    """
    total = sum(sizes.values())
    supply = np.array([sum(v for (s, _), v in sizes.items() if s == k) for k in range(old)], dtype=object)
    capacity = np.array([total // new + (k < total % new) for k in range(new)], dtype=object)
    cost = (np.arange(old)[:, None] != np.arange(new)[None, :]).astype(float)
    flow = min_cost_flow(supply, capacity, cost)
    target: dict[tuple[int, int], int] = {}
    for shard in range(old):
        order = [shard] * (shard < new) + [j for j in range(new) if j != shard]
        edges, done = np.cumsum([flow[shard, j] for j in order]), 0
        for block in sorted(b for s, b in sizes if s == shard):
            size = sizes[shard, block]
            at = int(np.searchsorted(edges.astype(float), done + size / 2, "right"))
            target[shard, block] = order[min(at, new - 1)]
            done += size
    held: list[dict[tuple[int, int], int]] = [{} for _ in range(new)]
    for key, shard in target.items():
        held[shard][key] = sizes[key]
    sums = [sum(x.values()) for x in held]
    for _ in range(64 * new):
        most, least = int(np.argmax(sums)), int(np.argmin(sums))
        gap = sums[most] - sums[least]
        key = min(held[most], key=lambda k: (abs(gap - 2 * held[most][k]), k), default=None)
        if key is None or abs(gap - 2 * held[most][key]) >= gap:
            break
        size = held[least][key] = held[most].pop(key)
        sums[most] -= size
        sums[least] += size
        target[key] = least
    return Plan(target, sum(sizes[k] for k, shard in target.items() if shard != k[0]))


def text_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def write_old_layout(docs: DataFrame, path: str, old: int) -> None:
    """Rows in ``old`` shards by hash, in folders of consecutive blocks; large texts have the first blocks.

    What makes a text large follows from a histogram of sizes by powers of two: the large ones hold
    at most a quarter of all bytes, unless single sizes hold more.
    """
    size = text_size()
    spread = F.xxhash64(F.lit(5), "doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")), size)
    bins = {r[0]: r[1] for r in docs.select(size.alias("size")).groupBy(F.floor(F.log2("size")).alias("bin")).agg(F.sum("size")).collect()}
    cut, held = 63, 0
    while cut > 0 and 4 * (held + bins.get(cut - 1, 0)) <= sum(bins.values()):
        cut -= 1
        held += bins.get(cut, 0)
    half = BLOCKS // 2
    within = F.pmod(F.shiftrightunsigned(spread, 20), F.lit(half))
    block = F.when(size >= F.lit(1 << min(cut, 62)), within).otherwise(within + half).cast("int")
    laid = docs.drop(*OWN).withColumns({"_old_shard": F.pmod(spread, F.lit(old)).cast("int"), "_block": block, "_size": size, "_crc": F.crc32(F.coalesce("text", F.lit("")).cast("binary"))})
    laid = laid.withColumn("_part", F.floor(F.col("_block") / (BLOCKS // PARTS)).cast("int"))
    laid.write.partitionBy("_old_shard", "_part").parquet(path)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def reshard(docs: DataFrame, path: str, old: int, new: int) -> DataFrame:
    """``docs`` laid out in ``old`` shards below ``path``, then in ``new``; the rows with ``_shard``, read back.

    Kept files stay below ``path``/old, rewritten ones are below ``path``/new. Null texts have one
    byte. Columns of ``docs`` named like the layout's own are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    write_old_layout(docs, f"{path}/old", old)
    kinds = [T.StructField(f.name, f.dataType) for f in docs.drop(*OWN).schema]
    own = [T.StructField("_block", T.IntegerType()), T.StructField("_size", T.LongType()), T.StructField("_crc", T.LongType())]
    before = _read(spark, f"{path}/old", T.StructType([*kinds, *own, T.StructField("_old_shard", T.IntegerType()), T.StructField("_part", T.IntegerType())]))
    sizes = {(r[0], r[1]): r[2] for r in before.groupBy("_old_shard", "_block").agg(F.sum("_size")).collect()}
    plan = plan_transfers(sizes, old, new)
    touched = {(s, b // (BLOCKS // PARTS)) for (s, b), shard in plan.target.items() if shard != s}
    targets = spark.createDataFrame([(s, b, shard) for (s, b), shard in plan.target.items()], "_old_shard int, _block int, _shard int")
    affected = F.lit(False)
    for shard, part in sorted(touched):
        affected |= (F.col("_old_shard") == shard) & (F.col("_part") == part)
    moved = before.where(affected).join(F.broadcast(targets), ["_old_shard", "_block"])
    moved.drop("_part").write.partitionBy("_shard").parquet(f"{path}/new")
    after = _read(spark, f"{path}/new", T.StructType([*kinds, *own, T.StructField("_old_shard", T.IntegerType()), T.StructField("_shard", T.IntegerType())]))
    kept = before.where(~affected).withColumn("_shard", F.col("_old_shard")).drop("_part")
    return kept.unionByName(after)


def with_slots(rows: DataFrame) -> DataFrame:
    """``rows`` of a layout with ``slot``: gapless places in each shard, block after block.

    A block's first place is the sum of the blocks before it, of which there is a fixed number; only
    rows of one block are ordered among themselves.
    """
    blocks = rows.groupBy("_shard", "_old_shard", "_block").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("_shard").orderBy("_old_shard", "_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("_shard", "_old_shard", "_block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_shard", "_old_shard", "_block").orderBy("doc_id", "_crc", "_size")
    placed = rows.withColumn("_place", F.row_number().over(within) - 1).join(F.broadcast(bases), ["_shard", "_old_shard", "_block"])
    return placed.withColumn("slot", F.col("_base") + F.col("_place")).drop("_base", "_place")


def shard_digests(docs: DataFrame, old: int = 5, new: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard after resharding, read from the files."""
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    laid = reshard(docs.select("doc_id", "text"), path, old, new)
    slim = written(laid.select("doc_id", "_size", "_crc", "_shard", "_old_shard", "_block"), "shard-digests")
    remove_path(spark, path)
    return with_slots(slim).select(
        "doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("_shard").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
