"""Shards of nearly equal bytes by Karmarkar-Karp differencing; equal texts stay together.

Groups are dealt to blocks. In a block the two partial partitions with the largest spread are combined again
and again, oppositely ordered, until one is left; then blocks of blocks go on with those. A level's items are
bounded, so neither the driver nor a task holds all groups.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWEST, cut, text_column

BLOCK = 8192
ROWS = 1 << 16


def difference(items: list[list[int]], k: int) -> tuple[list[int], list[list[int]]]:
    """k sums, largest first, and for each item the shard of each of its parts. Items: descending sums, at most k of them."""
    sums = [x + [0] * (k - len(x)) for x in items]
    children: list[tuple | None] = [None] * len(items)
    heap = [(x[-1] - x[0], i) for i, x in enumerate(sums)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        x, y = sums[a], sums[b]
        order = sorted(range(k), key=lambda s: (-(x[s] + y[k - 1 - s]), s))
        sums.append([x[s] + y[k - 1 - s] for s in order])
        sums[a] = sums[b] = []
        children.append((a, b, order))
        heapq.heappush(heap, (sums[-1][-1] - sums[-1][0], len(sums) - 1))
    root = heap[0][1]
    place: dict[int, list[int]] = {root: list(range(k))}
    out: list[list[int]] = [[] for _ in items]
    stack = [root]
    while stack:
        i = stack.pop()
        at = place.pop(i)
        if children[i] is None:
            out[i] = at
            continue
        a, b, order = children[i]
        pa_, pb = [0] * k, [0] * k
        for slot, s in enumerate(order):
            pa_[s] = at[slot]
            pb[k - 1 - s] = at[slot]
        place[a], place[b] = pa_, pb
        stack += [a, b]
    return sums[root], out


def shards(docs: DataFrame, k: int = 24, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each document.

    size: UTF-8 bytes of the text and 8; null text: none, and in one group with empty texts. Null doc_id stays
    null. Repeated rows have slots of their own; slots count up by doc_id within parts of a shard. Other columns
    are ignored; an empty table gives an empty result. law `bytes`; grown_shard is null under it.
    """
    spark = docs.sparkSession
    text = text_column(docs)
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("same")))
    groups = cut(rows.groupBy("same").agg(F.sum("size").alias("total")))
    n = groups.count()
    # level 0: items with one part
    blocks = max(1, -(-n // block))
    level = groups.select("same", F.pmod(F.xxhash64("same"), F.lit(blocks)).alias("parent"), F.array("total").alias("sums"))
    key = "same"
    maps: list[DataFrame] = []

    def combine(table):
        table = table.sort_by(table.column_names[0])
        sums, places = difference(table["sums"].to_pylist(), k)
        names = table.column_names[0]
        return pa.table({names: table[names], "node": table["parent"], "places": pa.array(places, pa.list_(pa.int32())), "sums": pa.array([sums if i == 0 else None for i in range(len(places))], pa.list_(pa.int64()))})

    while True:
        kind = "binary" if key == "same" else "long"
        made = cut(level.groupBy("parent").applyInArrow(lambda t: combine(t), f"{key} {kind}, node long, places array<int>, sums array<long>"))
        maps.append(made.select(key, "node", "places"))
        if blocks == 1:
            break
        below, blocks = blocks, -(-blocks // block)
        level = made.filter("sums is not null").select(F.col("node").alias("child"), F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("parent"), "sums")
        key = "child"
    # from the last level down: where each part of a node ended
    final = maps[-1].select(F.col(key).alias("key"), "places")
    for made in reversed(maps[:-1]):
        own = [c for c in made.columns if c not in ("node", "places")][0]
        upper = final.select(F.col("key").alias("node"), F.col("places").alias("upper"))
        final = made.join(upper, "node").select(F.col(own).alias("key"), F.transform("places", lambda p: F.element_at("upper", p + 1)).alias("places"))
    shard = final.select(F.col("key").alias("same"), F.element_at("places", 1).alias("shard"))
    placed = rows.join(shard, "same").select("doc_id", "size", "text_crc32", "shard")
    return slots(placed, n_rows=rows.count()).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def slots(placed: DataFrame, n_rows: int) -> DataFrame:
    """Adds slot, gapless from 0 in each shard, without gathering a shard: parts are numbered inside and offset by their counts."""
    parts = max(1, -(-n_rows // ROWS)) * 8
    held = cut(placed.withColumn("part", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(LOWEST)), "size"), F.lit(parts))))
    counts = held.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part", "shard").orderBy("doc_id", "text_crc32"))
    return held.withColumn("inside", inside).join(offsets, ["shard", "part"]).withColumn("slot", F.col("before") + F.col("inside") - 1).drop("part", "inside", "before")


def op5_karmarkar_karp(spark, sf_dir: str) -> DataFrame:
    return shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
