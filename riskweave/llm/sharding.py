"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing."""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.llm import tables

BLOCK = 20_000  # groups or chunks that one differencing run takes
FINEST = 1024  # chunks per shard that reach the last run, at most about


def differencing(sizes, parts):
    """Part of every size: the two partial partitions of largest spread are combined, oppositely ordered, until one
    is left. Ties go by position, so the result depends on the order given alone."""
    sizes = np.asarray(sizes, dtype=np.int64)
    n = len(sizes)
    if n == 0 or parts == 1:
        return np.zeros(n, dtype=np.int64)
    # node -> (sums sorted downwards, minus their least); a node's slots are permuted on combining
    sums, left, right, slots = {}, {}, {}, {}
    heap = []
    for i, s in enumerate(sizes.tolist()):
        heap.append((-s, i))
    heapq.heapify(heap)
    flat = np.zeros(parts, dtype=np.int64)

    def of(node):
        got = sums.pop(node, None)
        if got is None:
            got = flat.copy()
            got[0] = sizes[node]
        return got

    fresh = n
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        joined = of(a) + of(b)[::-1]
        order = np.argsort(-joined, kind="stable")
        joined = joined[order]
        joined -= joined[-1]
        sums[fresh], left[fresh], right[fresh], slots[fresh] = joined, a, b, order
        heapq.heappush(heap, (-int(joined[0]), fresh))
        fresh += 1
    part = np.zeros(n, dtype=np.int64)
    # walk down: `place[s]` is the final part of slot s of a node
    stack = [(heap[0][1], np.arange(parts))]
    while stack:
        node, place = stack.pop()
        if node < n:
            part[node] = place[0]
            continue
        # slot s of the node is slot order[s] of its left side and the mirrored slot of its right side
        back = np.empty(parts, dtype=np.int64)
        back[slots[node]] = place
        stack.append((left[node], back))
        stack.append((right[node], back[::-1]))
    return part


def _chunked(items, quantum):
    """(block, item, chunk, size): the items of every block in parts of about a quantum, or a hundredth of the items."""
    schema = "block bigint, item string, chunk string, size bigint"

    def run(key, frame):
        frame = frame.sort_values(["size", "item"], ascending=[False, True], kind="stable")
        sizes = frame["size"].to_numpy()
        parts = int(max(1, min(len(sizes), sizes.sum() // quantum, max(len(sizes) // 100, sizes.sum() // quantum))))
        part = differencing(sizes, parts)
        total = np.bincount(part, weights=None, minlength=parts) * 0
        np.add.at(total, part, sizes)
        frame["chunk"] = [f"{key[0]}/{p}" for p in part]
        frame["size"] = total[part]
        return frame[["block", "item", "chunk", "size"]]

    return items.groupBy("block").applyInPandas(run, schema)


def group_shards(spark, groups, shards, block=BLOCK, finest=FINEST):
    """(item, shard) for groups (item, size).

    One run of differencing takes a bounded number of items, so small groups are first put together: those under a
    quantum (the total over shards * finest) are spread over blocks by hash, and each block is differenced into
    chunks of about a quantum. Chunks count as items of the next level, until what is left fits one run, which
    differences large groups and chunks alike. The level depends on how many items there are; sizes at the last
    run are at most a quantum or a group's own.
    """
    items = tables.store(spark, groups.select("item", "size"), "groups")
    total, count = items.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    quantum, steps, level = max(1, total // (shards * finest)), [], items
    while count > 2 * shards * finest + block:
        small = level.where(F.col("size") < quantum)
        many = max(1, -(-small.count() // block))
        cut = tables.store(spark, _chunked(small.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(many))), quantum),
                           "chunks")
        steps.append(cut.select("item", "chunk"))
        chunks = cut.select(F.concat(F.lit(f"{len(steps)}:"), "chunk").alias("item"), "size").distinct()
        level = tables.store(spark, level.where(F.col("size") >= quantum).union(chunks), "groups")
        before, count = count, level.count()
        if count > 0.9 * before:  # what is left is large: nothing can be put together
            break

    def run(frame):
        frame = frame.sort_values(["size", "item"], ascending=[False, True], kind="stable")
        frame["shard"] = differencing(frame["size"].to_numpy(), shards)
        return frame[["item", "shard"]]

    placed = tables.store(spark, level.withColumn("all", F.lit(True)).groupBy("all").applyInPandas(run, "item string, shard bigint"), "placed")
    for i in range(len(steps), 0, -1):
        own = placed.where(~F.col("item").startswith(f"{i}:"))
        through = steps[i - 1].withColumn("up", F.concat(F.lit(f"{i}:"), "chunk")).join(
            placed.select(F.col("item").alias("up"), "shard"), "up").select("item", "shard")
        placed = own.union(through)
    return placed


def slots(rows, order, parts):
    """A gapless number from 0 within each shard, in the order of a hash: ranks in hash ranges plus their offsets."""
    cut = rows.withColumn("_h", F.xxhash64(*order)).withColumn(
        "_b", F.floor((F.shiftright("_h", 32) + F.lit(1 << 31)) * F.lit(parts) / F.lit(1 << 32)).cast("int"))
    counts = cut.groupBy("shard", "_b").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy("shard").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("shard", "_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    inside = F.row_number().over(W.partitionBy("shard", "_b").orderBy("_h", *order))
    return cut.withColumn("_i", inside).join(offsets, ["shard", "_b"]).withColumn(
        "slot", F.col("_i") - 1 + F.col("_off")).drop("_h", "_b", "_i", "_off")


def assign_shards(spark, df, key="doc_id", text="text", shards=24, extra=8, rows_per_range=100_000):
    """Per row: key, size, text_crc32, law, shard, slot, grown_shard; the law is `bytes`.

    The size is the UTF-8 bytes of the text (null: none) plus `extra`. Rows of one text are a group and share a shard;
    group sizes are summed before the shuffle, so a hot text costs one row per task. Shard totals are as
    near to each other as the groups allow; a group above the mean fills a shard by itself.

    Slots are numbered from 0 in each shard without gaps; rows that repeat key and text take any of their
    slots. Null keys are rows like others. Other columns are not read. An empty table gives no rows.
    """
    rows = df.select(
        F.col(key).alias("key"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(F.col(text).cast("binary")), F.md5(F.lit("").cast("binary"))).alias("item")).withColumn(
            "size", F.col("bytes") + extra).drop("bytes")
    rows = tables.store(spark, rows, "sized")
    placed = group_shards(spark, rows.groupBy("item").agg(F.sum("size").alias("size")), shards)
    joined = rows.join(placed, "item")
    parts = max(1, rows.count() // (shards * rows_per_range) + 1)
    return slots(joined, ["key", "item"], parts).select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
        F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
