"""Byte-balanced shards by Karmarkar-Karp differencing over indivisible groups of equal texts."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.shared import keep

#: Groups, or partial partitions, that one task differences in memory.
AT_ONCE = 50_000


def difference(loads: Sequence[Sequence[int]]) -> np.ndarray:
    """Which final part each part of each partial partition goes to: an array (partials, parts).

    ``loads`` has the sizes of the parts of each partial partition; a single item is one non-empty part. The two
    partial partitions with the largest spread are combined in opposite order, largest part with smallest, until
    one is left. Ties are broken by position, so equal input gives equal output.
    """
    n, k = len(loads), len(loads[0])
    heap, sides, orders = [], [], []
    for i, row in enumerate(loads):
        order = sorted(range(k), key=lambda p: (-row[p], p))
        row = [row[p] for p in order]
        heap.append((row[-1] - row[0], i, row))
        orders.append(order)
        sides.append(None)
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        both = [x + y for x, y in zip(left, reversed(right))]
        order = sorted(range(k), key=lambda p: (-both[p], p))
        row = [both[p] for p in order]
        heapq.heappush(heap, (row[-1] - row[0], len(sides), row))
        sides.append((a, b))
        orders.append(order)
    final: list = [None] * len(sides)
    final[heap[0][1]] = list(range(k))
    out = np.empty((n, k), np.int32)
    for node in range(len(sides) - 1, -1, -1):
        at = [0] * k  # part of this node before it was sorted -> final part
        for place, part in enumerate(orders[node]):
            at[part] = final[node][place]
        if sides[node] is None:
            out[node] = at
        else:
            final[sides[node][0]] = at
            final[sides[node][1]] = at[::-1]
        final[node] = None
    return out


def _differenced(items: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """Items (id, bucket, loads) differenced bucket by bucket: (id, parts) and the partials left (bucket, loads)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        loads = [list(map(int, x)) for x in pdf["loads"]]
        parts = difference(loads)
        total = np.zeros(shards, np.int64)
        np.add.at(total, parts.ravel(), np.array(loads).ravel())
        return pd.DataFrame({
            "id": pdf["id"].to_numpy(), "parts": parts.tolist(), "bucket": pdf["bucket"].to_numpy(),
            "total": [total.tolist() if i == 0 else None for i in range(len(pdf))]})

    done = keep(items.groupBy("bucket").applyInPandas(
        run, "id string, parts array<int>, bucket long, total array<long>"), "differenced")
    return done.select("id", "bucket", "parts"), done.where("total is not null").select("bucket", "total")


def balanced_groups(groups: DataFrame, shards: int, at_once: int = AT_ONCE) -> DataFrame:
    """(id, shard) for ``groups(id string, size long)`` with near equal sums of size per shard.

    Groups are dealt by a hash of their id into buckets of about ``at_once``; every bucket is differenced in a
    task of its own, which leaves one partial partition of small spread. These are dealt and differenced again,
    until a single bucket, of ``at_once`` partial partitions at most, is left. Each level notes where the parts
    of its items went, and the levels are joined on the bucket from the last to the first.
    """
    empty = [F.lit(0).cast("long")] * (shards - 1)
    items = groups.select("id", F.array(F.col("size").cast("long"), *empty).alias("loads"))
    count, levels = groups.count(), []
    while True:
        buckets = max(1, -(-count // at_once))
        dealt = items.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("long"))
        parts, left = _differenced(dealt, shards)
        levels.append(parts)
        if buckets == 1:
            break
        items = left.select(F.col("bucket").cast("string").alias("id"), F.col("total").alias("loads"))
        count = buckets
    where = levels.pop()
    while levels:
        inner = levels.pop()
        outer = where.select(F.col("id").cast("long").alias("bucket"), F.col("parts").alias("outer"))
        where = inner.join(outer, "bucket").select(
            "id", "bucket", F.transform("parts", lambda p: F.element_at("outer", p + 1)).alias("parts"))
    return where.select("id", F.element_at("parts", 1).alias("shard"))


def numbered(df: DataFrame, key: str, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with a gapless number from 0 within ``key`` along ``order``; no key has to fit a task.

    Rows are dealt by ranges of (key, order) and written with the number of their range. Rows of one range are
    numbered in a window; what comes before a range is summed over one row per (key, range).
    """
    ranged = keep(df.repartitionByRange(key, *order).withColumn("range*", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(key).orderBy("range*").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(key, "range*").agg(F.count(F.lit(1)).alias("n*")).select(
        key, "range*", F.coalesce(F.sum("n*").over(before), F.lit(0)).alias("offset*"))
    within = Window.partitionBy(key, "range*").orderBy(*order)
    return ranged.withColumn("row*", F.row_number().over(within)).join(offsets, [key, "range*"]).withColumn(
        name, (F.col("`offset*`") + F.col("`row*`") - 1).cast("long")).drop("range*", "row*", "offset*")


def shard_documents(docs: DataFrame, shards: int = 8, at_once: int = AT_ONCE) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): documents in ``shards`` shards near equal in bytes.

    A document's size is the UTF-8 bytes of its text plus 1; a null text has no bytes and is placed with the empty
    ones. Documents of equal text form a group, which stays whole, so a group larger than a shard's share makes
    that shard as large as the group and the rest are balanced around it. ``slot`` numbers each shard from 0 along
    ``doc_id`` (nulls first). Repeated rows are separate rows of one group. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = keep(docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.md5(text.cast("binary")).alias("id")), "rows")
    groups = keep(rows.groupBy("id").agg(F.sum("size").alias("size")), "groups")
    placed = rows.join(balanced_groups(groups, shards, at_once), "id").drop("id")
    return numbered(placed, "shard", ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))
