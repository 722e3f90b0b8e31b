"""Near-duplicates by SimHash: pigeonhole blocks, a join on blocks, a check of the Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.components import components
from tidemark.llm.shared import keep, map_rows, quoted

#: A block with more distinct fingerprints than this is linked through midpoints instead of pairs.
BLOCK_LIMIT = 32
_SHINGLES_AT_ONCE = 255 * 2048


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash over word shingles: bit set when set in over half the shingle hashes; 0 without words."""
    plain = b" ".join((text or "").encode().lower().split())
    if not plain:
        return 0
    gaps = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(plain)]))
    if len(starts) > width:
        starts, ends = starts[:len(starts) - width + 1], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    set_in, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _SHINGLES_AT_ONCE):
        spans = zip(starts[at:at + _SHINGLES_AT_ONCE].tolist(), ends[at:at + _SHINGLES_AT_ONCE].tolist())
        found = np.array([digest(plain[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = len(bits) // 255 * 255
        if full:  # sums of 255 fit a byte, which adds many columns at once
            set_in += bits[:full].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        set_in += bits[full:].sum(0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long, one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _mask(parts: tuple[int, ...]) -> int:
    mask = sum(0xFFFF << (16 * p) for p in parts)
    return mask - (1 << 64) if mask >> 63 else mask


def fingerprint_links(distinct: DataFrame, limit: int = BLOCK_LIMIT) -> DataFrame:
    """Links (u, v) that connect every two distinct fingerprints with 1 or 2 differing bits.

    ``distinct`` has a column ``fp`` without repeats. Two differing bits leave two of four 16-bit parts equal:
    each fingerprint goes into six blocks, one per pair of parts, and a block's members are joined and checked.
    Within a block of more than ``limit`` members the pairs would grow with its square. There each member goes
    to its 33 midpoints, itself and every flip of one of the 32 bits the block leaves open; two fingerprints
    share one exactly when at most two bits differ, so linking all of a midpoint to its smallest is exact and
    linear. A midpoint's smallest comes from an aggregation that combines map-side.
    """
    pairs = list(combinations(range(4), 2))
    masks = F.array(*[F.lit(_mask(p)).cast("long") for p in pairs])
    blocks = distinct.select("fp", F.posexplode(masks).alias("part", "mask")).select(
        "fp", "part", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("block"))
    sizes = blocks.groupBy("part", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = keep(blocks.join(sizes, ["part", "block"]), "blocks")

    few = placed.where(F.col("n") <= limit).select("part", "block", "fp")
    other = few.withColumnRenamed("fp", "other")
    direct = few.join(other, ["part", "block"]).where(
        (F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= 2)
    ).select(F.col("fp").alias("u"), F.col("other").alias("v"))

    open_bits = [[b for b in range(64) if b // 16 not in p] for p in pairs]
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[
        F.lit((1 << b) - (1 << 64) if b == 63 else 1 << b).cast("long") for b in bits]) for bits in open_bits])
    many = placed.where(F.col("n") > limit).select(
        "fp", F.explode(F.element_at(flips, F.col("part") + 1)).alias("flip")
    ).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
    smallest = many.groupBy("middle").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high")
    through = many.join(smallest.select("middle", "low"), "middle").where("fp <> low").select(
        F.col("fp").alias("u"), F.col("low").alias("v"))
    return direct.unionByName(through).distinct()


def simhash_groups(docs: DataFrame, width: int = 3, limit: int = BLOCK_LIMIT) -> DataFrame:
    """(doc_id, fp, component_id): documents linked by fingerprints with at most two differing bits.

    ``component_id`` is the smallest ``doc_id`` that links reach. A null text counts as empty, and empty texts
    share fingerprint zero, linked like any other. Repeated rows give repeated results; rows whose ``doc_id``
    is null keep a null id but belong to their group. An empty table gives no rows. Long texts are hashed whole.
    Equal fingerprints are grouped before anything is linked, so copies never meet in pairs.
    """
    found = keep(fingerprints(docs, width), "fingerprints")
    distinct = keep(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    linked = components(fingerprint_links(distinct.select("fp"), limit))
    roots = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = keep(roots.join(ids, "root").select("fp", "component_id"), "classes")
    return found.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = 3) -> DataFrame:
    """``docs`` with the document of the smallest ``doc_id`` of each near-duplicate group, columns unchanged.

    Rows without a ``doc_id`` stay only where their whole group has none, all of them then. Repeated rows of
    one ``doc_id`` are reduced to one.
    """
    groups = keep(simhash_groups(docs, width).where(F.col("doc_id").eqNullSafe(F.col("component_id"))), "kept")
    stays = groups.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    stays = keep(stays, "stays")
    # The ids grow with the documents, so they are joined by a shuffle at every size and never broadcast.
    named = docs.join(stays.select("doc_id").hint("merge"), "doc_id", "left_semi").select(*quoted(docs))
    if stays.where("n > 1").limit(1).count():
        named = named.dropDuplicates(["doc_id"])
    if groups.where("doc_id is null").limit(1).count():
        unnamed = _rows_without_id(docs, groups, width)
        return named.unionByName(unnamed)
    return named


def _rows_without_id(docs: DataFrame, groups: DataFrame, width: int) -> DataFrame:
    prints, at = groups.where("doc_id is null").select("fp").distinct(), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), width) for t in batch.column(at)], np.uint64).view(np.int64)
            names = [*batch.schema.names, f"c{batch.num_columns}"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=names)

    marked = map_rows(docs.where("doc_id is null"), run, T.StructField("fp*", T.LongType()))
    return marked.join(prints, marked["`fp*`"] == prints["fp"], "left_semi").select(*quoted(docs))
