"""Near-duplicate vectors through spherical-cap filters: structured random product codes, list-decoded.

After Becker, Ducas, Gama and Laarhoven (2016): a filter direction is one code vector of the first half of the
(rotated) space joined with one of the second half. With B code vectors a half there are B * B directions, yet a
vector's scores against all of them are sums of two of 2 * B numbers, so that those above a threshold are listed
without trying the rest. Close vectors exceed common directions; vectors are joined on them and checked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.components import components
from tidemark.llm.shared import keep

#: Filters a uniformly random vector exceeds on average, and what every vector gets at least. What pairs are missed is up
#: to the least: twice the average finds no more of the pairs at a cosine of 0.93, and costs twice the copies.
FILTERS, LEAST = 10, 10
#: Vectors of a label that share a random filter on average; sets the number of directions. Wider filters hold more of a
#: vector's neighbours, so fewer of them do, at the price of more comparisons inside tasks.
OCCUPANCY = 256
#: A filter's vectors are compared in chunks of about this many.
CHUNK = 1024
#: A table of more rows than this is joined by a shuffle instead of a broadcast.
SMALL_ROWS = 100_000


@lru_cache(maxsize=8)
def _codes(dim: int, directions: int, filters: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Rotation, the two codes and the score that a random vector exceeds for ``filters`` directions."""
    rng = np.random.default_rng([seed, dim])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    half = max(1, dim // 2)
    codes = []
    for size in (half, dim - half):
        code = rng.standard_normal((directions, max(size, 1)))
        codes.append(code / np.linalg.norm(code, axis=1, keepdims=True) if size else np.zeros((1, 0)))
    probe = rng.standard_normal((256, dim))
    probe /= np.linalg.norm(probe, axis=1, keepdims=True)
    one, two = probe[:, :half] @ codes[0].T, probe[:, half:] @ codes[1].T
    # The best sums come from the best of either half.
    top = min(directions, 4 * filters)
    one, two = -np.sort(-one)[:, :top], -np.sort(-two)[:, :top]
    sums = np.sort((one[:, :, None] + two[:, None, :]).reshape(len(probe), -1))
    return rotation, *codes, float(sums[:, -min(filters, sums.shape[1])].mean())


def decode(vectors: np.ndarray, directions: int, filters: int = FILTERS, least: int = LEAST) -> list[np.ndarray]:
    """The numbers of all directions each unit vector exceeds, ascending.

    A vector that exceeds fewer than ``least`` gets those above a lower threshold of its own.
    """
    rotation, code1, code2, limit = _codes(vectors.shape[1], directions, filters)
    turned = vectors @ rotation
    half = code1.shape[1]
    one, two = turned[:, :half] @ code1.T, turned[:, half:] @ code2.T
    order = np.argsort(-two, axis=1)
    out = []
    for a, b, by in zip(one, two, order):
        down = b[by]  # descending
        threshold = limit
        while True:
            first = np.flatnonzero(a >= threshold - down[0])
            n = np.searchsorted(-down, a[first] - threshold, "right")
            if n.sum() >= min(least, len(a) * len(b)):
                break
            threshold -= 0.02
        found = np.concatenate([i * len(b) + by[:k] for i, k in zip(first.tolist(), n.tolist())])
        out.append(np.sort(found))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.list_(pa.float64()))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _links(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    x, y = x / np.abs(x).max(1, keepdims=True), y / np.abs(y).max(1, keepdims=True)
    cosine = (x @ y.T) / np.outer(np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1)))
    return cosine >= least


def _earlier(filters: list[np.ndarray], rows: np.ndarray, this: int) -> np.ndarray:
    """For the given rows, whether two of them share a filter before ``this``."""
    lists = [filters[r][:np.searchsorted(filters[r], this)] for r in rows]
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    seen, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(rows)), [len(x) for x in lists])
    again = counts[inverse] > 1
    column = np.cumsum(counts > 1) - 1
    member = np.zeros((len(rows), int((counts > 1).sum())), np.float32)
    member[owner[again], column[inverse[again]]] = 1
    return (member @ member.T) > 0


def compare(ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, filters: list[np.ndarray], this: int,
            side: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links found at filter ``this`` and no earlier one: (id, vectors linked with it, smallest id of its part).

    ``side`` is 0 for all when a chunk is compared with itself, else 0 and 1 for two chunks compared with each
    other. Only ids with a link are returned; instead of the pairs, each names the smallest id that the links
    found here lead to.
    """
    order = np.argsort(ids, kind="stable")
    ids, copies, vectors, side = ids[order], copies[order], vectors[order], side[order]
    filters = [filters[i] for i in order]
    linked = _links(vectors, vectors, least)
    np.fill_diagonal(linked, False)
    if side.any():
        linked &= side[:, None] != side[None, :]
    rows = np.flatnonzero(linked.any(1))
    if not len(rows):
        return ids[:0], copies[:0], ids[:0]
    linked = linked[np.ix_(rows, rows)] & ~_earlier(filters, rows, this)
    found = linked.any(1)
    rows, linked = rows[found], linked[np.ix_(found, found)]
    low = np.arange(len(rows))
    while True:
        near = np.where(linked, low[None, :], len(rows)).min(1, initial=len(rows))
        new = np.minimum(low, near)
        new = new[new]
        if (new == low).all():
            break
        low = new
    return ids[rows], linked @ copies[rows], ids[rows][low]


def _verified(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``bucket``: (bucket, filter, own, one, two, label, rep, copies, earlier, embedding), where
    ``earlier`` are the vector's filters before ``filter``."""

    def checked(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        # The bucket is a hash; where two buckets share one, they are told apart here.
        exact = rows.select(["filter", "one", "two", "label"]).to_pylist()
        parts: dict[tuple, list[int]] = {}
        for i, row in enumerate(exact):
            parts.setdefault((*row.values(), len(rows["embedding"][i])), []).append(i)
        for key, at in parts.items():
            if len(at) < 2:
                continue
            part = (rows if len(parts) == 1 else rows.take(at)).combine_chunks()
            column = {n: part[n].combine_chunks() if part[n].num_chunks != 1 else part[n].chunk(0) for n in part.column_names}
            lists = column["earlier"]
            edges, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            yield compare(
                column["rep"].to_numpy(), column["copies"].to_numpy(), _matrix(column["embedding"]),
                [flat[a:b] for a, b in zip(edges[:-1], edges[1:])], key[0],
                (column["own"].to_numpy() != key[1]).astype(np.int8), least)

    def out(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)], names=["rep", "links", "low"])

    held: list[pa.RecordBatch] = []
    last, found = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column(0).to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if held and bucket[a] != last:
                if sum(h.num_rows for h in held) > 1:
                    found += checked(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(a, b - a))
            last = bucket[a]
        if len(found) > 1000:
            yield out(found)
            found = []
    if sum(h.num_rows for h in held) > 1:
        found += checked(pa.Table.from_batches(held))
    if found:
        yield out(found)


def near_vectors(vectors: DataFrame, least: float = 0.93, filters: int = FILTERS, occupancy: int = OCCUPANCY,
                 chunk: int = CHUNK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for ``vectors(vec_id, embedding, label)``, one row per row.

    Two vectors are linked when their labels are equal and not null, their lengths equal, and their cosine in
    double precision is at least ``least``. Vectors that are null, empty, zero or hold a null or non-finite number,
    and rows without label or ``vec_id``, link with nothing. Equal vectors of a label are one representative with
    a number of copies; repeated rows count as vectors of their own. ``component_id`` is the smallest ``vec_id``
    that links reach. An empty table gives no rows.

    Every found link is exact; the filters can miss some (see the README for the measured recall). The number of
    directions follows the largest label, so that a filter holds about ``occupancy`` unrelated vectors at any size.
    The vectors of a fuller filter are compared chunk by chunk, every two chunks in a group of their own, and a
    group returns sums and one row per vector, never its pairs. A pair that shares several filters counts at the
    first.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), "label", "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite
        & F.exists("embedding", lambda x: x != 0), F.lit(False))
    reps = keep(rows.where(usable).groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vectors")
    largest = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    directions = max(8, int(np.ceil(np.sqrt(filters * largest / occupancy))))
    number, lists_of = (T.IntegerType(), pa.list_(pa.int32())) if directions ** 2 < 1 << 31 else (
        T.LongType(), pa.list_(pa.int64()))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sizes = np.array([len(x) for x in part.column(1)])
                lists: list = [None] * len(sizes)
                for size in np.unique(sizes):
                    own = np.flatnonzero(sizes == size)
                    for i, found in zip(own, decode(_unit(_matrix(part.column(1).take(pa.array(own)))), directions, filters)):
                        lists[i] = found
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lists, lists_of)], names=[*part.schema.names, "filters"])

    coded = keep(reps.mapInArrow(decoded, T.StructType([*reps.schema.fields, T.StructField("filters", T.ArrayType(number))])), "coded")
    # A copy in a filter carries the filters before it, which is all that tells whether a pair has met already.
    each = coded.select("label", "rep", "copies", "embedding", "filters", F.posexplode("filters").alias("nth", "filter"))
    each = each.withColumn("earlier", F.slice("filters", F.lit(1), F.col("nth"))).drop("filters", "nth")
    full = keep(
        coded.select("label", F.explode("filters").alias("filter")).groupBy("label", "filter").count()
        .where(F.col("count") > chunk).select("label", "filter", F.ceil(F.col("count") / chunk).alias("chunks")), "full")
    small = full.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    placed = each.join(F.broadcast(full) if small else full, ["label", "filter"], "left")
    placed = placed.withColumn("chunks", F.coalesce("chunks", F.lit(1).cast("long")))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("rep"), "chunks"))
    placed = placed.withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    placed = placed.withColumns({"one": F.least("own", "met"), "two": F.greatest("own", "met")})
    placed = placed.withColumn("bucket", F.xxhash64("label", "filter", "one", "two")).select(
        "bucket", "filter", "own", "one", "two", "label", "rep", "copies", "earlier", "embedding")
    found = keep(
        placed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
            lambda batches: _verified(batches, least), "rep long, links long, low long"), "found")

    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("u"), F.col("low").alias("v")))
    known = reps.join(links, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left").select(
        "label", "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("root", "rep").alias("component_id"))
    joined = rows.withColumn("usable", usable).join(
        known.withColumn("usable", F.lit(True)), ["usable", "label", "embedding"], "left")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
