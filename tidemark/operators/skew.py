"""Splitting of hot groups so that ordered work never puts one big group into one task.

An ordered window over a key cannot be salted at random. Instead the rows of a hot key are cut into
consecutive runs ("chunks") along the ordering column, each chunk is processed on its own, and the caller
carries the little state that crosses a cut (a row count, the last 20 rows, a streak length).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import new_scratch

CHUNK = "_chunk"
# Rows of equal order value are ordered by the hash of the whole row, and identical ones by a number.
TIE, COPY = "_tie", "_copy"
# Number of a sorted row, and the sorted partition that it is in.
ROW, PART = "_row", "_sorted_part"
TIES = [TIE, COPY]
# A key with more rows than this is cut, into chunks of at most this many rows.
MAX_ROWS = 1_000_000
# A table is collected and broadcast up to this many rows and bytes, and joined by a shuffle beyond.
SMALL_ROWS, SMALL_BYTES = 100_000, 32 * 1024 * 1024


class Split(NamedTuple):
    """When ``is_split``, ``df`` has a ``_chunk`` column: 0 for keys left whole, rising from 1 on in a cut key. It also has
    the columns ``TIES``, by which rows of one order value follow each other, within chunks and from one to the next."""

    df: DataFrame
    is_split: bool


def small_copy(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame | None:
    """The rows of ``df`` as a local table, or None when they exceed ``max_rows`` or ``SMALL_BYTES``.

    What was computed to find out is what is used afterwards, so ``df`` runs once.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > SMALL_BYTES:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema) if rows.num_rows else df.sparkSession.createDataFrame([], df.schema)


def join_keys(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on all of ``keys``, a null key meeting a null key; the keys come out once."""
    other = {k: f"_side_{k}" for k in keys}
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in other.items()])
    joined = df.join(side.withColumnsRenamed(other), same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*other.values())


def _comparable(df: DataFrame) -> list[str]:
    """Columns that can be hashed and grouped by."""
    def plain(kind) -> bool:
        name = kind.simpleString()
        return "map<" not in name and "variant" not in name

    return [f.name for f in df.schema.fields if plain(f.dataType)]


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row, as an order among rows that have no other."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in _comparable(df)])


def with_tie(df: DataFrame) -> DataFrame:
    """``df`` with the hash of each row, unless it brings one along."""
    return df if TIE in df.columns else df.withColumn(TIE, row_hash(df))


def _numbered_copies(rows: DataFrame) -> DataFrame:
    """Identical rows counted, before they are shuffled, and put out again with a number each."""
    names = rows.columns
    if len(_comparable(rows)) < len(names):
        return rows.withColumn(COPY, F.lit(0).cast("long"))
    counted = rows.groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.count(F.lit(1)).alias("_times"))
    return counted.withColumn(COPY, F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).drop("_times")


def _cut(hot_rows: DataFrame, keys: list[str], seq: str, max_rows: int) -> DataFrame:
    """``hot_rows`` with their chunks, by one distributed sort.

    The order is total but for what cannot be told apart: keys, ``seq``, the hash of the row, a number among identical rows;
    nulls come first. Chunks are ``max_rows`` neighbours of a sorted partition, fewer where a partition or a key ends, so
    neither the spacing of ``seq`` nor how many rows have one ``seq`` matters, and a row costs the same however many chunks
    there are. ``ROW`` numbers the rows of a sorted partition without gaps, from the partition's number times 2 ** 33 on. The
    rows are written with both, since sorting them again could limit the partitions elsewhere.
    """
    spark, order = hot_rows.sparkSession, [*keys, seq, *TIES]
    cut = (
        hot_rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(ROW, F.monotonically_increasing_id())
        .withColumn(CHUNK, F.expr(f"{ROW} div {max_rows} + 1"))
    )
    path = new_scratch(spark, "chunks")
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def _hot_and_cold(df: DataFrame, keys: list[str], seq: str, max_rows: int) -> tuple[DataFrame, DataFrame] | None:
    """Rows of keys above ``max_rows`` as :func:`_cut` gives them, and all other rows; None when no key is hot."""
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows).select(*keys)
    local = small_copy(hot)
    if local is not None and local.isEmpty():
        return None
    side = hot if local is None else F.broadcast(local)
    df = with_tie(df)
    placed = _cut(_numbered_copies(join_keys(df, side, keys, "left_semi")), keys, seq, max_rows)
    return placed, join_keys(df, side, keys, "left_anti").withColumn(COPY, F.lit(0).cast("long"))


def split_hot_keys(df: DataFrame, keys: Sequence[str], seq: str, max_rows: int = MAX_ROWS) -> Split:
    """Cut every key holding more than ``max_rows`` rows into chunks of at most as many along a total order.

    The order is the column ``seq``, then the hash of the row, then a number among identical rows, so a key whose rows
    all have one ``seq``, or none, is cut as well. One aggregation over the key columns (combined map-side) decides whether
    any key is hot; when none is, the frame comes back untouched. A null key is a key like any other. The table of hot
    keys has at most one row per ``max_rows`` rows; it is broadcast only while that is little. Rows of hot keys are sorted
    and written to the shared scratch folder once.
    """
    parts = _hot_and_cold(df, list(keys), seq, max_rows)
    if parts is None:
        return Split(df, False)
    placed, cold = parts
    return Split(placed.drop(ROW).unionByName(cold.withColumn(CHUNK, F.lit(0).cast("long"))), True)


def row_index(df: DataFrame, keys: Sequence[str], seq: str, name: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """0-based position of each row within its key by ``seq``, without a whole key in one task. Rows of one ``seq`` are
    numbered by their hash, the same whether the key was cut or not. Rows of hot keys are numbered as they were sorted;
    what is summed up in order has a row per key and sorted partition."""
    keys = list(keys)
    parts = _hot_and_cold(df, keys, seq, max_rows)
    if parts is None:
        order = Window.partitionBy(*keys).orderBy(seq, row_hash(df))
        return df.withColumn(name, (F.row_number().over(order) - 1).cast("long"))
    placed, cold = parts
    placed = placed.withColumn(PART, F.shiftright(ROW, 33))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*keys, PART).agg(F.min(ROW).alias("_first"), F.count(F.lit(1)).alias("_m"))
        .select(*keys, PART, (F.coalesce(F.sum("_m").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    )
    local = small_copy(offsets)
    numbered = join_keys(placed, offsets if local is None else F.broadcast(local), [*keys, PART]).withColumn(
        name, (F.col(ROW) + F.col("_offset")).cast("long"))
    order = Window.partitionBy(*keys).orderBy(seq, *TIES)
    return numbered.drop(CHUNK, ROW, PART, "_offset").unionByName(
        cold.withColumn(name, (F.row_number().over(order) - 1).cast("long"))).drop(*TIES)


def arrival_index(
    df: DataFrame, keys: Sequence[str], name: str, arrival: str = "arrival", max_rows: int = MAX_ROWS,
) -> DataFrame:
    """As :func:`row_index` for rows ordered by their place in the files they were read from.

    The chunks are stretches of ``max_rows`` running numbers within a file block, so that a file that one task reads
    whole (compressed, or with values over several lines) is no chunk of its own. They are counted in a first pass and
    summed up; the one table summed in order has a row per stretch.
    """
    keys = list(keys)
    placed = df.withColumns({
        "_file": F.col(arrival)["file"], "_block": F.col(arrival)["block"],
        "_part": F.floor(F.col(arrival)["row"] / max_rows)})
    chunk = [*keys, "_file", "_block", "_part"]
    before = Window.partitionBy(*keys).orderBy("_file", "_block", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*chunk).agg(F.count(F.lit(1)).alias("_m"))
        .select(*chunk, F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.row_number().over(Window.partitionBy(*chunk).orderBy(F.col(arrival)["row"])) - 1
    return (
        placed.withColumn("_local", local)
        .transform(join_keys, offsets, chunk)
        .withColumn(name, (F.col("_offset") + F.col("_local")).cast("long"))
        .drop("_local", "_offset", "_file", "_block", "_part")
    )


def join_small(df: DataFrame, side: DataFrame, on: Sequence[str], how: str, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Join ``side`` by broadcast when it is small, otherwise by a shuffled join.

    ``side`` runs once: its rows, collected up to the bound, are those that are broadcast. Past the bound AQE still
    splits skewed partitions of ``df``.
    """
    local = small_copy(side, max_rows)
    return df.join(side if local is None else F.broadcast(local), list(on), how)
