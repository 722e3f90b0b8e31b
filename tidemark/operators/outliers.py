"""Outliers of each (symbol, field) against its trailing history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.model import HISTORY, JUMP_LIMIT, MIN_HISTORY, NUMERIC_FIELDS, Z_LIMIT
from tidemark.operators.skew import CHUNK, COPY, MAX_ROWS, TIE, TIES, split_hot_keys, with_tie

SERIES = ["symbol", "field"]


def _named(df: DataFrame) -> DataFrame:
    return df.filter(F.col("symbol").isNotNull() & (F.col("symbol") != ""))


def explode_fields(df: DataFrame, seq: str = "seq", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (record, numeric field); missing symbols, NaN and values <= 0 are not part of history."""
    slim = df.select(seq, "symbol", *keep, *[F.col(f).cast("double").alias(f) for f in NUMERIC_FIELDS])
    return (
        _named(slim)
        .unpivot([seq, "symbol", *keep], NUMERIC_FIELDS, "field", "value")
        .filter((F.col("value") > 0) & ~F.isnan("value"))
    )


def _stats(order: Window, size: int) -> dict:
    frame = order.rowsBetween(-size, -1)
    return {
        # Every row has a value, so the frame's size follows from the position.
        "n": F.least(F.row_number().over(order) - 1, F.lit(size)).cast("long"),
        "mean": F.avg("value").over(frame),
        "sigma": F.stddev_pop("value").over(frame),
        "low": F.min("value").over(frame),
        "high": F.max("value").over(frame),
        "last_value": F.lag("value", 1).over(order),
    }


def trailing_stats(long: DataFrame, seq: str = "seq", size: int = HISTORY, max_rows: int = MAX_ROWS) -> DataFrame:
    """Statistics of the previous ``size`` accepted values of the same series, current row excluded.

    Rows of one ``seq`` follow each other by their hash. A hot series is cut into chunks along that order (unless the
    frame brings its chunks along). Only the first
    ``size`` rows of a chunk look back across a cut; all they need are the last ``size`` rows of the chunks
    before. Those edge rows of the hot series alone go through a second window, so its largest group is 40
    rows per chunk, and rows marked as history join it.
    """
    if CHUNK in long.columns:
        chunked = long
    else:
        chunked, is_split = split_hot_keys(long, SERIES, seq, max_rows)
        if not is_split:
            return with_tie(long).withColumns(_stats(Window.partitionBy(*SERIES).orderBy(seq, TIE), size)).drop(TIE)

    order = Window.partitionBy(*SERIES, CHUNK).orderBy(seq, *TIES)
    inner = chunked.withColumns(_stats(order, size)).filter((F.col(CHUNK) == 0) | (F.col("n") >= size))
    edges = (
        chunked.filter(F.col(CHUNK) > 0)
        .withColumns({
            "_head": F.row_number().over(order) <= size,
            "_tail": F.lead(F.lit(1), size).over(order).isNull(),
        })
        .filter(F.col("_head") | F.col("_tail")).drop("_tail")
    )
    if "_new" in long.columns:
        seeds = chunked.filter((F.col(CHUNK) == 0) & ~F.col("_new"))
        edges = edges.unionByName(seeds.withColumn("_head", F.lit(False)))
    edges = edges.withColumns(_stats(Window.partitionBy(*SERIES).orderBy(seq, *TIES), size)).filter("_head").drop("_head")
    return inner.unionByName(edges).drop(CHUNK, *TIES)


def flag(stats: DataFrame) -> DataFrame:
    """Keep the rows whose z-score, or else whose jump from the last value, passes its limit."""
    z = F.when(
        F.col("high") > F.col("low"), F.abs(F.try_divide(F.col("value") - F.col("mean"), F.col("sigma"))))
    jump = F.when(
        F.col("last_value") > 0,
        F.abs(F.try_divide(F.col("value") - F.col("last_value"), F.col("last_value"))) * 100)
    enough = F.col("n") >= MIN_HISTORY
    kind = F.when(enough & (z > Z_LIMIT), "z_score").when(enough & (jump > JUMP_LIMIT), "percentage_jump")
    return (
        stats.withColumns({"type": kind, "_z": z, "_jump": jump})
        .filter(F.col("type").isNotNull())
        .withColumns({
            "threshold": F.when(F.col("type") == "z_score", Z_LIMIT).otherwise(JUMP_LIMIT),
            "actual": F.when(F.col("type") == "z_score", F.col("_z")).otherwise(F.col("_jump")),
        })
        .drop("n", "mean", "sigma", "low", "high", "last_value", "_z", "_jump")
    )


def detect_outliers(
    df: DataFrame,
    seq: str = "seq",
    keep: tuple[str, ...] = (),
    tail: DataFrame | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Outliers among ``df``; ``tail`` (from :func:`history_tail`) is the history that came before it.

    Hot symbols are found and cut on the records, before each of them becomes four values.
    """
    records = with_tie(_named(df))
    split, is_split = split_hot_keys(records, ["symbol"], seq, max_rows)
    long = explode_fields(split, seq, (*keep, TIE, COPY, CHUNK) if is_split else (*keep, TIE))
    if tail is not None:
        none = F.lit(0).cast("long")
        seeds = tail.select(seq, *SERIES, "value").withColumns({"_new": F.lit(False), TIE: none})
        if is_split:
            seeds = seeds.withColumns({CHUNK: none, COPY: none})
        long = long.withColumn("_new", F.lit(True)).unionByName(seeds, allowMissingColumns=True)
    if is_split:
        stats = trailing_stats(long, seq)
    else:
        stats = long.withColumns(_stats(Window.partitionBy(*SERIES).orderBy(seq, TIE), HISTORY)).drop(TIE)
    found = flag(stats)
    return found if tail is None else found.filter("_new").drop("_new")


def history_tail(long: DataFrame, seq: str = "seq", size: int = HISTORY) -> DataFrame:
    """Last ``size`` accepted values per series.

    The rank filter lets Spark cut each map partition to ``size`` rows per series before the shuffle.
    """
    latest = Window.partitionBy(*SERIES).orderBy(F.desc(seq))
    return (
        long.select(seq, *SERIES, "value")
        .withColumn("_rank", F.row_number().over(latest))
        .filter(F.col("_rank") <= size)
        .drop("_rank")
    )


def history_stats(long: DataFrame, seq: str = "seq", size: int = HISTORY) -> DataFrame:
    """Count, latest value and mean over the last ``size`` values of each series."""
    return history_tail(long, seq, size).groupBy(*SERIES).agg(
        F.count("value").alias("count"),
        F.max_by("value", seq).alias("latest"),
        F.avg("value").alias("mean"),
    )


def outlier_counts(outliers: DataFrame) -> DataFrame:
    """Outliers per field, type and symbol."""
    return outliers.groupBy("field", "type", "symbol").agg(F.count(F.lit(1)).alias("outliers"))


def outliers_per_source(outliers: DataFrame) -> DataFrame:
    """Outliers per source, for a detection run with ``keep=("source",)``."""
    return outliers.groupBy("source").agg(F.count(F.lit(1)).alias("outliers"))
