"""Monitoring aggregates: counters, histograms, quantiles, rates, thresholds, quotas and failure streaks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.model import ALERT_EVERY, REQUEST_QUOTAS
from tidemark.operators.skew import CHUNK, MAX_ROWS, TIES, join_keys, row_hash, split_hot_keys

INF = float("inf")


def counter_total(df: DataFrame, labels: Sequence[str], amount: Column | None = None) -> DataFrame:
    """Counter per label set; counts rows when no amount is given."""
    total = F.count(F.lit(1)) if amount is None else F.coalesce(F.sum(amount), F.lit(0))
    return df.groupBy(*labels).agg(total.alias("total"))


def bucket_histogram(df: DataFrame, value: str, bounds: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Cumulative buckets per label set with sum and count.

    All buckets are counted side by side in one map-side-combined aggregation and unpivoted afterwards, so a
    row is never multiplied by the number of bounds.
    """
    v = F.col(value)
    edges = [float(b) for b in bounds]
    wide = df.filter(v.isNotNull()).groupBy(*labels).agg(
        F.array(*[F.count_if(v <= b) for b in edges], F.count(F.lit(1))).alias("_cumulative"),
        F.sum(v).alias("sum"),
        F.count(F.lit(1)).alias("count"),
    )
    all_edges = F.array(*[F.lit(b) for b in [*edges, INF]])
    return wide.select(
        *labels, F.inline(F.arrays_zip(all_edges.alias("le"), F.col("_cumulative").alias("cumulative"))),
        "sum", "count",
    )


def histogram_quantile(hist: DataFrame, q: float, labels: Sequence[str], name: str = "quantile") -> DataFrame:
    """Quantile from cumulative buckets by linear interpolation; the open bucket gives the last finite bound.

    Works on bucket rows only (a dozen per label set).
    """
    order = Window.partitionBy(*labels).orderBy("le")
    rank = F.col("count") * q
    # A first bucket with a positive bound starts at 0; one with a bound <= 0 has no start to interpolate from.
    low = F.coalesce(F.lag("le").over(order), F.lit(0.0))
    below = F.coalesce(F.lag("cumulative").over(order), F.lit(0))
    inside = low + (F.col("le") - low) * F.try_divide(rank - below, F.col("cumulative") - below)
    at = (
        F.when(F.col("le") == INF, F.lag("le").over(order))
        .when((F.col("le") <= 0) & F.lag("le").over(order).isNull(), F.col("le"))
        .otherwise(inside)
    )
    return (
        hist.withColumn("_at", at)
        .filter((F.col("cumulative") >= rank) & (F.col("count") > 0))
        .groupBy(*labels).agg(F.min_by("_at", "le").alias(name))
    )


def counter_rate(
    df: DataFrame, labels: Sequence[str], ts: str = "timestamp", amount: Column | None = None,
    span_s: int = 300, slide_s: int | None = None,
) -> DataFrame:
    """Increase per second over each window.

    A sliding rate first adds up one row per slide step and only then copies those sums into the windows
    they belong to, instead of copying every input row ``span / slide`` times.
    """
    amount = F.lit(1) if amount is None else amount
    step = slide_s or span_s
    steps = df.groupBy(F.window(ts, f"{step} seconds").alias("_step"), *labels).agg(F.sum(amount).alias("_d"))
    if step != span_s:
        spans = F.window("_at", f"{span_s} seconds", f"{step} seconds")
        steps = (
            steps.select(F.col("_step.start").alias("_at"), *labels, "_d")
            .groupBy(spans.alias("_step"), *labels).agg(F.sum("_d").alias("_d"))
        )
    return steps.select(F.col("_step.start").alias("window_start"), *labels, (F.col("_d") / span_s).alias("rate"))


def threshold_status(df: DataFrame, value: str, steps: Sequence[tuple[float, str]], name: str = "status") -> DataFrame:
    """Colour of the highest step not above the value; null below the first step."""
    colour = F.lit(None).cast("string")
    for limit, label in sorted(steps):
        colour = F.when(F.col(value) >= limit, label).otherwise(colour)
    return df.withColumn(name, colour)


def quota_usage(
    requests: DataFrame, quotas: Mapping[str, tuple[int, int]] = REQUEST_QUOTAS, ts: str = "timestamp",
) -> DataFrame:
    """Requests per source and minute against the source's quota and burst; sources without a quota drop out."""
    def pick(i: int) -> Column:
        c = F.lit(None).cast("int")
        for source, pair in quotas.items():
            c = F.when(F.col("source") == source, pair[i]).otherwise(c)
        return c

    minute = F.date_trunc("minute", F.col(ts))
    return (
        requests.filter(F.col("source").isin(*quotas))
        .groupBy("source", minute.alias("minute")).agg(F.count(F.lit(1)).alias("requests"))
        .withColumns({"quota": pick(0), "burst": pick(1)})
        .withColumns({
            "over_quota": F.col("requests") > F.col("quota"),
            "over_burst": F.col("requests") > F.col("burst"),
        })
    )


def failure_streaks(
    runs: DataFrame, keys: Sequence[str], seq: str = "seq", every: int = ALERT_EVERY, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Failed runs with their position in the current streak; every third one alerts and restarts the count.

    Only a failed run counts; success and partial success end the streak. In a hot group that had to be cut,
    a chunk starts with the failures that were still running at the end of the chunks before it.
    """
    keys = list(keys)
    failed = F.col("status") == "failed"
    split, is_split = split_hot_keys(runs, keys, seq, max_rows)
    ties = TIES if is_split else [row_hash(runs)]
    order = Window.partitionBy(*keys, *([CHUNK] if is_split else [])).orderBy(seq, *ties)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    at = F.row_number().over(order).cast("long")
    placed = split.withColumn("_at", at).withColumn(
        "_last_ok", F.last(F.when(~failed, F.col("_at")), ignorenulls=True).over(so_far))
    placed = placed.withColumn("streak", F.col("_at") - F.coalesce("_last_ok", F.lit(0)))
    if is_split:
        placed = _carry_streaks(placed, keys)
    return (
        placed.filter(failed)
        .withColumn("alert", F.col("streak") % every == 0)
        .drop("_at", "_last_ok", CHUNK, *TIES)
    )


def _carry_streaks(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Lengthen the streaks that were already running when their chunk began."""
    by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
    # One row per chunk: failures standing at its end, and whether any run in it succeeded.
    ends = placed.groupBy(*keys, CHUNK).agg(
        (F.max("_at") - F.coalesce(F.max("_last_ok"), F.lit(0))).alias("_open"),
        F.max("_last_ok").isNotNull().cast("int").alias("_any_ok"),
    )
    # A chunk with a success starts a new era; within an era the standing failures add up.
    eras = ends.withColumn("_era", F.sum("_any_ok").over(by_chunk.rowsBetween(Window.unboundedPreceding, 0)))
    standing = F.sum("_open").over(
        Window.partitionBy(*keys, "_era").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, 0))
    carried = (
        eras.withColumn("_standing", standing)
        .withColumn("_carry", F.coalesce(F.lag("_standing").over(by_chunk), F.lit(0)))
        .select(*keys, CHUNK, "_carry")
    )
    return (
        join_keys(placed, carried, [*keys, CHUNK])
        .withColumn("streak", F.col("streak") + F.when(F.col("_last_ok").isNull(), F.col("_carry")).otherwise(0))
        .drop("_carry")
    )


def latest_gauge(df: DataFrame, labels: Sequence[str], value: str, order: Column | str) -> DataFrame:
    """Last value per label set."""
    return df.groupBy(*labels).agg(F.max_by(value, order).alias("value"))
