"""Relational operators on whole feeds and the projections onto the unified record."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from tidemark.functions.clean import clean_number, clean_text, clean_timestamp, text_or
from tidemark.model import FLAT_FEED_ROWS, NESTED_FEED_ROWS, SOURCE_QUOTAS


def feed_head(df: DataFrame, n: int = NESTED_FEED_ROWS, seq: str = "seq") -> DataFrame:
    """First ``n`` rows in arrival order."""
    return df.orderBy(seq).limit(n)


def top_by_market_cap(df: DataFrame, n: int = FLAT_FEED_ROWS, tie: str = "seq") -> DataFrame:
    """The ``n`` largest by market cap; missing values come last, ties by arrival."""
    return df.orderBy(F.desc_nulls_last("market_cap"), tie).limit(n)


def top_n_per_source(df: DataFrame, quotas: Mapping[str, int] = SOURCE_QUOTAS, seq: str = "seq") -> DataFrame:
    """First rows of each source up to its own quota; sources without a quota give none.

    The literal bound on the rank lets Spark trim each map partition before the shuffle.
    """
    quota = reduce(
        lambda acc, kv: acc.when(F.col("source") == kv[0], kv[1]),
        list(quotas.items())[1:],
        F.when(F.col("source") == next(iter(quotas)), quotas[next(iter(quotas))]),
    )
    order = Window.partitionBy("source").orderBy(seq)
    return (
        df.filter(F.col("source").isin(*quotas))
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= max(quotas.values()))
        .filter(F.col("_rank") <= quota)
        .drop("_rank")
    )


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds, duplicates kept; order lives in the feeds' own order column."""
    return reduce(lambda a, b: a.unionByName(b), feeds)


def _has(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None)


def _number(df: DataFrame, name: str) -> Column:
    """A number for a text column; a column that is a number already only gets its missing values filled."""
    if name not in df.columns:
        return F.lit(0.0)
    if isinstance(df.schema[name].dataType, NumericType):
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return clean_number(name)


def normalize_csv(
    mapped: DataFrame, run_ts: Column | None = None, on_bad: str = "reject", epoch_unit: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Unified record from a column-mapped text feed; absent columns count as missing values."""
    symbol, name = (clean_text(_has(mapped, c).cast("string")) for c in ("symbol", "name"))
    return mapped.select(
        *keep,
        F.upper(text_or(symbol, F.lit("UNKNOWN"))).alias("symbol"),
        text_or(name, symbol, F.lit("Unknown")).alias("name"),
        *[_number(mapped, c).alias(c)
          for c in ("price_usd", "volume_24h", "market_cap", "percent_change_24h")],
        clean_timestamp(_has(mapped, "timestamp").cast("string"), run_ts, on_bad, epoch_unit=epoch_unit)
        .alias("timestamp"),
        F.lit("csv").alias("source"),
        "raw_data",
    )


def _normalize_json(
    feed: DataFrame, paths: Mapping[str, str], source: str, run_ts: Column | None, on_bad: str,
    keep: tuple[str, ...],
) -> DataFrame:
    # A bare number is epoch milliseconds in these feeds; digits in quotes are a text that is no date.
    text = F.col("last_updated")
    own = F.try_variant_get(F.try_parse_json("raw_data"), "$.last_updated", "variant")
    quoted = F.coalesce(F.schema_of_variant(own) == "STRING", F.lit(False))  # looked up for digits only
    stamp = F.when(
        text.rlike("^-?[0-9]+$"),
        F.when(quoted, clean_timestamp(text)).otherwise(clean_timestamp(text.try_cast("long"), numeric=True)),
    ).otherwise(clean_timestamp(text))
    if on_bad == "now":
        stamp = F.coalesce(stamp, run_ts)
    return feed.select(
        *keep,
        F.upper(text_or(F.col("symbol"), F.lit("UNKNOWN"))).alias("symbol"),
        text_or(F.col("name"), F.lit("Unknown")).alias("name"),
        *[clean_number(path).alias(field) for field, path in paths.items()],
        stamp.alias("timestamp"),
        F.lit(source).alias("source"),
        "raw_data",
    )


# Unified figure -> path in the feed.
NESTED_PATHS = {
    "price_usd": "quotes.USD.price",
    "volume_24h": "quotes.USD.volume_24h",
    "market_cap": "quotes.USD.market_cap",
    "percent_change_24h": "quotes.USD.percent_change_24h",
}
FLAT_PATHS = {
    "price_usd": "current_price",
    "volume_24h": "total_volume",
    "market_cap": "market_cap",
    "percent_change_24h": "price_change_percentage_24h",
}


def normalize_nested(
    feed: DataFrame, run_ts: Column | None = None, on_bad: str = "reject", keep: tuple[str, ...] = (),
    source: str = "coinpaprika",
) -> DataFrame:
    """Unified record from the feed with figures under ``quotes.USD``."""
    return _normalize_json(feed, NESTED_PATHS, source, run_ts, on_bad, keep)


def normalize_flat(
    feed: DataFrame, run_ts: Column | None = None, on_bad: str = "reject", keep: tuple[str, ...] = (),
    source: str = "coingecko",
) -> DataFrame:
    """Unified record from the feed with figures at the top level."""
    return _normalize_json(feed, FLAT_PATHS, source, run_ts, on_bad, keep)


def to_normalized(df: DataFrame) -> DataFrame:
    """The record without its payload."""
    return df.drop("raw_data")
