"""The provided tables seen as feeds, headers, ticks, runs and requests.

Each binding is a plain projection of a whole table; dirt is made from the rows' own values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.drift import with_positions

# The names a drifting header takes its columns from.
HEADER_NAMES = [
    "symbol", "ticker", "name", "coin_name", "price_usd", "usd_price", "price_in_usd", "volume_24h",
    "tx_volume", "vol_24h", "market_cap", "market_capitalization", "percent_change_24h", "change_24h",
    "timestamp", "timestamp_unix", "time", "created_at", "price_timestamp", "source", "data_source",
    "Price USD", "market-cap", "rank",
]
SOURCE_OF = {"view": "coinpaprika", "click": "coingecko", "purchase": "csv"}
MIDPOINT = "2024-01-15"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_number(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a file stream; as a pattern the path may be one file or a folder of parts."""
    schema = table(spark, sf_dir, "events").schema
    return with_number(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))


def with_number(raw: DataFrame) -> DataFrame:
    """Events with a zoned timestamp and the number in their payload as ``k``."""
    return raw.withColumns({
        "ts": F.col("ts").cast("timestamp"),
        "k": F.get_json_object("props", "$.k").cast("int"),
    })


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of(events(spark, sf_dir))


def ticks_of(e: DataFrame) -> DataFrame:
    """Unified records: every event is a quote of its user's symbol from the source named by its type."""
    return e.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("U"), "user_id").alias("symbol"),
        F.concat(F.lit("User "), "user_id").alias("name"),
        F.col("value").alias("price_usd"),
        F.col("k").cast("double").alias("volume_24h"),
        (F.col("value") * F.col("k")).alias("market_cap"),
        (F.col("value") - F.col("k")).alias("percent_change_24h"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("source"),
        F.col("props").alias("raw_data"),
    )


def mapped_source() -> Column:
    """The three accepted sources for three event types, the type itself for the rest."""
    c = F.col("event_type")
    return (
        F.when(c == "view", SOURCE_OF["view"]).when(c == "click", SOURCE_OF["click"])
        .when(c == "purchase", SOURCE_OF["purchase"]).otherwise(c)
    )


def dirty_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_of(events(spark, sf_dir))


def dirty_of(e: DataFrame) -> DataFrame:
    """Ticks with every kind of fault, picked by the payload number."""
    k = F.col("k")
    return e.select(
        F.col("event_id").alias("seq"),
        F.when(k == 0, F.lit(None)).when(k == 1, "")
        .when(k == 2, F.concat(F.lit("SYMBOL-TOO-LONG-TO-STORE-"), "user_id"))
        .otherwise(F.concat(F.lit("U"), "user_id")).alias("symbol"),
        F.when(k == 3, F.lit(None)).when(k == 4, "").otherwise(F.concat(F.lit("User "), "user_id")).alias("name"),
        F.when(k == 5, 0.0).when(k == 6, -F.col("value")).when(k == 7, F.lit(None)).when(k == 8, float("inf"))
        .when(k == 9, 1e17).otherwise(F.col("value") + 0.01).alias("price_usd"),
        F.when(k == 10, -1.0).when(k == 11, F.lit(None)).otherwise(k.cast("double")).alias("volume_24h"),
        F.when(k == 12, -5.0).when(k == 13, F.lit(None)).otherwise(F.col("value") * k).alias("market_cap"),
        F.when(k == 14, F.lit(None)).otherwise(F.col("value") - k).alias("percent_change_24h"),
        F.when(k != 15, F.col("ts")).alias("timestamp"),
        F.when(k == 16, F.lit(None)).otherwise(mapped_source()).alias("source"),
        F.when(k == 17, F.lit(None)).when(k == 18, "[1]").otherwise(F.col("props")).alias("raw_data"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows: every event is a run of its user's job."""
    k = F.col("k")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("run-"), "event_id").alias("run_id"),
        F.concat(F.lit("job-"), "user_id").alias("job"),
        (F.col("ts") - F.make_dt_interval(secs=k)).alias("start_time"),
        F.col("ts").alias("end_time"),
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "partial_success")
        .otherwise("success").alias("status"),
        F.when(k >= 5, k.cast("long")).alias("rows_processed"),
        F.when(k >= 10, (k - 1).cast("long")).when(k >= 5, F.lit(0).cast("long")).alias("rows_loaded"),
        F.when(k < 90, F.col("user_id")).alias("duplicates_skipped"),
        F.when(F.col("event_type") == "error", (k + 1).cast("long")).alias("errors"),
        F.when(k != 50, F.floor(F.col("value") * 1000)).alias("total_latency_ms"),
        F.when(k > 20, (k / 25).cast("int") + 1).alias("schema_version"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("error "), k)).alias("error_message"),
        F.when(k < 70, (F.col("user_id") % 7)).alias("throttle_events"),
        F.col("event_type").alias("source"),
    )


def header_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header cell per event: the feed is the user, the column a drifting name, the type from the event."""
    k = F.col("k")
    base = F.element_at(F.array(*[F.lit(n) for n in HEADER_NAMES]), (k % len(HEADER_NAMES)) + 1)
    return events(spark, sf_dir).select(
        F.concat(F.lit("U"), "user_id").alias("feed"),
        F.when(k < 60, base).otherwise(F.concat(base, F.lit("_"), "event_type")).alias("column"),
        F.when(F.col("event_type").isin("view", "click"), "number").otherwise("string").alias("type"),
        "event_id", "ts",
    )


def headers(spark: SparkSession, sf_dir: str, version: str = "all") -> DataFrame:
    """Header table (feed, column, type, pos); ``old`` and ``new`` are the cells before and from mid-month."""
    cells = header_cells(spark, sf_dir)
    if version == "old":
        cells = cells.filter(F.col("ts") < F.lit(MIDPOINT).cast("timestamp"))
    elif version == "new":
        cells = cells.filter(F.col("ts") >= F.lit(MIDPOINT).cast("timestamp"))
    table_ = cells.groupBy("feed", "column").agg(
        F.min_by("type", "event_id").alias("type"), F.min("event_id").alias("_first"))
    return with_positions(table_, "_first").drop("_first")
