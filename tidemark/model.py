"""Schemas of the stored tables and the fixed values results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: unified record ------------------------------------------------------------
UNIFIED_FIELDS = [
    "symbol", "name", "price_usd", "volume_24h",
    "market_cap", "percent_change_24h", "timestamp", "source",
]
NUMERIC_FIELDS = ["price_usd", "volume_24h", "market_cap", "percent_change_24h"]
SOURCES = ["coinpaprika", "coingecko", "csv"]
KEY = ["symbol", "timestamp", "source"]

# --- fixed values: header aliases, in the order in which they are applied ----------------------
COLUMN_ALIASES = {
    "time": "timestamp",
    "ticker": "symbol",
    "usd_price": "price_usd",
    "tx_volume": "volume_24h",
    "created_at": "timestamp",
    "price_timestamp": "timestamp",
}

# --- fixed values: confidence classes ----------------------------------------------------------
AUTO_MAP = 0.8
QUARANTINE = 0.5

# --- fixed values: outlier rules ---------------------------------------------------------------
HISTORY = 20
MIN_HISTORY = 3
Z_LIMIT = 2.5
JUMP_LIMIT = 50.0

# --- fixed values: feed sizes and load batches -------------------------------------------------
NESTED_FEED_ROWS = 10
FLAT_FEED_ROWS = 20
SOURCE_QUOTAS = {"coinpaprika": 5, "csv": 5, "coingecko": 3}
LOAD_BATCH = 5

# --- fixed values: serving limits --------------------------------------------------------------
PAGE_LIMIT = (50, 1, 500)
HISTORY_LIMIT = (10, 1, 50)
STATS_RUNS = 20

# --- fixed values: monitoring ------------------------------------------------------------------
RUN_LATENCY_BOUNDS_S = [0.1, 0.5, 1, 2, 5, 10, 30, 60, 120, 300]
REQUEST_BOUNDS_MS = [50, 100, 200, 500, 1000, 2000, 5000]
RETRY_BOUNDS_S = [0.1, 0.5, 1, 2, 5, 10]
ROW_STEPS = [(0, "red"), (100, "yellow"), (1000, "green")]
ERROR_STEPS = [(0, "green"), (1, "yellow"), (10, "red")]
OUTLIER_STEPS = [(0, "green"), (5, "yellow"), (20, "red")]
REQUEST_QUOTAS = {"coinpaprika": (10, 15), "coingecko": (3, 5)}  # per minute, burst
ALERT_EVERY = 3

# --- stored tables -----------------------------------------------------------------------------
_MAPPING = T.ArrayType(T.StructType([
    T.StructField("from", T.StringType()),
    T.StructField("to", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
]))

_FAILED_BATCHES = T.ArrayType(T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("batch_num", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("record_count", T.LongType()),
]))

NORMALIZED = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("price_usd", T.DoubleType()),
    T.StructField("volume_24h", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("percent_change_24h", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

RAW = T.StructType(
    NORMALIZED.fields[:8] + [T.StructField("raw_data", T.StringType())] + NORMALIZED.fields[8:]
)

PROGRESS = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("last_index", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])

REGISTRY = T.StructType([
    T.StructField("feed", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("column", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("pos", T.LongType()),
])

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("duplicates_skipped", T.LongType()),
    T.StructField("errors", T.LongType()),
    T.StructField("skipped_fields", T.ArrayType(T.StringType())),
    T.StructField("total_latency_ms", T.LongType()),
    T.StructField("applied_mappings", _MAPPING),
    T.StructField("quarantined_mappings", _MAPPING),
    T.StructField("skipped_mappings", _MAPPING),
    T.StructField("schema_warnings", T.ArrayType(T.StringType())),
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("failed_batches", _FAILED_BATCHES),
    T.StructField("resume_info", T.MapType(T.StringType(), T.LongType())),
    T.StructField("throttle_events", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("batches", T.ArrayType(T.StructType([
        T.StructField("no", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("source", T.StringType()),
    ]))),
    T.StructField("sources", T.ArrayType(T.StringType())),
])

SUMMARIES = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("total_fetched", T.LongType()),
    T.StructField("valid_records", T.LongType()),
    T.StructField("invalid_records", T.LongType()),
    T.StructField("validation_errors", T.LongType()),
    T.StructField("failed_records", T.LongType()),
    T.StructField("sources", T.MapType(T.StringType(), T.LongType())),
    T.StructField("failed_batches", _FAILED_BATCHES),
    T.StructField("resume_info", T.MapType(T.StringType(), T.LongType())),
    T.StructField("timestamp", T.TimestampType()),
])

SOURCE_REPORT = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("fetched", T.LongType()),
    T.StructField("skipped_by_watermark", T.LongType()),
    T.StructField("processed", T.LongType()),
    T.StructField("validation_errors", T.LongType()),
    T.StructField("failed_records", T.LongType()),
    T.StructField("loaded", T.LongType()),
    T.StructField("failed_batches", _FAILED_BATCHES),
    T.StructField("resumed_from_batch", T.LongType()),
    T.StructField("outliers_detected", T.LongType()),
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("applied_mappings", _MAPPING),
    T.StructField("quarantined_mappings", _MAPPING),
    T.StructField("skipped_mappings", _MAPPING),
    T.StructField("skipped_fields", T.ArrayType(T.StringType())),
])
