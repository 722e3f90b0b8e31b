"""Every operator as a query over the provided tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.functions import clean, names
from tidemark.model import (
    ERROR_STEPS, OUTLIER_STEPS, REQUEST_BOUNDS_MS, RETRY_BOUNDS_S, ROW_STEPS, RUN_LATENCY_BOUNDS_S, SOURCES,
)
from tidemark.operators import drift, feeds, ledger, load, mapping, monitor, outliers, serve, validate
from tidemark.operators.skew import join_keys
from tidemark.plans import bindings as b
from tidemark.plans.load_run import Feed, load_run
from tidemark.session import new_scratch
from tidemark.sources.feeds import FLAT, NESTED, csv_payload, parse_payload, read_csv_feed, read_csv_feeds, read_json_payloads
from tidemark.sources.tables import Tables
from tidemark.streaming import ingest as stream_ingest, outliers as stream_outliers, rates as stream_rates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)
QUOTAS = {"view": 5, "click": 5, "purchase": 3}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def at(text: str):
    return F.lit(text).cast("timestamp")


def r6(c: str):
    return F.round(c, 6).alias(c)


# --- cleaning and normalising ---------------------------------------------------------------------


@query
def clean_numbers(spark, sf):
    money = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    n = F.col("l_linenumber")
    text = (
        F.when(n == 1, F.concat(F.lit("$"), money))
        .when(n == 2, F.regexp_replace(money, r"(\d)(\d{3})\.", "$1,$2."))
        .when(n == 3, F.concat(money, F.lit(" USD")))
        .when(n == 4, F.concat(F.lit("  +"), money, F.lit("e1 ")))
        .when(n == 5, F.concat(money, F.lit(".7abc")))
        .when(n == 6, F.lit("n/a")).otherwise(F.lit(""))
    )
    return b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("v")).select(
        "l_orderkey", "l_linenumber",
        clean.clean_number("v").alias("number"),
        clean.clean_number_or_null("v").alias("number_or_null"),
        clean.clean_text("v").alias("text"),
    )


def _dressed_time(e: DataFrame) -> DataFrame:
    kind, ts = F.col("event_type"), F.col("ts")
    text = (
        F.when(kind == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(kind == "purchase", F.date_format(ts, "M/d/yyyy HH:mm:ss"))
        .when(kind == "signup", F.concat(F.lit("Mon, "), F.date_format(ts, "d MMM yyyy HH:mm:ss"), F.lit(" +0000")))
        .when(F.col("k") < 50, F.unix_seconds(ts).cast("string"))
        .when(F.col("k") < 75, "not a date")
        .otherwise(F.concat(F.lit("T"), F.date_format(ts, "HH:mm:ss")))  # a time of no day
    )
    return e.withColumn("v", text)


@query
def clean_timestamps(spark, sf):
    now = F.lit(NOW).cast("timestamp")
    return _dressed_time(b.events(spark, sf)).select(
        "event_id",
        clean.clean_timestamp("v").alias("or_null"),
        clean.clean_timestamp("v", now, on_bad="now").alias("or_now"),
        clean.clean_timestamp("v", epoch_unit="s").alias("with_epoch"),
        clean.clean_timestamp(F.unix_millis("ts"), numeric=True).alias("from_millis"),
    )


def _plain_record(df: DataFrame) -> DataFrame:
    return feeds.to_normalized(df)


@query
def normalize_csv(spark, sf):
    e = b.events(spark, sf)
    feed = e.select(
        F.col("event_id").alias("seq"),
        F.when(F.col("k") < 5, F.lit("")).when(F.col("k") < 10, "   ")
        .otherwise(F.concat(F.lit(" u"), "user_id", F.lit(" "))).alias("ticker"),
        F.concat(F.lit("$"), F.col("value").cast("decimal(12,2)")).alias("price_in_usd"),
        F.when(F.col("k") % 2 == 0, F.concat(F.col("k"), F.lit(",000"))).alias("tx_volume"),
        F.col("k").cast("string").alias("vol_24h"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
    )
    mapped, _ = mapping.map_columns(csv_payload(feed))
    return _plain_record(feeds.normalize_csv(mapped, keep=("seq",)))


def _payload(spark, sf, nested: bool) -> DataFrame:
    k = F.col("k")
    symbol = F.when(k < 5, "").when(k < 10, F.lit(None)).otherwise(F.concat(F.lit("u"), "user_id")).alias("symbol")
    name = F.when(k >= 20, F.concat(F.lit("User "), "user_id")).alias("name")
    price = F.concat(F.lit("$"), F.col("value").cast("decimal(12,2)"))
    cap = F.when(k != 30, F.col("value"))
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("last_updated")
    if nested:
        usd = F.struct(price.alias("price"), k.alias("volume_24h"), cap.alias("market_cap"),
                       (k > 3).alias("percent_change_24h"))
        record = F.struct(symbol, name, F.struct(usd.alias("USD")).alias("quotes"), when)
    else:
        record = F.struct(symbol, name, price.alias("current_price"), k.alias("total_volume"),
                          cap.alias("market_cap"), when)
    # Some records have the time as a number, and a text of the same name further inside.
    inside = F.concat(F.lit('"more":{"last_updated":"soon"},"last_updated":'), F.unix_millis("ts"))
    text = F.to_json(record)
    mixed = F.when(k == 40, F.regexp_replace(text, '"last_updated":"[^"]*"', inside)).otherwise(text)
    return b.events(spark, sf).select(F.col("event_id").alias("seq"), mixed.alias("raw_data"))


@query
def normalize_nested(spark, sf):
    feed = parse_payload(_payload(spark, sf, True), NESTED)
    return _plain_record(feeds.normalize_nested(feed, keep=("seq",)))


@query
def normalize_flat(spark, sf):
    feed = parse_payload(_payload(spark, sf, False), FLAT)
    return _plain_record(feeds.normalize_flat(feed, keep=("seq",)))


@query
def to_normalized(spark, sf):
    return feeds.to_normalized(b.ticks(spark, sf))


# --- feeds ----------------------------------------------------------------------------------------


@query
def read_csv_feed_rows(spark, sf):
    """Events written as a drifted CSV feed, read back as text and normalised."""
    path = new_scratch(spark, "csv-feed")
    b.events(spark, sf).select(
        F.concat(F.lit("u"), "user_id").alias("ticker"),
        F.col("value").cast("decimal(12,2)").alias("usd_price"),
        F.col("k").alias("tx_volume"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
        F.lit("csv").alias("source"),
    ).write.option("header", True).csv(path)
    mapped, _ = mapping.map_columns(csv_payload(read_csv_feed(spark, path)))
    return _plain_record(feeds.normalize_csv(mapped))


@query
def read_csv_mixed_rows(spark, sf):
    """Two CSV files of one folder with columns in different order, and commas, quotes and line breaks in values."""
    path = new_scratch(spark, "csv-mixed")
    e = b.events(spark, sf)
    names = F.concat(F.lit('User "the '), "user_id", F.lit('", esq.'), F.when(F.col("k") < 50, "\n(late)").otherwise(""))
    first = e.filter("k % 2 = 0").select(
        F.concat(F.lit("U"), "user_id").alias("ticker"), names.alias("name"),
        F.col("value").cast("decimal(12,2)").alias("usd_price"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"))
    second = e.filter("k % 2 = 1").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"), F.col("value").cast("decimal(12,2)").alias("price_usd"),
        names.alias("name"), F.concat(F.lit("U"), "user_id").alias("ticker"))
    for i, part in enumerate((first, second)):
        part.write.mode("append" if i else "errorifexists").option("header", True).option("escape", '"').csv(path)
    mapped = [mapping.map_columns(csv_payload(f))[0] for f in read_csv_feeds(spark, path, multi_line=True)]
    return feeds.union_feeds(*[_plain_record(feeds.normalize_csv(m)) for m in mapped])


@query
def read_nested_feed_rows(spark, sf):
    path = new_scratch(spark, "nested-feed")
    _payload(spark, sf, True).select("raw_data").write.text(path)
    feed = parse_payload(read_json_payloads(spark, path), NESTED)
    return _plain_record(feeds.normalize_nested(feed))


@query
def read_flat_feed_rows(spark, sf):
    path = new_scratch(spark, "flat-feed")
    _payload(spark, sf, False).select("raw_data").write.text(path)
    feed = parse_payload(read_json_payloads(spark, path), FLAT)
    return _plain_record(feeds.normalize_flat(feed))


@query
def feed_head(spark, sf):
    return feeds.feed_head(feeds.to_normalized(b.ticks(spark, sf)), 10)


@query
def top_by_market_cap(spark, sf):
    return feeds.top_by_market_cap(feeds.to_normalized(b.ticks(spark, sf)), 20)


@query
def top_n_per_source(spark, sf):
    return feeds.top_n_per_source(feeds.to_normalized(b.ticks(spark, sf)), QUOTAS)


@query
def feed_union(spark, sf):
    t = feeds.to_normalized(b.ticks(spark, sf))
    # One feed per accepted source, and one that delivers everything else, rows without a source included.
    named = F.coalesce(F.col("source").isin(*b.SOURCE_OF), F.lit(False))
    return feeds.union_feeds(*[t.filter(F.col("source") == s) for s in b.SOURCE_OF], t.filter(~named))


# --- column mapping and drift -----------------------------------------------------------------------


@query
def alias_map(spark, sf):
    feed = b.events(spark, sf).select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("ticker"), F.col("value").alias("usd_price"),
        F.col("k").alias("tx_volume"), F.col("event_type").alias("time"),
        F.when(F.col("k") > 5, F.col("props")).alias("created_at"))
    return mapping.apply_aliases(feed)


@query
def column_scores(spark, sf):
    return mapping.score_columns(b.headers(spark, sf).select("feed", "column")).select(
        "feed", "column", "target", F.round("score", 6).alias("score"))


@query
def column_best_match(spark, sf):
    return mapping.best_match(b.headers(spark, sf).select("feed", "column")).select(
        "feed", "column", "target", F.round("score", 6).alias("score"))


@query
def column_mapping(spark, sf):
    best = mapping.best_match(b.headers(spark, sf).select("feed", "column"))
    return mapping.classify_match(best).select("feed", "column", "target", "action")


@query
def mapped_rows(spark, sf):
    feed = b.events(spark, sf).select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit(" u"), "user_id", F.lit(" ")).alias("symbol"),
        F.concat(F.lit("User "), "user_id").alias("coin_name"),
        F.concat(F.lit("$"), F.col("value").cast("decimal(12,2)")).alias("price_in_usd"),
        F.concat(F.col("k"), F.lit(",5")).alias("usd_price"),
        F.col("k").cast("string").alias("vol_24h"),
        F.concat(F.col("k"), F.lit(" %")).alias("Percent Change 24h"),
        F.col("event_type").alias("data_source"),
        F.col("event_type").alias("time"),
    )
    return mapping.map_columns(feed)[0]


@query
def unknown_columns(spark, sf):
    return mapping.unknown_columns(b.headers(spark, sf).select("feed", "column"))


@query
def feed_schema(spark, sf):
    """Header of every feed from its first payload."""
    e = b.events(spark, sf)
    payload = F.to_json(F.struct(
        F.col("k"), F.col("event_type").alias("kind"), (F.col("k") > 50).alias("big"),
        F.struct("user_id").alias("user"), F.when(F.col("k") % 2 == 0, F.col("value")).alias("price")))
    rows = e.select(F.concat(F.lit("U"), "user_id").alias("source"), F.col("event_id").alias("seq"),
                    payload.alias("raw_data"))
    return drift.infer_payload_schema(rows).select("feed", "column", "type")


def _old_new(spark, sf):
    return b.headers(spark, sf, "old"), b.headers(spark, sf, "new")


@query
def schema_changed(spark, sf):
    return drift.schema_changed(*_old_new(spark, sf))


@query
def removed_columns(spark, sf):
    return drift.removed_columns(*_old_new(spark, sf)).select("feed", "column")


@query
def added_columns(spark, sf):
    return drift.added_columns(*_old_new(spark, sf)).select("feed", "column")


@query
def drift_similarity(spark, sf):
    """Each header column against the column before it."""
    before = F.lag("column").over(Window.partitionBy("feed").orderBy("pos"))
    pairs = b.headers(spark, sf).withColumn("previous", before).filter(F.col("previous").isNotNull())
    return pairs.select("feed", "column", "previous", F.round(
        names.drift_score(names.drift_name(F.col("previous")), names.drift_name(F.col("column"))), 6).alias("similarity"))


@query
def drift_mappings(spark, sf):
    return drift.drift_mappings(*_old_new(spark, sf))


@query
def drift_classes(spark, sf):
    return drift.classify_drift(drift.drift_mappings(*_old_new(spark, sf)))


@query
def quarantine_table(spark, sf):
    """Two detections, forth and back; the later entry of a column stays."""
    old, new = _old_new(spark, sf)
    log = [
        drift.quarantine_rows(drift.classify_drift(drift.drift_mappings(x, y)), F.lit(at).cast("timestamp"))
        for x, y, at in ((old, new, "2024-01-15"), (new, old, "2024-01-31"), (old, new, "2024-02-15"))
    ]
    return drift.quarantine_table(log[0].unionByName(log[1]).unionByName(log[2])).withColumn(
        "quarantined_at", F.date_format("quarantined_at", "yyyy-MM-dd"))


@query
def schema_versions(spark, sf):
    old, new = _old_new(spark, sf)
    first = drift.register(drift.empty_registry(spark), old)
    second = drift.register(first, new)
    return drift.schema_versions(first.unionByName(second))


# --- validation -------------------------------------------------------------------------------------


@query
def valid_rows(spark, sf):
    return validate.validate(b.dirty_ticks(spark, sf)).drop("raw_data")


@query
def reject_reasons(spark, sf):
    return validate.validate_rejects(b.dirty_ticks(spark, sf)).select("seq", "error")


@query
def storage_check(spark, sf):
    return validate.storage_check(b.dirty_ticks(spark, sf)).select("seq", "storage_ok")


@query
def validation_counts(spark, sf):
    return validate.validation_counts(b.dirty_ticks(spark, sf))


def _orders(spark, sf):
    return b.table(spark, sf, "orders").select(
        F.col("o_custkey"), F.col("o_orderstatus"), F.year("o_orderdate").alias("o_year"))


@query
def duplicate_keys(spark, sf):
    return validate.duplicate_keys(_orders(spark, sf), ["o_custkey", "o_orderstatus", "o_year"])


@query
def duplicate_summary(spark, sf):
    return validate.duplicate_summary(_orders(spark, sf), ["o_custkey", "o_orderstatus", "o_year"])


# --- incremental load -------------------------------------------------------------------------------


def _target(spark, sf) -> DataFrame:
    """What an earlier run loaded: everything up to the 20th."""
    return (
        feeds.to_normalized(b.ticks(spark, sf)).filter(F.col("timestamp") < at("2024-01-20"))
        .drop("seq")
        .withColumns({"run_id": F.lit("run-1"), "created_at": at("2024-01-20")})
    )


def _staged(spark, sf) -> DataFrame:
    """A feed from the 10th on with changed prices, every row delivered twice with different prices."""
    late = feeds.to_normalized(b.ticks(spark, sf)).filter(
        F.col("timestamp") >= at("2024-01-10"))
    again = late.withColumns({"seq": F.col("seq") + 1_000_000_000_000, "price_usd": F.col("price_usd") + 2})
    return late.withColumn("price_usd", F.col("price_usd") + 1).unionByName(again)


@query
def source_watermarks(spark, sf):
    return load.source_watermarks(b.ticks(spark, sf))


@query
def incremental_rows(spark, sf):
    t = feeds.to_normalized(b.ticks(spark, sf))
    seen = t.filter((F.col("timestamp") < at(b.MIDPOINT)) & (F.col("source") != "signup"))
    return load.incremental_filter(t, load.source_watermarks(seen))


@query
def already_processed(spark, sf):
    return load.already_processed(_staged(spark, sf), _target(spark, sf))


@query
def insert_if_absent(spark, sf):
    return load.insert_if_absent(_staged(spark, sf), _target(spark, sf))


@query
def upsert(spark, sf):
    return load.upsert(_staged(spark, sf), _target(spark, sf), F.lit("run-2"), F.lit(NOW).cast("timestamp"))


@query
def batches(spark, sf):
    return load.assign_batches(b.ticks(spark, sf).select("seq", "source"))


@query
def batches_cut(spark, sf):
    """Positions in hot sources, one of them the null source, with keys cut from 40 rows on."""
    return load.assign_batches(b.dirty_ticks(spark, sf).select("seq", "source"), max_rows=40)


def _first_half_progress(spark, sf):
    seen = load.assign_batches(b.ticks(spark, sf).filter(F.col("timestamp") < at(b.MIDPOINT)).select("seq", "source"))
    return load.progress_after(
        seen.filter(F.col("source") != "signup"), F.lit("snap"), F.lit("run-1"), F.lit(NOW).cast("timestamp"))


@query
def resume_rows(spark, sf):
    indexed = load.assign_batches(b.ticks(spark, sf).select("seq", "source"))
    return load.resume_from(indexed, _first_half_progress(spark, sf))


@query
def resumed_batches(spark, sf):
    return load.resumed_batch(_first_half_progress(spark, sf))


def _progress_log(spark, sf) -> DataFrame:
    """One log row per (user, source) batch of the feed."""
    return b.ticks(spark, sf).groupBy("symbol", "source", F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("last_index"), F.max("timestamp").alias("updated_at"),
        F.max_by("volume_24h", "timestamp").alias("_k"),
    ).select(F.concat(F.lit("snap-"), "symbol").alias("batch_id"), "source",
             F.when(F.col("_k") < 50, "run-a").otherwise("run-b").alias("run_id"), "last_index", "updated_at")


@query
def latest_progress(spark, sf):
    return load.latest_progress(_progress_log(spark, sf))


@query
def list_progress(spark, sf):
    return load.list_progress(_progress_log(spark, sf), "run-a")


@query
def clear_progress(spark, sf):
    return load.clear_progress(_progress_log(spark, sf), "run-a")


def _judged(spark, sf) -> DataFrame:
    dirty = b.dirty_ticks(spark, sf)
    marks = load.source_watermarks(validate.validate(dirty.filter(
        (F.col("timestamp") < at(b.MIDPOINT)) & (F.col("source") != "csv"))))
    return load.judge_rows(dirty, marks)


@query
def load_report(spark, sf):
    return load.load_report(_judged(spark, sf))


@query
def failed_ids(spark, sf):
    return load.failed_ids(_judged(spark, sf))


def _two_loads(spark, sf, ordered: str | None = None, zone_rows: int = 1) -> Tables:
    """Two loads, the second of which replaces days of the first; between them a copy ordered by a column."""
    tables = Tables(spark, new_scratch(spark, "stored"))
    t, stamp = b.ticks(spark, sf), F.col("timestamp")
    tables.upsert(t.filter(stamp.isNull() | (stamp < at("2024-01-20"))), "run-1", at("2024-01-20"))
    if ordered:
        tables.ordered(ordered).refresh(zone_rows)
    late = t.filter(F.col("timestamp") >= at("2024-01-10"))
    tables.upsert(late.withColumn("price_usd", F.col("price_usd") + 1), "run-2", F.lit(NOW).cast("timestamp"))
    return tables


@query
def stored_tables(spark, sf):
    """Two loads into partitioned tables, read back: both tables must hold the same rows."""
    tables = _two_loads(spark, sf)
    raw = tables.raw().select("symbol", "timestamp", "source", F.get_json_object("raw_data", "$.k").alias("k"))
    return join_keys(tables.normalized(), raw, ["symbol", "timestamp", "source"], "inner")


def _delivered(spark, sf) -> str:
    """The dirty ticks written once by the feed that delivers them, so that no feed of a run reads and parses the others'."""
    # What names no accepted source, or none, is delivered by the file feed.
    feed = F.when(F.col("source").isin(*SOURCES), F.col("source")).otherwise("csv")
    path = new_scratch(spark, "delivered")
    b.dirty_ticks(spark, sf).withColumn("feed", feed).write.partitionBy("feed").parquet(path)
    return path


def _event_feeds(spark, sf, path: str, upto: str | None) -> dict[str, Feed]:
    """Everything that had arrived by a date, rows without a readable time included; without a date everything."""
    stamp, plain = F.col("timestamp"), b.dirty_ticks(spark, sf).schema
    rows = spark.read.schema(StructType([*plain.fields]).add("feed", StringType())).parquet(path)
    rows = rows if upto is None else rows.filter(stamp.isNull() | (stamp < at(upto)))
    return {s: Feed(lambda s=s: rows.filter(F.col("feed") == s).select(*plain.names)) for s in SOURCES}


def _two_runs(spark, sf) -> Tables:
    tables, path = Tables(spark, new_scratch(spark, "ingest")), _delivered(spark, sf)
    load_run(tables, _event_feeds(spark, sf, path, "2024-01-15"), "run-1", datetime(2024, 1, 15, tzinfo=timezone.utc))
    load_run(tables, _event_feeds(spark, sf, path, None), "run-2", NOW)
    return tables


@query
def ingest_runs(spark, sf):
    """Two complete load runs; the second one sees everything again and loads only what is new."""
    return _two_runs(spark, sf).normalized()


# --- outliers ---------------------------------------------------------------------------------------


@query
def explode_fields(spark, sf):
    return outliers.explode_fields(b.ticks(spark, sf))


@query
def trailing_stats(spark, sf):
    return outliers.trailing_stats(outliers.explode_fields(b.ticks(spark, sf))).select(
        "seq", "symbol", "field", "value", "n", r6("mean"), r6("sigma"), "last_value")


@query
def detect_outliers(spark, sf):
    return outliers.detect_outliers(b.ticks(spark, sf)).withColumn("actual", F.round("actual", 6))


@query
def detect_outliers_cut(spark, sf):
    """As detect_outliers, with symbols cut from 15 rows on."""
    return outliers.detect_outliers(b.ticks(spark, sf), max_rows=15).withColumn("actual", F.round("actual", 6))


@query
def outlier_counts(spark, sf):
    return outliers.outlier_counts(outliers.detect_outliers(b.ticks(spark, sf)))


@query
def outliers_per_source(spark, sf):
    return outliers.outliers_per_source(outliers.detect_outliers(b.ticks(spark, sf), keep=("source",)))


@query
def history_stats(spark, sf):
    return outliers.history_stats(outliers.explode_fields(b.ticks(spark, sf))).withColumn("mean", F.round("mean", 6))


# --- serving ----------------------------------------------------------------------------------------


@query
def data_filter(spark, sf):
    return serve.filter_data(
        feeds.to_normalized(b.ticks(spark, sf)), symbol="u7", start="2024-01-05", end="2024-01-25 12:00:00")


@query
def data_by_source(spark, sf):
    return serve.filter_data(feeds.to_normalized(b.ticks(spark, sf)), source="purchase", start="2024-01-10")


@query
def data_sorted(spark, sf):
    return serve.sort_data(feeds.to_normalized(b.ticks(spark, sf)), "volume_24h", "asc")


def _page(spark, sf, number: int) -> DataFrame:
    df, cursor = feeds.to_normalized(b.ticks(spark, sf)), None
    for _ in range(number - 1):
        cursor = serve.page_data(df, 400, "volume_24h", "desc", cursor).cursor
    return serve.page_frame(df, 400, "volume_24h", "desc", cursor)


@query
def data_page1(spark, sf):
    return _page(spark, sf, 1)


@query
def data_page2(spark, sf):
    return _page(spark, sf, 2)


@query
def stored_page2(spark, sf):
    """As data_page2 over the stored tables, through a copy ordered by volume that a later load left behind in part."""
    copy = _two_loads(spark, sf, "volume_24h", 5_000).ordered("volume_24h")
    return copy.page_frame(400, "desc", copy.page(400).cursor)


@query
def latest_run(spark, sf):
    return serve.latest_run(b.runs(spark, sf))


@query
def run_history(spark, sf):
    return serve.run_history(b.runs(spark, sf), 50).select("*", "stats.*").drop("stats")


@query
def run_detail(spark, sf):
    return serve.run_detail(b.runs(spark, sf), "run-42").select("*", "stats.*").drop("stats")


@query
def table_counts(spark, sf):
    return serve.table_counts(b.ticks(spark, sf), validate.validate(b.dirty_ticks(spark, sf)))


@query
def run_stats(spark, sf):
    return serve.run_stats(b.runs(spark, sf))


@query
def incremental_stats(spark, sf):
    return serve.incremental_stats(b.runs(spark, sf))


# --- ledger -----------------------------------------------------------------------------------------


def _reports(spark, sf) -> DataFrame:
    """Per-source reports of one run per symbol; sources named error have a failed batch."""
    judged = _judged(spark, sf).withColumns({
        "run_id": F.coalesce("symbol", F.lit("none")), "source": F.coalesce("source", F.lit("unknown"))})
    fate = F.col("fate")
    failed = F.when(F.col("source") == "error", F.array(F.struct(
        F.col("source"), F.lit("unknown").alias("batch_num"), F.lit("lost").alias("error"),
        F.col("fetched").alias("record_count")))).otherwise(F.array().cast(
            "array<struct<source:string,batch_num:string,error:string,record_count:bigint>>"))
    none = F.array().cast("array<struct<from:string,to:string,confidence:double>>")
    some = F.array(F.struct(F.lit("coin_name").alias("from"), F.lit("name").alias("to"),
                            F.lit(0.5).cast("double").alias("confidence")))
    return judged.groupBy("run_id", "source").agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(fate == "skipped").alias("skipped_by_watermark"),
        F.count_if(fate != "skipped").alias("processed"),
        F.count_if(fate == "invalid").alias("validation_errors"),
        F.count_if(fate == "failed").alias("failed_records"),
        F.count_if(fate == "load").alias("loaded"),
    ).withColumns({
        "failed_batches": failed,
        "resumed_from_batch": F.when(F.col("source") == "csv", F.col("fetched")),
        "outliers_detected": F.lit(0).cast("long"),
        "schema_version": F.when(F.col("source") == "csv", 2).otherwise(1),
        "applied_mappings": some, "quarantined_mappings": some, "skipped_mappings": none,
        "skipped_fields": F.array(F.lit("rank")),
    })


@query
def run_summary(spark, sf):
    s = ledger.run_summary(_reports(spark, sf), F.lit(NOW).cast("timestamp"))
    return s.select("run_id", "total_fetched", "valid_records", "invalid_records", "validation_errors",
                    "failed_records", F.size("failed_batches").alias("failed_batches"),
                    F.col("resume_info")["csv"].alias("csv_resumed"), F.explode("sources").alias("source", "fetched"))


@query
def run_status(spark, sf):
    return ledger.run_status(_reports(spark, sf))


@query
def run_record(spark, sf):
    start = at("2024-01-31 23:59:00")
    rec = ledger.run_record(_reports(spark, sf), start, F.lit(NOW).cast("timestamp"))
    return rec.select(
        "run_id", "status", "rows_processed", "rows_loaded", "duplicates_skipped", "errors", "total_latency_ms",
        "schema_version", F.size("applied_mappings").alias("applied"),
        F.size("schema_warnings").alias("warnings"), F.size("failed_batches").alias("failed_batches"),
        F.size("batches").alias("batches"), F.concat_ws(",", "sources").alias("sources"),
        F.concat_ws(",", "skipped_fields").alias("skipped_fields"))


@query
def stored_summaries(spark, sf):
    """The summaries two complete load runs leave behind."""
    return _two_runs(spark, sf).summaries().select(
        "run_id", "total_fetched", "valid_records", "invalid_records", "validation_errors", "failed_records",
        F.array_join(F.array_sort(F.transform(F.map_entries("sources"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
        .alias("sources"))


@query
def ingest_ledger(spark, sf):
    """The ledger rows two complete load runs leave behind."""
    return _two_runs(spark, sf).runs().select(
        "run_id", "status", "rows_processed", "rows_loaded", "duplicates_skipped", "errors",
        F.size("batches").alias("batches"), "schema_version")


# --- monitoring -------------------------------------------------------------------------------------


@query
def counters(spark, sf):
    return monitor.counter_total(b.runs(spark, sf), ["source", "status"], F.col("rows_processed"))


@query
def request_errors(spark, sf):
    """Requests of status 400 and above by route, method and status."""
    k = F.col("k")
    requests = b.events(spark, sf).select(
        F.concat(F.lit("/"), "event_type").alias("route"),
        F.when(F.col("event_type") == "purchase", "POST").otherwise("GET").alias("method"),
        F.when(k < 70, 200).when(k < 80, 400).when(k < 90, 404).otherwise(500).alias("status"))
    return monitor.counter_total(requests.filter(F.col("status") >= 400), ["route", "method", "status"])


def _bucket_label(h: DataFrame) -> DataFrame:
    text = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("decimal(10,1)").cast("string"))
    return h.withColumns({"le": text, "sum": F.round("sum", 4)})


@query
def latency_histogram(spark, sf):
    return _bucket_label(monitor.bucket_histogram(
        b.events(spark, sf), "value", RUN_LATENCY_BOUNDS_S, ["event_type"]))


@query
def request_histogram(spark, sf):
    e = b.events(spark, sf).withColumn("ms", F.col("value") * 10)
    return _bucket_label(monitor.bucket_histogram(e, "ms", REQUEST_BOUNDS_MS, ["event_type"]))


@query
def retry_histogram(spark, sf):
    """Waits before requests, by source."""
    waits = b.events(spark, sf).withColumn("wait", F.col("value") / 20)
    return _bucket_label(monitor.bucket_histogram(waits, "wait", RETRY_BOUNDS_S, ["event_type"]))


@query
def errors_by_type(spark, sf):
    """Failed runs by source and kind of error."""
    kind = F.when(F.col("errors") > 50, "timeout").when(F.col("errors") > 20, "rate_limit").otherwise("parse")
    runs = b.runs(spark, sf).filter(F.col("status") == "failed").select(
        F.when(F.col("throttle_events") != 3, F.col("source")).alias("source"), kind.alias("type"), "errors")
    return monitor.counter_total(runs, ["source", "type"], F.col("errors"))


@query
def throttles_by_source(spark, sf):
    return monitor.counter_total(b.runs(spark, sf), ["source"], F.col("throttle_events"))


@query
def latency_quantile(spark, sf):
    hist = monitor.bucket_histogram(b.events(spark, sf), "value", RUN_LATENCY_BOUNDS_S, ["event_type"])
    p95, p50 = (monitor.histogram_quantile(hist, q, ["event_type"]) for q in (0.95, 0.5))
    both = p95.withColumn("q", F.lit("0.95")).unionByName(p50.withColumn("q", F.lit("0.50")))
    return both.select("event_type", "q", F.round("quantile", 6).alias("quantile"))


@query
def rate_5m(spark, sf):
    return monitor.counter_rate(b.ticks(spark, sf), ["source"]).withColumn("rate", F.round("rate", 9))


@query
def rate_5m_sliding(spark, sf):
    return monitor.counter_rate(b.ticks(spark, sf), ["source"], slide_s=60).withColumn("rate", F.round("rate", 9))


@query
def threshold_status(spark, sf):
    totals = b.runs(spark, sf).groupBy("job").agg(
        F.sum("rows_processed").alias("rows"), F.sum(F.coalesce("errors", F.lit(0))).alias("errors"),
        F.count_if(F.col("status") == "failed").alias("outliers"))
    for value, steps in (("rows", ROW_STEPS), ("errors", ERROR_STEPS), ("outliers", OUTLIER_STEPS)):
        totals = monitor.threshold_status(totals, value, steps, f"{value}_status")
    return totals


@query
def quota_usage(spark, sf):
    return monitor.quota_usage(b.events(spark, sf).select(b.mapped_source().alias("source"), F.col("ts").alias("timestamp")))


@query
def failure_streaks(spark, sf):
    return monitor.failure_streaks(b.runs(spark, sf).select("seq", "job", "status"), ["job"])


@query
def failure_streaks_cut(spark, sf):
    """Streaks of few hot groups, one of them the null key, with keys cut from 40 rows on."""
    source = F.when(F.col("k") != 16, F.col("event_type"))
    keyed = b.runs(spark, sf).drop("source").join(
        b.events(spark, sf).select(F.col("event_id").alias("seq"), source.alias("source")), "seq")
    keyed = keyed.withColumn("status", F.when(F.col("seq") % 4 > 0, "failed").otherwise(F.col("status")))
    return monitor.failure_streaks(keyed.select("seq", "source", "status"), ["source"], max_rows=40)


@query
def latest_gauge(spark, sf):
    return monitor.latest_gauge(b.ticks(spark, sf), ["source"], "price_usd", "seq")


# --- streaming --------------------------------------------------------------------------------------


@query
def ingest_stream(spark, sf):
    """The event file as a stream of dirty records, loaded to the end of what is there."""
    return stream_ingest.run_on_events(spark, sf).normalized()


@query
def stream_load_reports(spark, sf):
    """What each micro-batch of three overlapping deliveries fetched, skipped as late, refused and loaded."""
    tables = stream_ingest.run_on_deliveries(spark, sf)
    return spark.read.parquet(tables.path("load_reports/*"))


@query
def stream_corrections(spark, sf):
    """The table that deliveries leave in which half of the records come twice, the second time corrected."""
    return stream_ingest.run_on_deliveries(spark, sf, corrected=True).normalized()


@query
def stored_history(spark, sf):
    """Count, latest value and mean of every series, from the state that the outlier stream keeps."""
    return stream_outliers.tables_of_events(spark, sf).series.stats().withColumn("mean", F.round("mean", 6))


@query
def outlier_stream(spark, sf):
    return stream_outliers.run_on_events(spark, sf).withColumn("actual", F.round("actual", 6))


@query
def rate_stream(spark, sf):
    return stream_rates.run_on_events(spark, sf).withColumn("rate", F.round("rate", 9))
