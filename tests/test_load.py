"""Files to tables: readers, validation, runs, repeats, crashes and streams."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from tidemark.model import RAW
from tidemark.operators import drift, feeds, load, mapping, outliers, serve, validate
from tidemark.plans.load_run import Feed, load_run
from tidemark.session import partitions_for
from tidemark.sources.feeds import (
    csv_payload, read_csv_feed, read_flat_json_feed, read_nested_json_feed, unreadable_rows,
)
from tidemark.sources.tables import Tables, gather_days, write_data
from tidemark.streaming import ingest, outliers as stream_outliers

NOON = dt.datetime(2025, 10, 13, 12)
NOW = dt.datetime(2025, 10, 14, tzinfo=dt.timezone.utc)


def csv_feed(spark, path, **kw):
    mapped, _ = mapping.map_columns(csv_payload(read_csv_feed(spark, str(path))))
    return feeds.normalize_csv(mapped, keep=("arrival",), **kw)


@pytest.fixture
def alias_file(tmp_path):
    path = tmp_path / "prices.csv"
    path.write_text("ticker,usd_price,tx_volume,time,source\n"
                    "zqa,512.75,7000000,2025-10-13T12:00:00Z,csv\n"
                    " zqb ,\"$1,234.56\",8000000,2025-10-13T12:00:00Z,csv\n"
                    "ZQC,0.0625,9000000.5,2025-10-13T12:00:00Z,csv\n"
                    ",,1,never,csv\n")
    return path


def test_alias_file(spark, alias_file):
    rows = csv_feed(spark, alias_file).orderBy("arrival").collect()
    assert [(r["symbol"], r["name"], r["price_usd"], r["volume_24h"], r["market_cap"], r["percent_change_24h"],
             r["timestamp"]) for r in rows] == [
        ("ZQA", "zqa", 512.75, 7e6, 0.0, 0.0, NOON),
        ("ZQB", "zqb", 1234.56, 8e6, 0.0, 0.0, NOON),
        ("ZQC", "ZQC", 0.0625, 9000000.5, 0.0, 0.0, NOON),
        ("UNKNOWN", "Unknown", 0.0, 1.0, 0.0, 0.0, None),
    ]
    assert json.loads(rows[1]["raw_data"]) == {
        "ticker": " zqb ", "usd_price": "$1,234.56", "tx_volume": "8000000",
        "time": "2025-10-13T12:00:00Z", "source": "csv"}
    rejects = validate.validate_rejects(csv_feed(spark, alias_file)).collect()
    assert [r["error"] for r in rejects] == ['"price_usd" must be a positive number']


def test_drifted_file(spark, tmp_path):
    path = tmp_path / "drift.csv"
    path.write_text("symbol,coin_name,price_in_usd,vol_24h,market_capitalization,change_24h,timestamp_unix\n"
                    "BTC,Bitcoin,50000.50,1000000000,950000000000,2.5,1704067200\n")
    row = csv_feed(spark, path).first()
    assert (row["name"], row["price_usd"], row["volume_24h"], row["market_cap"], row["timestamp"]) == (
        "BTC", 50000.5, 0.0, 0.0, None)


def test_epoch_text_file(spark, tmp_path):
    path = tmp_path / "epoch.csv"
    path.write_text("symbol,price_usd,volume_24h,created_at,data_source\nBTC,1,2,1697198400,csv_v2\n")
    assert csv_feed(spark, path).first()["timestamp"] is None
    assert csv_feed(spark, path, epoch_unit="s").first()["timestamp"] == dt.datetime(2023, 10, 13, 12)


def test_unreadable_lines_are_listed(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("symbol,price_usd\nA,1\nB,2,extra\nC\n")
    feed = read_csv_feed(spark, str(path)).cache()
    assert [r["symbol"] for r in feed.orderBy("arrival").collect()] == ["A", "B", "C"]
    assert {r["symbol"] for r in unreadable_rows(feed).collect()} == {"B", "C"}


COINS = [
    {"symbol": "btc", "name": "Bitcoin", "last_updated": "2025-10-13T12:00:00Z", "rank": 1,
     "quotes": {"USD": {"price": 1.5, "volume_24h": "$2,000", "market_cap": None, "percent_change_24h": -0.5}}},
    {"symbol": None, "name": "", "last_updated": 1760356800000, "quotes": {}},
    {"symbol": " x ", "quotes": {"USD": {"price": True, "volume_24h": {"a": 1}}}, "last_updated": "soon"},
]
WANT = [("BTC", "Bitcoin", 1.5, 2000.0, 0.0, -0.5, NOON), ("UNKNOWN", "Unknown", 0.0, 0.0, 0.0, 0.0, NOON),
        (" X ", "Unknown", 0.0, 0.0, 0.0, 0.0, None)]


@pytest.mark.parametrize("layout", ["lines", "array"])
def test_nested_feed(spark, tmp_path, layout):
    text = json.dumps(COINS) if layout == "array" else "\n".join(json.dumps(c) for c in COINS) + "\n"
    (tmp_path / "coins.json").write_text(text)
    feed = read_nested_json_feed(spark, str(tmp_path), layout)
    rows = feeds.normalize_nested(feed, keep=("arrival",)).orderBy("arrival").collect()
    assert [tuple(r)[1:8] for r in rows] == WANT
    assert json.loads(rows[0]["raw_data"]) == COINS[0]
    assert {r["source"] for r in rows} == {"coinpaprika"}
    heads = feeds.feed_head(feeds.normalize_nested(feed, keep=("arrival",)), 2, "arrival").collect()
    assert [r["symbol"] for r in heads] == ["BTC", "UNKNOWN"]


def test_flat_feed(spark, tmp_path):
    coin = {"symbol": "eth", "name": "Ether", "current_price": 3400.5, "total_volume": 7, "market_cap": 9,
            "price_change_percentage_24h": 1.25, "last_updated": "2025-10-13T12:00:00.000Z"}
    (tmp_path / "coins.json").write_text(json.dumps([coin]))
    row = feeds.normalize_flat(read_flat_json_feed(spark, str(tmp_path), "array")).first()
    assert tuple(row)[:8] == ("ETH", "Ether", 3400.5, 7.0, 9.0, 1.25, NOON, "coingecko")


# --- tables and runs --------------------------------------------------------------------------------


def rows(spark, items, source="csv"):
    data = [(i, s, s, float(p), 1.0, 0.0, 0.0, NOON + dt.timedelta(hours=h), source, '{"i": %d}' % i)
            for i, (s, p, h) in enumerate(items)]
    return spark.createDataFrame(
        data, "seq long, symbol string, name string, price_usd double, volume_24h double, market_cap double, "
              "percent_change_24h double, timestamp timestamp, source string, raw_data string")


def stored(tables):
    return {(r["symbol"], r["timestamp"]): (r["price_usd"], r["run_id"], r["created_at"])
            for r in tables.normalized().collect()}


def stamp(day):
    return F.lit(dt.datetime(2025, 11, day)).cast("timestamp")


def test_upsert_is_idempotent_and_keeps_created_at(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.upsert(rows(spark, [("A", 1, 0), ("B", 2, 0), ("A", 3, 30)]), "r1", stamp(1))
    tables.upsert(rows(spark, [("A", 9, 0), ("A", 10, 0), ("C", 4, 60)]), "r2", stamp(2))
    first = stored(tables)
    one, two = dt.datetime(2025, 11, 1), dt.datetime(2025, 11, 2)
    assert first == {
        ("A", NOON): (10.0, "r2", one), ("B", NOON): (2.0, "r1", one),
        ("A", NOON + dt.timedelta(hours=30)): (3.0, "r1", one), ("C", NOON + dt.timedelta(hours=60)): (4.0, "r2", two)}
    tables.upsert(rows(spark, [("A", 9, 0), ("A", 10, 0), ("C", 4, 60)]), "r2", stamp(2))
    assert stored(tables) == first
    assert validate.duplicate_keys(tables.normalized()).count() == 0
    assert tables.raw().columns == RAW.names
    assert {r["raw_data"] for r in tables.raw().filter("symbol = 'A'").collect()} == {'{"i": 1}', '{"i": 2}'}


def test_upsert_reads_only_the_days_it_touches(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.upsert(rows(spark, [("A", 1, 24 * d) for d in range(6)]), "r1", stamp(1))
    touched = tables.affected_days("raw", RAW, rows(spark, [("Z", 1, 48)]))
    assert touched.count() == 1
    assert pruned_by_day(touched)


def pruned_by_day(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return bool(re.search(r"PartitionFilters: \[[^\]]*day#", plan))


def test_marks_come_from_the_newest_days(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.upsert(rows(spark, [("A", 1, 30 * d) for d in range(6)]), "r1", stamp(1))
    tables.upsert(rows(spark, [("A", 1, 2)], "coingecko"), "r2", stamp(1))
    marks = tables.watermarks()
    assert {r["source"]: r["watermark"] for r in marks.collect()} == {
        "csv": NOON + dt.timedelta(hours=150), "coingecko": NOON + dt.timedelta(hours=2)}
    assert as_rows(marks) == as_rows(load.source_watermarks(tables.normalized()))


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_pages_of_a_stored_table(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.upsert(rows(spark, [(f"S{i % 5}", 1, i * 3) for i in range(60)]), "r1", stamp(1))
    want = [r["timestamp"] for r in serve.sort_data(tables.normalized()).collect()]
    got, cursor, more = [], None, True
    while more:
        page = serve.page_data(tables.served(), 7, cursor=cursor)
        got += [r["timestamp"] for r in serve.sort_data(page.rows).collect()]
        cursor, more = page.cursor, page.has_more
    assert got == want
    head = serve.page_frame(tables.served(), 8)
    assert head.count() == 8 and pruned_by_day(head)
    assert pruned_by_day(serve.filter_data(tables.served(), start=NOON))


def test_many_days_fall_back_to_a_join(spark, tmp_path, monkeypatch):
    from tidemark.sources import tables as module

    tables = Tables(spark, str(tmp_path))
    tables.upsert(rows(spark, [("A", 1, 24 * d) for d in range(6)]), "r1", stamp(1))
    monkeypatch.setattr(module, "MAX_LISTED", 2)
    tables.upsert(rows(spark, [("A", 7, 24 * d) for d in range(4)]), "r2", stamp(2))
    assert sorted(v[0] for v in stored(tables).values()) == [1.0, 1.0, 7.0, 7.0, 7.0, 7.0]


def test_recover_finishes_a_cut_short_publish(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.upsert(rows(spark, [("A", 1, 0)]), "r1", stamp(1))
    staged = rows(spark, [("A", 5, 0), ("B", 6, 48)])
    merged = load.upsert(staged, tables.affected_days("raw", RAW, staged), F.lit("r2"), stamp(2))
    write_data(gather_days(merged), tables.path("pending/r2"), "overwrite", "static")
    tables._log_load("r2", "ready")
    assert tables.recover() == ["r2"]
    assert {k[0]: v[0] for k, v in stored(tables).items()} == {"A": 5.0, "B": 6.0}
    assert tables.recover() == []


def test_insert_if_absent(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.upsert(rows(spark, [("A", 1, 0)]), "r1", stamp(1))
    got = load.insert_if_absent(rows(spark, [("A", 2, 0), ("B", 3, 0), ("B", 4, 0)]), tables.normalized())
    assert [(r["symbol"], r["price_usd"]) for r in got.collect()] == [("B", 3.0)]


def test_plain_writes(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    full = rows(spark, [("A", 1, 0), ("B", 2, 30)]).withColumns({"run_id": F.lit("r"), "created_at": stamp(1)})
    tables.write_raw(full)
    tables.write_normalized(full)
    assert as_rows(tables.raw()) == as_rows(full.select(*RAW.names))
    assert as_rows(tables.normalized()) == as_rows(feeds.to_normalized(full.select(*RAW.names)))
    assert {r["table"]: r["rows"] for r in serve.table_counts(tables.raw(), tables.normalized()).collect()} == {
        "raw": 2, "normalized": 2}


def test_partition_numbers():
    assert partitions_for(10, 8) == 16
    assert partitions_for(100 * 1024**4, 8) == 819_200


def run(tables, items, run_id, snapshot=None, **more):
    spark = tables.spark
    feeds_ = {"csv": Feed(lambda: rows(spark, items)), **more}
    return load_run(tables, feeds_, run_id, NOW, snapshot).first()


def test_runs(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    first = run(tables, [("A", 1, 0), ("B", 0, 0), ("C" * 30, 1, 0), ("D", 2, 1)], "r1")
    assert (first["status"], first["rows_processed"], first["rows_loaded"], first["errors"]) == ("success", 4, 2, 2)
    again = run(tables, [("A", 1, 0), ("D", 2, 1), ("E", 3, 2)], "r2")
    assert (again["rows_processed"], again["rows_loaded"], again["duplicates_skipped"]) == (1, 1, 2)
    summary = {r["run_id"]: r for r in tables.summaries().collect()}
    assert summary["r1"]["total_fetched"] == 4 and summary["r1"]["invalid_records"] == 2
    assert summary["r2"]["sources"] == {"csv": 3}
    assert load.latest_progress(tables.progress()).count() == 0
    failed = spark.read.parquet(tables.path("failed/r1")).collect()
    assert [r["symbol"] for r in failed] == ["C" * 30]


def broken():
    raise RuntimeError("feed is down")


def test_a_failing_feed_spares_the_others_and_is_resumed(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    items = [("A", 1, 0), ("B", 2, 0)]
    first = run(tables, items, "r1", "monday", coingecko=Feed(broken))
    assert first["status"] == "partial_success" and first["rows_loaded"] == 2
    assert [(b["source"], b["error"]) for b in first["failed_batches"]] == [("coingecko", "feed is down")]
    kept = load.list_progress(tables.progress(), "r1").collect()
    assert [(r["batch_id"], r["last_index"]) for r in kept] == [("monday_csv", 2)]
    ok = Feed(lambda: rows(spark, [("G", 4, 0)], "coingecko"))
    second = run(tables, items, "r2", "monday", coingecko=ok)
    assert second["status"] == "success" and second["rows_loaded"] == 1
    assert {k[0] for k in stored(tables)} == {"A", "B", "G"}
    grown = run(tables, [*items, *[("N", 5, i) for i in range(9)]], "r3", "tuesday")
    assert grown["rows_loaded"] == 8  # the first of the nine is not newer than the mark


def test_resume_number(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    items = [(f"S{i}", 1, i) for i in range(12)]
    run(tables, items, "r1", "snap", coingecko=Feed(broken))
    more = run(tables, items + [("T", 1, 50)], "r2", "snap", coingecko=Feed(broken))
    assert more["resume_info"] == {"csv": 2} and more["rows_loaded"] == 1


def test_repeated_run_does_not_lose_or_double_rows(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    items = [(f"S{i % 3}", 1 + i, i) for i in range(10)]
    run(tables, items, "r1", "snap", coingecko=Feed(broken))
    first, tail = stored(tables), tables.outlier_tail(1).count()
    # As after a crash before progress was saved: same run again, marks and history of the first attempt.
    tables.save_progress(tables.progress().limit(0), "r1-gone")
    load_run(tables, {"csv": Feed(lambda: rows(spark, items)), "coingecko": Feed(broken)}, "r1", NOW, "other")
    assert set(stored(tables)) == set(first)
    assert tables.outlier_tail(1).count() == tail


def test_rows_of_a_foreign_source_are_judged_and_counted(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    both = rows(spark, [("A", 1, 0)]).unionByName(rows(spark, [("B", 1, 0), ("C", 1, 0)], "elsewhere")).unionByName(
        rows(spark, [("D", 1, 0)], None)).withColumn("seq", F.monotonically_increasing_id())
    record = load_run(tables, {"csv": Feed(lambda: both)}, "r1", NOW).first()
    assert (record["rows_processed"], record["rows_loaded"], record["errors"]) == (4, 1, 3)
    assert tables.summaries().first()["sources"] == {"csv": 4}


def test_an_error_without_text_is_told_by_its_kind(spark, tmp_path):
    def silent():
        raise KeyboardInterruptError
    class KeyboardInterruptError(Exception):
        pass
    record = run(Tables(spark, str(tmp_path)), [("A", 1, 0)], "r1", coingecko=Feed(silent))
    assert [b["error"] for b in record["failed_batches"]] == ["KeyboardInterruptError"]


def test_half_written_start_state_is_not_trusted(spark, tmp_path):
    items = [(f"S{i % 3}", 1 + i, i) for i in range(10)]
    for name, broken_off in (("clean", False), ("cut", True)):
        tables = Tables(spark, str(tmp_path / name))
        run(tables, items[:6], "r1")
        if broken_off:  # as left behind by a driver killed while it wrote them
            for folder in ("marks/r2", "tail_start/r2-csv.0"):
                (tmp_path / name / folder / "_temporary" / "0").mkdir(parents=True)
        run(tables, items, "r2")
    clean, cut = (Tables(spark, str(tmp_path / n)) for n in ("clean", "cut"))
    assert stored(clean).keys() == stored(cut).keys()
    assert {k: v[:2] for k, v in stored(clean).items()} == {k: v[:2] for k, v in stored(cut).items()}
    assert [r.asDict() for r in clean.outlier_tail(2).orderBy("seq", "field").collect()] == [
        r.asDict() for r in cut.outlier_tail(2).orderBy("seq", "field").collect()]


def test_forgotten_loads_leave_the_tables(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    for i in range(3):
        run(tables, [(f"S{i}", 1, i)], f"r{i}")
        tables.forget(f"r{i}")
    assert {k[0] for k in stored(tables)} == {"S0", "S1", "S2"}
    for kept in ("staged", "pending", "marks", "tail_start"):
        assert [p.name for p in (tmp_path / kept).iterdir() if not p.name.startswith((".", "_"))] == []


def test_progress_is_cleared_by_snapshot(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    items = [("A", 1, 0), ("B", 2, 0)]
    run(tables, items, "r1", "monday", coingecko=Feed(broken))
    run(tables, items, "r2", "monday", coingecko=Feed(lambda: rows(spark, [("G", 4, 0)], "coingecko")))
    assert load.latest_progress(tables.progress()).count() == 0


def test_headers_of_runs(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))

    def header(*names):
        data = [("csv", n, "string", i) for i, n in enumerate(names)]
        return lambda: spark.createDataFrame(data, "feed string, column string, type string, pos long")

    first = load_run(tables, {"csv": Feed(lambda: rows(spark, [("A", 1, 0)]), header("symbol", "price", "volume_24h"))}, "r1", NOW).first()
    assert first["schema_version"] == 1 and first["applied_mappings"] == []
    second = load_run(tables, {"csv": Feed(lambda: rows(spark, [("A", 1, 1)]), header("ticker", "prices", "vol_24"))}, "r2", NOW).first()
    assert second["schema_version"] == 2
    assert {(m["from"], m["to"], m["confidence"]) for m in second["applied_mappings"]} == {
        ("symbol", "ticker", 1.0), ("price", "prices", 0.9)}
    assert {(m["from"], m["to"]) for m in second["quarantined_mappings"]} == {("volume_24h", "vol_24")}


def test_run_that_fails_as_a_whole_is_logged(spark, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path))
    monkeypatch.setattr(tables, "upsert", lambda *a, **k: broken())
    with pytest.raises(RuntimeError):
        run(tables, [("A", 1, 0)], "r1")
    row = tables.runs().first()
    assert (row["status"], row["errors"], row["error_message"]) == ("failed", 1, "feed is down")


# --- outliers in parts and streams ------------------------------------------------------------------


def series(spark, n=160):
    values = [100 + (i * 37 % 11) + (400 if i % 23 == 7 else 0) for i in range(n)]
    return rows(spark, [(f"S{i % 3}", v, i) for i, v in enumerate(values)])


def found(df):
    return {(r["seq"], r["field"], r["type"], round(r["actual"], 6)) for r in df.collect()}


def test_outliers_in_parts_equal_the_whole(spark):
    whole = series(spark)
    want = found(outliers.detect_outliers(whole))
    assert {t for _, _, t, _ in want} == {"z_score", "percentage_jump"}
    got, tail = set(), None
    for lo, hi in ((0, 1), (1, 70), (70, 71), (71, 160)):
        part = whole.filter((F.col("seq") >= lo) & (F.col("seq") < hi))
        got |= found(outliers.detect_outliers(part, tail=tail))
        long = outliers.explode_fields(part).select("seq", "symbol", "field", "value")
        tail = outliers.history_tail(long if tail is None else long.unionByName(tail))
        tail = spark.createDataFrame(tail.collect(), tail.schema)
    assert got == want


def test_constant_history_has_no_z_score(spark):
    df = rows(spark, [("A", 0.1, i) for i in range(8)] + [("A", 0.14, 8), ("A", 0.3, 9)])
    got = found(outliers.detect_outliers(df).filter("field = 'price_usd'"))
    assert {(s, t) for s, _, t, _ in got} == {(9, "z_score")}


def test_streamed_files_equal_the_batch(spark, tmp_path):
    whole, landing = series(spark), str(tmp_path / "landing")
    tables = Tables(spark, str(tmp_path / "out"))
    for lo, hi in ((0, 50), (50, 90), (90, 160)):
        whole.filter((F.col("seq") >= lo) & (F.col("seq") < hi)).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(whole.schema).parquet(landing)
        stream_outliers.outlier_stream(stream, tables, tables.path("checkpoint")).awaitTermination()
    assert found(stream_outliers.found(tables)) == found(outliers.detect_outliers(whole))


def test_ingest_stream_skips_late_and_doubled_rows(spark, tmp_path):
    landing, tables = str(tmp_path / "landing"), Tables(spark, str(tmp_path / "out"))
    files = [[("A", 1, 0), ("A", 2, 0), ("B", 3, 5), ("X", 0, 5)], [("A", 9, 0), ("B", 9, 5), ("C", 4, 6)], [("C", 8, 6)]]
    for items in files:
        batch = rows(spark, items)
        batch.coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(batch.schema).parquet(landing)
        ingest.incremental_ingest_stream(stream, tables, tables.path("checkpoint"), lambda: stamp(1)).awaitTermination()
    assert {k[0]: v[:2] for k, v in stored(tables).items()} == {
        "A": (2.0, "batch-0"), "B": (3.0, "batch-0"), "C": (4.0, "batch-1")}
    before = stored(tables)
    ingest.load_batch(tables, rows(spark, files[1]), 1, stamp(1))
    assert stored(tables) == before


def test_payload_header(spark):
    df = spark.createDataFrame([("a", 2, '{"x": "1"}'), ("a", 1, '{"n": 1, "s": "t", "b": true, "o": {}, "l": [1], "z": null}'),
                                ("b", 1, "broken")], "source string, seq long, raw_data string")
    got = {r["column"]: r["type"] for r in drift.infer_payload_schema(df).collect()}
    assert got == {"n": "number", "s": "string", "b": "boolean", "o": "object", "l": "object", "z": "object"}


def test_file_feeds_end_to_end(spark, tmp_path, alias_file):
    (tmp_path / "coins").mkdir()
    (tmp_path / "coins" / "page.json").write_text(json.dumps(COINS))
    tables = Tables(spark, str(tmp_path / "warehouse"))

    def coins():
        return feeds.normalize_nested(read_nested_json_feed(spark, str(tmp_path / "coins"), "array"), keep=("arrival",))

    def run_files(run_id):
        return load_run(tables, {
            "coinpaprika": Feed(coins, seq="arrival"),
            "csv": Feed(lambda: csv_feed(spark, alias_file), seq="arrival"),
        }, run_id, NOW).first()

    first, second = run_files("r1"), run_files("r2")
    assert (first["status"], first["rows_processed"], first["rows_loaded"], first["errors"]) == ("success", 7, 4, 3)
    assert (second["rows_loaded"], second["duplicates_skipped"], second["errors"]) == (0, 4, 3)
    assert {(r["symbol"], r["source"]) for r in tables.normalized().collect()} == {
        ("BTC", "coinpaprika"), ("ZQA", "csv"), ("ZQB", "csv"), ("ZQC", "csv")}
    assert [(b["source"], b["rows"]) for b in first["batches"]] == [("coinpaprika", 1), ("csv", 3)]
