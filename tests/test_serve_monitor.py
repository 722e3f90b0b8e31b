import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import feeds, monitor, serve


@pytest.fixture(scope="module")
def data(spark):
    rows = []
    for i in range(101):
        value = None if i % 10 == 0 else float(i % 4)
        rows.append((f"S{i % 7}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), "csv" if i % 2 else "coingecko", value))
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp, source string, volume_24h double").repartition(5).cache()


@pytest.mark.parametrize("sort_by", ["volume_24h", "symbol", "timestamp", "source"])
@pytest.mark.parametrize("sort_dir", ["asc", "desc"])
@pytest.mark.parametrize("with_day", [False, True])
def test_pages_add_up_to_the_whole(data, sort_by, sort_dir, with_day):
    if with_day and sort_by != "timestamp":
        return
    data = data.withColumn("day", F.to_date("timestamp")) if with_day else data
    whole = [tuple(r) for r in serve.sort_data(data, sort_by, sort_dir).collect()]
    pages, cursor, more = [], None, True
    while more:
        page = serve.page_data(data, 13, sort_by, sort_dir, cursor)
        rows = [tuple(r) for r in serve.sort_data(page.rows, sort_by, sort_dir).collect()]
        assert len(rows) == 13 or not page.has_more
        pages += rows
        cursor, more = page.cursor, page.has_more
    assert pages == whole


def test_nulls_are_lowest(data):
    assert serve.sort_data(data, "volume_24h", "asc").first()["volume_24h"] is None
    assert serve.sort_data(data, "volume_24h", "desc").first()["volume_24h"] == 3.0


def test_unknown_direction(data):
    with pytest.raises(ValueError):
        serve.sort_data(data, "symbol", "up")


@pytest.mark.parametrize("given,size", [
    (None, 50), ("", 50), ("x", 50), (0, 50), ("0", 50), (-3, 1), ("7", 7), ("12abc", 12), (501, 500), ("1e3", 1)])
def test_limit(given, size):
    assert serve.limit_clamp(given) == size


def test_filter(data):
    got = serve.filter_data(data, "s3", "csv", dt.datetime(2024, 1, 1, 3), "2024-01-02 07:00:00").collect()
    assert {r["timestamp"] for r in got} == {dt.datetime(2024, 1, 1, 3), dt.datetime(2024, 1, 1, 17), dt.datetime(2024, 1, 2, 7)}
    assert serve.filter_data(data).count() == 101
    dated = data.withColumn("day", F.to_date("timestamp"))
    assert serve.filter_data(dated, "s3", "csv", dt.datetime(2024, 1, 1, 3), "2024-01-02 07:00:00").count() == 3


RUN = ("run_id string, status string, start_time timestamp, end_time timestamp, rows_processed long, rows_loaded long, "
       "duplicates_skipped long, errors long, total_latency_ms long, schema_version int, throttle_events long, "
       "error_message string")


def test_empty_ledger(spark):
    runs = spark.createDataFrame([], RUN)
    assert serve.run_stats(runs).first().asDict() == {"latency_avg_ms": 0, "error_rate": 0.0}
    assert serve.incremental_stats(runs).first().asDict() == {
        "last_run_new_records": 0, "last_run_skipped": 0, "total_duplicate_prevention": 0}
    assert serve.latest_run(runs).count() == serve.run_history(runs).count() == 0


def test_stats_take_the_newest_twenty(spark):
    rows = [(f"r{i:02}", "success", None, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), 10, 0, i,
             1 if i < 5 else 2, None if i == 24 else 100, None, None, None) for i in range(25)]
    runs = spark.createDataFrame(rows, RUN)
    assert serve.run_stats(runs).first().asDict() == {"latency_avg_ms": 95, "error_rate": round(40 / 201, 4)}
    assert serve.incremental_stats(runs).first().asDict() == {
        "last_run_new_records": 10, "last_run_skipped": 24, "total_duplicate_prevention": sum(range(5, 25))}
    newest = serve.run_history(runs, 1).first()
    assert newest["run_id"] == "r24" and newest["stats"]["loaded"] == 10 and newest["schema_version"] == 1
    assert serve.run_detail(runs, "nope").count() == 0


def test_histogram_and_quantiles(spark):
    df = spark.createDataFrame([("a", v) for v in (0.05, 0.3, 0.4, 0.9, 500.0)] + [("b", None)], "l string, v double")
    hist = monitor.bucket_histogram(df, "v", [0.1, 0.5, 1], ["l"])
    got = {r["le"]: r["cumulative"] for r in hist.collect()}
    assert got == {0.1: 1, 0.5: 3, 1.0: 4, float("inf"): 5}
    assert all((r["sum"], r["count"]) == (pytest.approx(501.65), 5) for r in hist.collect())

    def at(q):
        return monitor.histogram_quantile(hist, q, ["l"]).first()["quantile"]

    assert at(0.5) == pytest.approx(0.1 + 0.4 * 1.5 / 2)
    assert at(0.1) == pytest.approx(0.05)
    assert at(0.95) == 1.0


def test_rates(spark):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(at + dt.timedelta(seconds=s), "x", n) for s, n in ((0, 30), (299, 30), (301, 60))],
                               "timestamp timestamp, l string, n long")
    got = {r["window_start"]: r["rate"] for r in monitor.counter_rate(df, ["l"], amount=F.col("n")).collect()}
    assert got == {at: 0.2, at + dt.timedelta(minutes=5): 0.2}
    sliding = {r["window_start"]: r["rate"] for r in monitor.counter_rate(
        df, ["l"], amount=F.col("n"), slide_s=15).collect()}
    assert sliding[at + dt.timedelta(seconds=15)] == pytest.approx(90 / 300)
    assert sliding[at - dt.timedelta(seconds=285)] == pytest.approx(0.1)
    assert len(sliding) == 40


def test_thresholds(spark):
    df = spark.createDataFrame([(v,) for v in (-1, 0, 99, 100, 1000)], "v long")
    got = [r["status"] for r in monitor.threshold_status(df, "v", [(0, "red"), (100, "yellow"), (1000, "green")]).collect()]
    assert got == [None, "red", "red", "yellow", "green"]


def test_quota(spark):
    at = dt.datetime(2024, 1, 1, 12, 0, 30)
    df = spark.createDataFrame([(at, "coingecko")] * 4 + [(at, "coinpaprika")] * 10 + [(at, "csv")] * 99,
                               "timestamp timestamp, source string")
    got = {r["source"]: (r["requests"], r["over_quota"], r["over_burst"]) for r in monitor.quota_usage(df).collect()}
    assert got == {"coingecko": (4, True, False), "coinpaprika": (10, False, False)}


def test_top_n_needs_a_quota(spark):
    df = spark.createDataFrame([(i, s) for i in range(9) for s in ("a", "b", "c")], "seq long, source string")
    got = feeds.top_n_per_source(df, {"a": 2, "c": 1}).collect()
    assert sorted((r["source"], r["seq"]) for r in got) == [("a", 0), ("a", 1), ("c", 0)]
