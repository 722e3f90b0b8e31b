"""A key with most of the rows is cut into chunks; results must equal the uncut ones and a brute force."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import monitor, outliers
from tidemark.operators.load import assign_batches
from tidemark.operators.skew import CHUNK, arrival_index, join_small, row_index, split_hot_keys
from tidemark.plans import bindings, catalogue
from tidemark.sources.feeds import arrival


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows, seq = [], 0
    for _ in range(3000):
        # Gaps and bursts in the order column, half of all rows on one key.
        seq += 1 if rnd.random() < 0.9 else rnd.randint(2, 500)
        key = "HOT" if rnd.random() < 0.5 else f"K{rnd.randint(0, 40)}"
        rows.append((seq, key, "price_usd", round(rnd.lognormvariate(3, 1), 3),
                     rnd.choice(["failed", "failed", "failed", "success", "partial_success"])))
    return rows, spark.createDataFrame(rows, "seq long, symbol string, field string, value double, status string").repartition(8)


def as_set(df):
    return {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()}


def test_split_is_balanced_and_ordered(skewed):
    rows, df = skewed
    split, is_split = split_hot_keys(df, ["symbol"], "seq", 100)
    assert is_split and split.count() == len(rows)
    got = split.select("symbol", "seq", CHUNK).orderBy("symbol", "seq").collect()
    hot = [r[CHUNK] for r in got if r["symbol"] == "HOT"]
    assert hot == sorted(hot) and len(set(hot)) > 8
    assert max(hot.count(c) for c in set(hot)) <= 200
    assert {r[CHUNK] for r in got if r["symbol"] != "HOT"} == {0}


def test_no_hot_key_leaves_the_frame_alone(skewed):
    _, df = skewed
    assert split_hot_keys(df, ["symbol"], "seq", 10_000) == (df, False)


def test_row_index(skewed):
    rows, df = skewed
    want, seen = set(), {}
    for seq, key, *_ in sorted(rows):
        want.add((seq, seen.get(key, 0)))
        seen[key] = seen.get(key, 0) + 1
    for max_rows in (60, 10_000):
        assert as_set(row_index(df, ["symbol"], "seq", "i", max_rows).select("seq", "i")) == want


def test_batches_of_a_hot_source(skewed):
    rows, df = skewed
    feed = df.withColumnRenamed("symbol", "source")
    assert as_set(assign_batches(feed, max_rows=60).select("seq", "batch")) == as_set(
        assign_batches(feed).select("seq", "batch"))


@pytest.mark.parametrize("max_rows", [5, 60, 400, 10_000])
def test_trailing_stats(skewed, max_rows):
    rows, df = skewed
    want, history = {}, {}
    for seq, key, _, value, _ in sorted(rows):
        last = history.setdefault(key, [])[-20:]
        want[seq] = (len(last), sum(last) / len(last) if last else None,
                     statistics.pstdev(last) if last else None, last[-1] if last else None)
        history[key].append(value)
    got = outliers.trailing_stats(df.drop("status"), max_rows=max_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        n, mean, sigma, last_value = want[r["seq"]]
        assert (r["n"], r["last_value"]) == (n, last_value)
        assert r["mean"] == (None if mean is None else pytest.approx(mean, rel=1e-9))
        assert r["sigma"] == (None if sigma is None else pytest.approx(sigma, rel=1e-6, abs=1e-9))


@pytest.mark.parametrize("max_rows", [5, 60, 400])
def test_outliers_of_hot_symbols_with_and_without_history(spark, skewed, max_rows):
    _, df = skewed
    records = df.drop("field", "status").withColumnsRenamed({"value": "price_usd"}).withColumns({
        "volume_24h": F.when(F.col("seq") % 3 > 0, F.col("price_usd") * 2), "market_cap": F.lit(0.0),
        "percent_change_24h": F.col("price_usd") - 20})
    want = as_set(outliers.detect_outliers(records))
    assert as_set(outliers.detect_outliers(records, max_rows=max_rows)) == want
    middle = records.agg(F.percentile("seq", 0.4)).first()[0]
    early, late = records.filter(F.col("seq") <= middle), records.filter(F.col("seq") > middle)
    tail = outliers.history_tail(outliers.explode_fields(early))
    parts = as_set(outliers.detect_outliers(early, max_rows=max_rows)) | as_set(
        outliers.detect_outliers(late, tail=tail, max_rows=max_rows))
    assert parts == want and len(want) > 100


@pytest.mark.parametrize("max_rows", [5, 60, 10_000])
def test_failure_streaks(skewed, max_rows):
    rows, df = skewed
    want, run = set(), {}
    for seq, key, _, _, status in sorted(rows):
        run[key] = run.get(key, 0) + 1 if status == "failed" else 0
        if run[key]:
            want.add((seq, run[key], run[key] % 3 == 0))
    got = monitor.failure_streaks(df, ["symbol"], max_rows=max_rows).select("seq", "streak", "alert")
    assert as_set(got) == want


def test_many_chunks_cost_a_row_nothing(spark):
    """Chunks are never larger than asked for, and no row looks itself up in a list of cuts as long as the key has chunks."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, "H").alias("symbol"), (F.col("id") * 7919 % 30_011).alias("seq"))
    split, is_split = split_hot_keys(df, ["symbol"], "seq", 40)
    sizes = split.groupBy("symbol", CHUNK).agg(F.count("*").alias("n"), F.min("seq").alias("low"), F.max("seq").alias("high"))
    found = sorted(map(tuple, sizes.collect()), key=lambda r: (r[0] is None, r[1]))
    assert is_split and sum(r[2] for r in found) == 30_000 and max(r[2] for r in found) <= 40
    assert all(a[4] < b[3] for a, b in zip(found, found[1:]) if a[0] == b[0])
    assert "array" not in split._jdf.queryExecution().optimizedPlan().toString()
    cut, whole = (row_index(df, ["symbol"], "seq", "i", n) for n in (40, 10**6))
    assert as_set(cut) == as_set(whole)


def test_sorted_rows_are_not_shuffled_again_to_number_them(spark):
    """Only rows of cold keys go through a ranking window, and feeds are read from what was parsed once."""
    df = spark.range(9000).select(F.when(F.col("id") < 6000, "H").when(F.col("id") < 8000, F.lit(None)).otherwise(
        F.concat(F.lit("K"), F.col("id") % 50)).alias("symbol"), (F.col("id") * 31 % 997).alias("seq"))
    cut, whole = (row_index(df, ["symbol"], "seq", "i", n) for n in (60, 10**6))
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
    ranked = [x for x in cut._jdf.queryExecution().optimizedPlan().toString().split("\n") if "row_number()" in x]
    assert len(ranked) == 1 and CHUNK not in ranked[0]


def test_feeds_are_parsed_once(spark, tmp_path):
    rows = [(i, f"2024-01-{1 + i % 28:02d} 10:00:00", i % 7, ["view", "click", "purchase", "error", None][i % 5], float(i),
             None if i == 9 else '{"k": %d}' % (i % 20)) for i in range(200)]
    spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn(
        "ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "events.parquet"))
    path = catalogue._delivered(spark, str(tmp_path))
    for upto in ("2024-01-15", None):
        feeds = {s: f.rows() for s, f in catalogue._event_feeds(spark, str(tmp_path), path, upto).items()}
        want = bindings.dirty_ticks(spark, str(tmp_path))
        if upto:
            want = want.filter((F.col("timestamp") < upto) | F.col("timestamp").isNull())
        got = [str(r) for f in feeds.values() for r in f.collect()]
        assert sorted(got) == sorted(str(r) for r in want.collect()) and {f.columns == want.columns for f in feeds.values()} == {True}
        assert all(r["source"] == s for s in ("coinpaprika", "coingecko") for r in feeds[s].collect())
        assert not any("json" in f._jdf.queryExecution().optimizedPlan().toString() for f in feeds.values())


def test_long_streak_crosses_many_chunks(spark):
    rows = [(i, "j", "success" if i in (3, 500) else "failed") for i in range(600)]
    df = spark.createDataFrame(rows, "seq long, job string, status string")
    got = {r["seq"]: r["streak"] for r in monitor.failure_streaks(df, ["job"], max_rows=20).collect()}
    assert got == {i: (i + 1 if i < 3 else i - 3 if i < 500 else i - 500) for i in range(600) if i not in (3, 500)}


def test_arrival_index(spark, tmp_path):
    spark.range(5000).selectExpr("concat('r', id) AS v", "'s' AS source").repartition(5).write.option(
        "header", True).csv(str(tmp_path / "feed"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = arrival(spark.read.option("header", True).csv(str(tmp_path / "feed")))
        rows = arrival_index(df, ["source"], "i").select("i", "arrival").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r["i"] for r in rows) == list(range(5000))
    by_place = sorted(rows, key=lambda r: (r["arrival"]["file"], r["arrival"]["block"], r["arrival"]["row"]))
    assert [r["i"] for r in by_place] == list(range(5000))
    assert len({(r["arrival"]["file"], r["arrival"]["block"]) for r in rows}) > 5


def test_join_small_beyond_its_bound(spark):
    left, side = spark.range(1000), spark.range(50).selectExpr("id", "id * 2 AS twice")
    small, big = (join_small(left, side, ["id"], "left", n) for n in (100, 10))
    assert as_set(small) == as_set(big)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()


@pytest.mark.parametrize("identical", [False, True])
def test_a_hot_key_of_one_order_value_is_cut(spark, identical):
    n = F.lit(0).cast("long") if identical else F.col("id")
    df = spark.range(20_000).select(F.lit("K").alias("symbol"), F.lit(1).alias("seq"), n.alias("n"))
    split, is_split = split_hot_keys(df, ["symbol"], "seq", 1000)
    sizes = [r["count"] for r in split.groupBy(CHUNK).count().collect()]
    assert is_split and sum(sizes) == 20_000 and len(sizes) > 10 and max(sizes) <= 2000
    whole, cut = (row_index(df, ["symbol"], "seq", "i", m) for m in (10**9, 1000))
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
    assert [r["i"] for r in cut.select("i").orderBy("i").collect()] == list(range(20_000))


def test_tied_rows_cut_and_uncut(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 1, 2, 2, 3]), rnd.choice(["H", "H", "H", "S"]), rnd.choice(["failed", "failed", "success"]),
             float(rnd.randint(1, 60)), i % 900) for i in range(2500)]
    df = spark.createDataFrame(rows, "seq long, symbol string, status string, price_usd double, n long").withColumns({
        c: F.lit(1.0) for c in ("volume_24h", "market_cap", "percent_change_24h")})
    for function in (lambda m: monitor.failure_streaks(df, ["symbol"], max_rows=m),
                     lambda m: outliers.detect_outliers(df, keep=("n",), max_rows=m),
                     lambda m: assign_batches(df.withColumnRenamed("symbol", "source"), 7, max_rows=m)):
        whole, cut = (sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in function(m).collect()), key=repr)
                      for m in (10**9, 100))
        assert whole == cut and len(whole) > 100


def test_a_whole_file_is_numbered_in_parts(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "one.txt.gz", "wt") as f:
        f.write("\n".join(str(i) for i in range(5000)))
    lines = arrival(spark.read.text(str(tmp_path))).withColumn("source", F.lit("s"))
    got = arrival_index(lines, ["source"], "i", max_rows=300)
    assert {(int(r["value"]), r["i"]) for r in got.collect()} == {(i, i) for i in range(5000)}
    parts = lines.groupBy(F.floor(F.col("arrival.row") / 300)).count()
    assert parts.agg(F.max("count")).first()[0] <= 300
