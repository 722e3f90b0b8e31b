"""Cut and uncut keys give equal rows with null keys, stray order values and ties; chunks stay small."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import monitor, outliers
from tidemark.operators.load import assign_batches, resume_from
from tidemark.operators.skew import CHUNK, TIES, row_index, split_hot_keys


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    out = []
    for i in range(4000):
        key = None if i % 3 == 0 else "HOT" if i % 3 == 1 else f"K{i % 50}"
        seq = -10**15 if i == 1 else 10**15 if i == 4 else i * i
        out.append((seq, key, rnd.choice(["failed", "failed", "success"]), float(rnd.randint(1, 90))))
    return spark.createDataFrame(out, "seq long, source string, status string, value double").repartition(6).cache()


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("max_rows", [5, 70, 500])
def test_cut_is_uncut(spark, rows, max_rows):
    whole = row_index(rows, ["source"], "seq", "i")
    cut = row_index(rows, ["source"], "seq", "i", max_rows)
    assert same(cut.select(whole.columns), whole)
    progress = spark.createDataFrame([("HOT", 7)], "source string, last_index long")
    indexed = assign_batches(rows, max_rows=max_rows)
    assert resume_from(indexed, progress).count() == 4000 - 7
    streaks = [monitor.failure_streaks(rows, ["source"], max_rows=n) for n in (max_rows, 10**6)]
    assert same(*[s.select("source", "seq", "streak", "alert") for s in streaks])
    long = rows.select("seq", F.col("source").alias("symbol"), F.lit("price").alias("field"), "value")
    stats = [outliers.trailing_stats(long, max_rows=n).select(
        "seq", "symbol", "n", F.round("mean", 6), F.round("sigma", 6), "low", "high", "last_value") for n in (max_rows, 10**6)]
    assert same(*stats)


def test_stray_values_and_null_keys_leave_small_chunks(rows):
    split, is_split = split_hot_keys(rows, ["source"], "seq", 100)
    assert is_split and split.count() == 4000
    largest = split.filter(F.col(CHUNK) > 0).groupBy("source", CHUNK).count()
    assert largest.agg(F.max("count")).first()[0] <= 200
    assert largest.filter("source IS NULL").count() >= 7


def test_ties_are_cut_in_order(spark):
    rows = spark.range(3000).selectExpr("'k' AS source", "CASE WHEN id < 1500 THEN 7 ELSE id END AS seq", "id")
    split, _ = split_hot_keys(rows, ["source"], "seq", 50)
    found = [r[CHUNK] for r in split.orderBy("seq", *TIES).collect()]
    assert found == sorted(found) and max(found.count(c) for c in set(found)) <= 100
    none = spark.range(300).selectExpr("'k' AS source", "CAST(NULL AS BIGINT) AS seq")
    assert row_index(none, ["source"], "seq", "i", 50).agg(F.countDistinct("i")).first()[0] == 300
