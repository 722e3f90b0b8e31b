import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.names import drift_name
from tidemark.operators import drift, mapping


def header(spark, columns, feed="f", types=None):
    rows = [(feed, c, (types or {}).get(c, "string"), i) for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, "feed string, column string, type string, pos long")


GOLDEN = {
    "symbol": ("symbol", 1.0, "auto"),
    "coin_name": ("name", 0.556, "quarantine"),
    "price_in_usd": ("price_usd", 0.833, "auto"),
    "vol_24h": ("volume_24h", 0.7, "quarantine"),
    "market_capitalization": ("market_cap", 0.476, "skip"),
    "change_24h": ("percent_change_24h", 0.611, "quarantine"),
    "timestamp_unix": ("timestamp", 0.714, "quarantine"),
    "data_source": ("source", 0.636, "quarantine"),
    "source": ("source", 1.0, "auto"),
}


def test_golden_scores(spark):
    best = mapping.classify_match(mapping.best_match(header(spark, GOLDEN)))
    got = {r["column"]: (r["target"], round(r["score"], 3), r["action"]) for r in best.collect()}
    assert got == GOLDEN


def test_score_ties_take_the_earlier_field(spark):
    row = mapping.best_match(header(spark, ["zzzz"])).first()
    # 1 - 8/9 against price_usd and 1 - 16/18 against percent_change_24h are the same score.
    assert row["target"] == "price_usd" and row["score"] == pytest.approx(1 / 9)


def test_unknown_columns(spark):
    cols = ["Price USD", "ticker", "rank", "market cap", "time", "Ticker"]
    got = {r["column"] for r in mapping.unknown_columns(header(spark, cols)).collect()}
    assert got == {"rank", "Ticker"}


def test_alias_order(spark):
    df = spark.createDataFrame([("a", "b", None, "BTC")], "time string, price_timestamp string, created_at string, ticker string")
    row = mapping.apply_aliases(df).first()
    assert row.asDict() == {"symbol": "BTC", "timestamp": "b"}
    mapped, applied = mapping.map_columns(df)
    assert mapped.first()["timestamp"] == "b"
    assert [m.column for m in applied] == ["time", "ticker", "created_at", "price_timestamp"]


def test_close_name_overrides_alias(spark):
    df = spark.createDataFrame([("1", "$2", "x")], "usd_price string, price_in_usd string, coin_name string")
    mapped, applied = mapping.map_columns(df)
    assert mapped.first().asDict() == {"price_usd": 2.0}
    assert [(m.column, m.target) for m in applied] == [("usd_price", "price_usd"), ("price_in_usd", "price_usd")]


def test_rename_golden(spark):
    old = header(spark, ["symbol", "name", "price_usd", "volume_24h", "timestamp"])
    new = header(spark, ["ticker", "name", "usd_price", "volume_24h", "created_at"])
    got = {(r["from"], r["to"], r["confidence"], r["status"])
           for r in drift.classify_drift(drift.drift_mappings(old, new)).collect()}
    assert got == {("symbol", "ticker", 1.0, "applied"), ("price_usd", "usd_price", 1.0, "applied"),
                   ("timestamp", "created_at", 1.0, "applied")}
    first = drift.register(drift.empty_registry(spark), old)
    registry = first.unionByName(drift.register(first, new))
    assert {r["feed"]: r["schema_version"] for r in drift.schema_versions(registry).collect()} == {"f": 2, "*": 2}
    assert drift.register(registry, new).count() == 0


def test_type_change_is_drift_without_mappings(spark):
    old = header(spark, ["a", "b"], types={"a": "number"})
    new = header(spark, ["b", "a"], types={"a": "string"})
    assert drift.schema_changed(old, new).first()["changed"]
    assert drift.drift_mappings(old, new).count() == 0
    assert not drift.schema_changed(old, header(spark, ["b", "a"], types={"a": "number"})).first()["changed"]


def random_headers(seed):
    rnd = random.Random(seed)

    def name():
        kind = rnd.random()
        if kind < 0.1:
            return rnd.choice(["symbol", "ticker", "price_usd", "usd_price", "timestamp", "created_at", "time", "_", "__", "a", "b-", ""])
        if kind < 0.4:
            return f"col_{rnd.randint(0, 400)}"
        return "".join(rnd.choice("abcde_") for _ in range(rnd.randint(0, 12)))

    old, new = [], []
    for f in range(3):
        base = sorted({name() for _ in range(50)})
        for side in (old, new):
            cut = lambda b: b[:rnd.randint(0, len(b))] + name()[:2] + b[rnd.randint(0, len(b)):]
            columns = list(dict.fromkeys([b if rnd.random() < 0.3 else cut(b) for b in base] + [name() for _ in range(20)]))
            rnd.shuffle(columns)
            side += [(f"f{f}", c, "string", i) for i, c in enumerate(columns)]
    return old, new


@pytest.mark.parametrize("seed", range(3))
def test_wide_headers_equal_all_pairs(spark, seed):
    schema = "feed string, column string, type string, pos long"
    old, new = (spark.createDataFrame(x, schema) for x in random_headers(seed))
    want = sorted(map(tuple, drift.drift_mappings(old, new, narrow=10**9).collect()))
    assert len(want) > 100 and sorted(map(tuple, drift.drift_mappings(old, new, narrow=16).collect())) == want


def test_no_row_or_task_holds_a_wide_feed(spark):
    """Renamed columns, none of them alike: every list is bounded, and close names come out of the index alone."""
    rnd = random.Random(3)
    names = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(8, 14))) for _ in range(3000)]
    old, new = header(spark, names), header(spark, [f"{n}x" if i % 2 else n[:4] + "_" + n[5:] for i, n in enumerate(names)])
    got = {r["from"]: r["to"] for r in drift.drift_mappings(old, new).collect()}
    assert sum(got[n] == (f"{n}x" if i % 2 else n[:4] + "_" + n[5:]) for i, n in enumerate(names)) > 2990
    added = new.select("feed", F.inline(F.array(F.struct("pos", drift_name(F.col("column")).alias("name")))))
    lists = added.groupBy(F.pmod(F.xxhash64("name.name"), F.lit(-(-3000 // drift.NARROW)))).count()
    assert lists.agg(F.max("count")).first()[0] <= 2 * drift.NARROW


def test_first_added_wins_ties_and_may_serve_twice(spark):
    old, new = header(spark, ["abcx", "abcy"]), header(spark, ["abcp", "abcq"])
    got = {(r["from"], r["to"]) for r in drift.drift_mappings(old, new).collect()}
    assert got == {("abcx", "abcp"), ("abcy", "abcp")}


@pytest.mark.parametrize("confidence,status", [
    (0.8, "applied"), (0.799, "quarantined"), (0.5, "quarantined"), (0.499, "skipped")])
def test_classes(spark, confidence, status):
    df = spark.createDataFrame([(confidence,)], "confidence double")
    assert drift.classify_drift(df).first()["status"] == status


def test_rounding_comes_before_the_limit(spark):
    # 1 - 1/2000 steps: 0.7995 rounds up to 0.8 and is applied.
    df = spark.createDataFrame([(0.7995,)], "c double").select(F.round("c", 3).alias("confidence"))
    assert drift.classify_drift(df).first()["status"] == "applied"


def test_feed_schema(spark):
    df = spark.createDataFrame([(1, "a", True, 1.5, [1])], "i int, s string, b boolean, d double, l array<int>")
    got = {r["column"]: r["type"] for r in drift.infer_feed_schema(df, "f").collect()}
    assert got == {"i": "number", "s": "string", "b": "boolean", "d": "number", "l": "object"}
    assert drift.infer_feed_schema(df.limit(0), "f").count() == 0


def test_quarantine_keeps_the_latest(spark):
    m = spark.createDataFrame([("f", "a", "b", 0.6, "quarantined"), ("f", "c", "d", 0.9, "applied")],
                              "feed string, from string, to string, confidence double, status string")
    later = m.withColumn("to", F.lit("z"))
    log = drift.quarantine_rows(m, F.lit("2024-01-01").cast("timestamp")).unionByName(
        drift.quarantine_rows(later, F.lit("2024-01-02").cast("timestamp")))
    rows = drift.quarantine_table(log).collect()
    assert [(r["from"], r["to"]) for r in rows] == [("a", "z")]


def test_names_of_many_feeds_are_compared_by_many_tasks(spark):
    """300 feeds with 100 removed and 100 added names are three million pairs, though hardly any bytes."""
    def side(prefix):
        return spark.range(30_000).select(
            F.concat(F.lit("F"), F.col("id") % 300).alias("feed"), F.concat(F.lit(prefix), F.floor(F.col("id") / 300)).alias("column"),
            F.lit("number").alias("type"), F.floor(F.col("id") / 300).alias("pos"))

    mapped = drift.drift_mappings(side("old"), side("new")).withColumn("task", F.spark_partition_id()).collect()
    assert len(mapped) == 30_000 and len({r["task"] for r in mapped}) >= 3
    assert len({r["feed"] for r in mapped}) == 300
    best = {r["from"]: (r["to"], r["confidence"]) for r in mapped}
    assert len({(r["from"], r["to"]) for r in mapped}) == 100 and best["old42"] == ("new42", 0.4)
