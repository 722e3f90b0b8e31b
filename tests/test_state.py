"""What loads carry forward: compacted logs, high-water marks and the state of series."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tidemark.operators import load, outliers
from tidemark.sources import log as log_module
from tidemark.sources.log import Log, matching
from tidemark.sources.series import SeriesState
from tidemark.sources.tables import Tables, newest_progress, unfinished_loads
from tidemark.streaming import ingest

SCHEMA = StructType().add("key", StringType()).add("n", LongType())
NOON = dt.datetime(2025, 10, 13, 12)


def entry(spark, key, n):
    return spark.createDataFrame([(key, n)], SCHEMA)


def content(log):
    return sorted(tuple(r) for r in log.read().collect())


def test_a_log_is_read_from_a_bounded_number_of_files(spark, tmp_path):
    log = Log(spark, str(tmp_path / "log"), SCHEMA, compact_after=4)
    opened = []
    for i in range(22):
        log.append(entry(spark, f"k{i % 7}", i), f"p{i}")
        opened.append(len(log.read().inputFiles()))
    assert content(log) == sorted((f"k{i % 7}", i) for i in range(22))
    assert max(opened[:9]) == max(opened[9:]) <= 5  # one snapshot and the tail
    assert len(matching(spark, f"{tmp_path}/log.v*")) <= 2


def test_repeated_parts_replace_what_was_folded(spark, tmp_path):
    log = Log(spark, str(tmp_path / "log"), SCHEMA, compact_after=2)
    for i in range(5):
        log.append(entry(spark, "a", i), f"2025-01-0{i + 1}")
    log.append(entry(spark, "a", 100), "2025-01-01")
    assert content(log) == [("a", n) for n in (1, 2, 3, 4, 100)]


def test_a_compaction_cut_short_changes_nothing(spark, tmp_path):
    log = Log(spark, str(tmp_path / "log"), SCHEMA, compact_after=3)
    for i in range(3):
        log.append(entry(spark, "a", i), f"p{i}")
    broken = tmp_path / "log.v1" / "base"  # as left by a driver killed while it wrote the snapshot
    broken.mkdir(parents=True)
    entry(spark, "half", 0).withColumn("part", F.lit("p0")).write.mode("overwrite").parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    assert content(log) == [("a", 0), ("a", 1), ("a", 2)]
    log.append(entry(spark, "a", 3), "p3")
    assert content(log) == [("a", 0), ("a", 1), ("a", 2), ("a", 3)]


def test_folds(spark):
    loads = spark.createDataFrame(
        [("x", "ready", "x-ready"), ("x", "done", "x-done"), ("y", "ready", "y-ready")], "load_id string, state string, part string")
    assert [tuple(r) for r in unfinished_loads(loads).collect()] == [("y", "ready", "y-ready")]
    progress = spark.createDataFrame(
        [("b", "csv", "r1", 5, NOON, "r1"), ("b", "csv", "r2", 9, NOON + dt.timedelta(1), "r2"), ("c", "csv", "r1", 1, NOON, "r1"),
         ("c", "csv", "r1", None, NOON + dt.timedelta(1), "r1-cleared")],
        "batch_id string, source string, run_id string, last_index long, updated_at timestamp, part string")
    assert [(r["batch_id"], r["last_index"], r["part"]) for r in newest_progress(progress).collect()] == [("b", 9, "r2")]


def rows(spark, items, source="csv"):
    data = [(i, s, s, float(p), 1.0, 0.0, 0.0, NOON + dt.timedelta(hours=h), source, "{}") for i, (s, p, h) in enumerate(items)]
    return spark.createDataFrame(
        data, "seq long, symbol string, name string, price_usd double, volume_24h double, market_cap double, "
              "percent_change_24h double, timestamp timestamp, source string, raw_data string")


def marks(tables):
    return {r["source"]: r["watermark"] for r in tables.watermarks().collect()}


def test_marks_are_carried_without_reading_the_tables(spark, tmp_path, monkeypatch):
    tables, read = Tables(spark, str(tmp_path), compact_after=3), []
    served = Tables.served
    monkeypatch.setattr(Tables, "served", lambda self: read.append(1) or served(self))
    for i in range(5):
        ingest.load_batch(tables, rows(spark, [("A", 1, 30 * i), ("B", 2, 7)], "csv" if i % 2 else "coingecko"), i, F.lit(NOON))
        assert marks(tables) == {r["source"]: r["watermark"] for r in load.source_watermarks(tables.normalized()).collect()}
    assert not read
    assert all("/mark_log" in f for f in tables.watermarks().inputFiles())
    assert sorted(p.name for p in (tmp_path / "staged").iterdir()) == ["batch-4"]
    before = marks(tables)
    ingest.load_batch(tables, rows(spark, [("A", 1, 120), ("B", 2, 7)], "coingecko"), 4, F.lit(NOON))  # replayed
    assert marks(tables) == before


def test_marks_after_a_crash_between_the_writes(spark, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path))
    tables.upsert(rows(spark, [("A", 1, 0)]), "r1", F.lit(NOON))
    with monkeypatch.context() as m:
        m.setattr(Tables, "_move_marks", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            tables.upsert(rows(spark, [("A", 1, 48)]), "r2", F.lit(NOON))
    assert marks(tables) == {"csv": NOON}  # the load is not done, so nothing builds on it yet
    assert tables.recover() == ["r2"] and marks(tables) == {"csv": NOON + dt.timedelta(hours=48)}


def test_marks_of_a_table_that_has_no_log_yet(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.upsert(rows(spark, [("A", 1, 0), ("B", 1, 50)]), "r1", F.lit(NOON))
    log_module.drop_paths(spark, f"{tmp_path}/mark_log*")
    assert marks(tables) == {"csv": NOON + dt.timedelta(hours=50)}
    tables.write_normalized(rows(spark, [("C", 1, 60)]).withColumns({"run_id": F.lit("r"), "created_at": F.lit(NOON)}))
    assert marks(tables) == {"csv": NOON + dt.timedelta(hours=60)}


LONG = "seq long, symbol string, field string, value double"


def batch(spark, seqs, symbols):
    return spark.createDataFrame([(i, s, "price_usd", float(i * 7 % 13 + 1)) for i in seqs for s in symbols], LONG)


def size_of(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def test_series_state_equals_the_whole_history(spark, tmp_path):
    state = SeriesState(spark, str(tmp_path / "tail"), compact_after=3)
    whole = None
    for g in range(8):
        long = batch(spark, range(g * 30, g * 30 + 25), [f"S{g % 3}", f"T{g}"])
        tail = state.tail(g, long)
        assert {r["symbol"] for r in tail.collect()} <= {f"S{g % 3}", f"T{g}"}
        state.advance(long, tail, g + 1)
        whole = long if whole is None else whole.unionByName(long)
        want = sorted(map(tuple, outliers.history_tail(whole).collect()))
        assert sorted(map(tuple, state.tail(g + 1).collect())) == want
        # A replay reads the state before it, also when that has been folded meanwhile.
        state.advance(long, state.tail(g, long), g + 1)
        assert sorted(map(tuple, state.tail(g + 1).collect())) == want
    got = {tuple(r)[:2]: (r["count"], r["latest"], round(r["mean"], 9)) for r in state.stats().collect()}
    assert got == {tuple(r)[:2]: (r["count"], r["latest"], round(r["mean"], 9)) for r in outliers.history_stats(whole).collect()}
    assert len(matching(spark, f"{tmp_path}/tail.base-*")) <= 2


def test_a_batch_writes_its_own_series_only(spark, tmp_path):
    state = SeriesState(spark, str(tmp_path / "tail"))
    many = batch(spark, range(25), [f"S{i}" for i in range(400)])
    state.advance(many, state.tail(0, many), 1)
    few = batch(spark, range(25, 27), ["S1", "S2"])
    state.advance(few, state.tail(1, few), 2)
    assert size_of(tmp_path / "tail" / "generation=2") < size_of(tmp_path / "tail" / "generation=1") / 20
    assert state.tail(2, few).count() == 40 and state.newest() == 2


def test_a_state_that_is_gone_is_an_error(spark, tmp_path):
    state = SeriesState(spark, str(tmp_path / "tail"), compact_after=2)
    for g in range(7):
        long = batch(spark, range(g * 3, g * 3 + 3), ["S"])
        state.advance(long, state.tail(g, long), g + 1)
    with pytest.raises(ValueError):
        state.tail(1)


def test_key_lookups_leave_the_target_where_it_is(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.upsert(rows(spark, [("A", 1, 0), ("B", 2, 30), ("C", 3, 60)]), "r1", F.lit(NOON))
    staged = rows(spark, [("A", 5, 0), ("B", 6, 31), ("B", 7, 31), ("D", 8, 0)])
    seen, fresh = tables.already_processed(staged), tables.insert_if_absent(staged)
    assert [r["symbol"] for r in seen.collect()] == ["A"]
    assert sorted((r["symbol"], r["price_usd"]) for r in fresh.collect()) == [("B", 6.0), ("D", 8.0)]
    for max_rows in (100_000, 1):  # looked up by broadcast keys, or by a shuffled join beyond the bound
        target = tables.normalized()
        assert load.already_processed(staged, target, max_rows=max_rows).count() == 1
        assert load.insert_if_absent(staged, target, max_rows=max_rows).count() == 2
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_rates_are_read_from_a_bounded_number_of_files(spark, tmp_path):
    from tidemark.streaming import rates

    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    whole = spark.range(90).select(
        (F.lit(1_700_000_000) + F.col("id") * 40).cast("timestamp").alias("timestamp"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"))
    for i in range(9):
        part = whole.filter(F.pmod(F.unix_timestamp("timestamp"), F.lit(9)) == i)  # every batch has rows of every time
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(whole.schema).parquet(landing)
        rates.rate_stream(stream, ["source"], out, f"{tmp_path}/checkpoint", compact_after=3).awaitTermination()
    got = {(r["window_start"], r["source"]): round(r["rate"], 9) for r in rates.current_rates(spark, out, ["source"]).collect()}
    want = whole.groupBy(F.window("timestamp", "300 seconds"), "source").count().collect()
    assert got == {(r["window"]["start"], r["source"]): round(r["count"] / 300, 9) for r in want}
    assert len(matching(spark, f"{out}.v*")) <= 2
    log = Log(spark, out, spark.read.parquet(matching(spark, f"{out}.v*/base")[0]).drop("part").schema, rates._summed, 3)
    added_up = lambda: sorted(tuple(r) for r in rates._summed(log.rows()).drop("part").collect())
    before = added_up()
    newest = matching(spark, f"{log._tail(log.generation())}/part=*")[-1].rsplit("part=", 1)[1]
    again = spark.createDataFrame(log.rows().filter(F.col("part") == newest).collect(), log.stored)
    log.append(again, newest)  # a batch replayed after its counts were written
    log.compact(newest)
    log.append(again, newest)  # and once more after a compaction that left it out
    assert added_up() == before
