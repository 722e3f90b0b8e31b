"""Pages of stored tables through copies in the order of another column."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import serve
from tidemark.sources.ordered import touched_days
from tidemark.sources.tables import Tables

NOON = dt.datetime(2025, 10, 13, 12)
NAN = float("nan")


def rows(spark, values, source="csv", start=0):
    stored = [(f"S{(start + i) % 7}", "n", 1.0, v, 0.0, 0.0, NOON + dt.timedelta(hours=3 * (start + i)), source, "{}", start + i)
              for i, v in enumerate(values)]
    return spark.createDataFrame(
        stored, "symbol string, name string, price_usd double, volume_24h double, market_cap double, "
        "percent_change_24h double, timestamp timestamp, source string, raw_data string, seq long")


#: A third of the rows share one value, some have none.
VALUES = [5.0 if i % 3 == 0 else None if i % 11 == 0 else NAN if i == 50 else float(i * 37 % 101) for i in range(120)]


def keys(df, sort_dir):
    return [(repr(r["volume_24h"]), r["symbol"], r["timestamp"]) for r in
            serve.sort_data(df, "volume_24h", sort_dir).collect()]


def walk(copy, size, sort_dir, **kw):
    found, cursor, more = [], None, True
    while more:
        page = copy.page(size, sort_dir, cursor, **kw)
        found += keys(page.rows, sort_dir)
        cursor, more = page.cursor, page.has_more
    return found


@pytest.fixture
def tables(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.upsert(rows(spark, VALUES), "r1", F.lit(NOON))
    return tables


@pytest.mark.parametrize("sort_dir", ["asc", "desc"])
def test_pages_add_up_to_the_whole_before_and_after_a_load(spark, tables, sort_dir):
    copy = tables.ordered("volume_24h")
    assert walk(copy, 40, sort_dir) == keys(tables.served(), sort_dir)  # no copy yet
    copy.refresh(10)
    assert len(copy.zones()) == 12
    assert walk(copy, 23, sort_dir) == keys(tables.served(), sort_dir)
    # Days are replaced and added; the copy's rows of those days no longer count.
    tables.upsert(rows(spark, [900.0, None, 5.0, 17.5], start=118), "r2", F.lit(NOON))
    assert walk(copy, 23, sort_dir) == keys(tables.served(), sort_dir)
    tables.publish("r2")
    assert copy.rows().count() == tables.served().count() == 122
    assert copy.refresh(10) == 2
    assert copy._touched(2).read().isEmpty()
    assert walk(copy, 40, sort_dir) == keys(tables.served(), sort_dir)


def test_filtered_pages(spark, tables):
    copy = tables.ordered("volume_24h")
    copy.refresh(10)
    where = lambda df: serve.filter_data(df, symbol="s3")
    assert walk(copy, 4, "desc", where=where) == keys(where(tables.served()), "desc")


def test_a_page_opens_a_share_of_the_zones(spark, tables):
    copy = tables.ordered("volume_24h")
    copy.refresh(10)
    first = copy.page(12)
    plan = copy.page_frame(12, "desc", first.cursor)._jdf.queryExecution().executedPlan().toString()
    low, high = (int(re.search(rf"PartitionFilters: \[[^\]]*\(zone#\d+ {sign} (\d+)\)", plan)[1]) for sign in (">=", "<="))
    assert 0 <= high - low < 4
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(volume_24h", plan)


def test_equal_values_are_cut_into_zones(spark, tables):
    copy = tables.ordered("volume_24h")
    copy.refresh(10)
    sizes = [r["count"] for r in copy._rows(1).groupBy("zone").count().collect()]
    assert max(sizes) <= 20 and sum(sizes) == 120


def test_a_refresh_cut_short_leaves_the_copy_in_force(spark, tables):
    copy = tables.ordered("volume_24h")
    copy.refresh(10)
    copy.served().withColumn("zone", F.lit(0)).limit(3).write.partitionBy("zone").parquet(f"{copy.root}/v2/rows")
    assert copy.generation() == 1 and copy.rows().count() == 120
    assert copy.refresh(10) == 2 and copy.rows().count() == 120


def test_days_noted_but_never_published_are_read_from_the_tables(spark, tables):
    copy = tables.ordered("volume_24h")
    copy.refresh(10)
    tables._touch(touched_days(rows(spark, [1.0] * 20)), "killed")
    assert walk(copy, 40, "desc") == keys(tables.served(), "desc")


def test_plain_writes_reach_the_copy(spark, tables):
    copy = tables.ordered("volume_24h")
    copy.refresh(10)
    more = rows(spark, [1000.0], "coingecko").withColumns({"run_id": F.lit("r"), "created_at": F.lit(NOON)})
    tables.write_normalized(more)
    assert copy.page(1).rows.first()["volume_24h"] != 1000.0  # NaN is the largest
    assert keys(copy.page(2).rows, "desc") == keys(tables.served(), "desc")[:2]


def test_empty_tables(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    copy = tables.ordered("volume_24h")
    assert copy.refresh() == 1
    assert copy.page(5).rows.count() == 0
    tables.upsert(rows(spark, [1.0, 2.0]), "r1", F.lit(NOON))
    assert [r["volume_24h"] for r in copy.page(5).rows.collect()] == [2.0, 1.0]


def test_days_come_from_the_folders(spark, tables):
    days = tables.days()
    assert days == sorted({str(r["day"]) for r in tables.served().select("day").collect()})
    found, cursor, more = [], None, True
    while more:
        page = serve.page_data(tables.served(), 17, cursor=cursor, days=days)
        found += [r["timestamp"] for r in serve.sort_data(page.rows).collect()]
        cursor, more = page.cursor, page.has_more
    assert found == [r["timestamp"] for r in serve.sort_data(tables.normalized()).collect()]


def test_time_needs_no_copy(tables):
    with pytest.raises(ValueError):
        tables.ordered("timestamp")
