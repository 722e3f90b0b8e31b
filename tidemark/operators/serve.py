"""Serving queries over the loaded data and the run ledger."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.model import HISTORY_LIMIT, PAGE_LIMIT, STATS_RUNS

ROW_ID = ["symbol", "timestamp", "source"]


def filter_data(
    df: DataFrame, symbol: str | None = None, source: str | None = None,
    start: datetime | str | None = None, end: datetime | str | None = None,
) -> DataFrame:
    """Exact symbol (any case given) and source, inclusive time range; what is not given does not filter.

    Rows that carry their ``day`` are also filtered by it, which prunes the folders of a stored table.
    """
    by_day = "day" in df.columns
    if symbol:
        df = df.filter(F.col("symbol") == symbol.upper())
    if source:
        df = df.filter(F.col("source") == source)
    if start:
        start = F.lit(start).cast("timestamp")
        df = df.filter(F.col("timestamp") >= start)
        df = df.filter(F.col("day") >= F.to_date(start)) if by_day else df
    if end:
        end = F.lit(end).cast("timestamp")
        df = df.filter(F.col("timestamp") <= end)
        df = df.filter(F.col("day") <= F.to_date(end)) if by_day else df
    return df


def _ascending(sort_dir: str) -> bool:
    if sort_dir.lower() not in ("asc", "desc"):
        raise ValueError(f"sort_dir must be 'asc' or 'desc', not {sort_dir!r}")
    return sort_dir.lower() == "asc"


def sort_order(sort_by: str, sort_dir: str, row_id: Sequence[str] = ROW_ID) -> list[Column]:
    """Nulls are the lowest values; the row id breaks ties and always ascends."""
    first = F.asc_nulls_first(sort_by) if _ascending(sort_dir) else F.desc_nulls_last(sort_by)
    return [first, *[F.asc_nulls_first(c) for c in row_id if c != sort_by]]


def sort_data(df: DataFrame, sort_by: str = "timestamp", sort_dir: str = "desc", row_id: Sequence[str] = ROW_ID) -> DataFrame:
    return df.orderBy(*sort_order(sort_by, sort_dir, row_id))


def limit_clamp(value: Any, limits: tuple[int, int, int] = PAGE_LIMIT) -> int:
    """Requested size within (default, lowest, highest); 0 and anything unreadable give the default."""
    default, lowest, highest = limits
    text = str(value).strip() if value is not None else ""
    sign, body = (text[:1], text[1:]) if text[:1] in ("+", "-") else ("", text)
    digits = body[: len(body) - len(body.lstrip("0123456789"))]
    wanted = int(sign + digits) if digits else 0
    return min(highest, max(lowest, wanted or default))


class Page(NamedTuple):
    rows: DataFrame
    has_more: bool
    cursor: tuple | None


def after(cursor: tuple, sort_by: str, sort_dir: str, row_id: Sequence[str] = ROW_ID) -> Column:
    """Keyset predicate: strictly after ``cursor`` = (sort value, *row id) in the sort order, ties included."""
    names = [sort_by, *[c for c in row_id if c != sort_by]]
    condition, prefix = F.lit(False), F.lit(True)
    for i, (name, value) in enumerate(zip(names, cursor, strict=True)):
        c = F.col(name)
        up = _ascending(sort_dir) if i == 0 else True
        if value is None:
            step = c.isNotNull() if up else F.lit(False)
        else:
            step = (c > F.lit(value)) if up else ((c < F.lit(value)) | c.isNull())
        condition = condition | (prefix & step)
        prefix = prefix & (c.isNull() if value is None else c == F.lit(value))
    return condition


def prune_days(df: DataFrame, size: int, sort_dir: str, days: Sequence[str] | None = None) -> DataFrame:
    """Keep the first days of a time order that hold ``size`` rows; the page cannot reach beyond them.

    ``days`` are those of the table's folders (``Tables.days``, one listing of folders); without them they are taken
    from the names of all its files. One, two, four and so on of them are looked into until they hold enough rows,
    so that a filter on other columns reads about twice the days the page needs, and never the whole table for a page
    of its newest rows.
    """
    up = _ascending(sort_dir)
    if days is None:
        found = [re.search(r"/day=(\d{4}-\d{2}-\d{2})/", f) for f in df.inputFiles()]
        days = {m[1] for m in found if m}
    days = sorted(days, reverse=not up)
    wide = 1
    while wide < len(days):
        edge = F.lit(days[wide - 1]).cast("date")
        part = df.filter(F.col("day") <= edge) if up else df.filter(F.col("day") >= edge)
        if part.limit(size).count() >= size:
            return part
        wide *= 2
    return df


def page_frame(
    df: DataFrame, limit: int, sort_by: str = "timestamp", sort_dir: str = "desc",
    cursor: tuple | None = None, row_id: Sequence[str] = ROW_ID, days: Sequence[str] | None = None,
) -> DataFrame:
    """The page's rows in order: keyset predicate, then a top-k that never sorts the whole table."""
    if "day" in df.columns and sort_by == "timestamp":
        if cursor is not None and cursor[0] is not None:
            edge = F.to_date(F.lit(cursor[0]).cast("timestamp"))
            if days is not None:
                own = df.sparkSession.range(1).select(edge.cast("string")).first()[0]
                days = [d for d in days if (d >= own if _ascending(sort_dir) else d <= own)]
            df = df.filter(F.col("day") >= edge if _ascending(sort_dir) else F.col("day") <= edge)
            # The cursor's own day may be used up to any point, so it cannot count towards the page.
            rest = prune_days(df.filter(F.col("day") != edge), limit, sort_dir, days)
            df = rest.unionByName(df.filter(F.col("day") == edge))
        elif cursor is None:
            df = prune_days(df, limit, sort_dir, days)
    if cursor is not None:
        df = df.filter(after(cursor, sort_by, sort_dir, row_id))
    return sort_data(df, sort_by, sort_dir, row_id).limit(limit)


def page_data(
    df: DataFrame, limit: Any = None, sort_by: str = "timestamp", sort_dir: str = "desc",
    cursor: tuple | None = None, row_id: Sequence[str] = ROW_ID, days: Sequence[str] | None = None,
) -> Page:
    """One page: asks for one row more than the page holds to learn whether another page follows."""
    size = limit_clamp(limit)
    names = [sort_by, *[c for c in row_id if c != sort_by]]
    found = page_frame(df, size + 1, sort_by, sort_dir, cursor, row_id, days).collect()
    page = df.sparkSession.createDataFrame(found[:size], df.schema)
    if len(found) <= size:
        return Page(page, False, None)
    last = found[size - 1]
    return Page(page, True, tuple(last[n] for n in names))


def newest_runs(runs: DataFrame, n: int) -> DataFrame:
    return runs.orderBy(F.desc_nulls_last("end_time"), F.desc("run_id")).limit(n)


def _or_zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast("long")


def latest_run(runs: DataFrame) -> DataFrame:
    """Health of the newest run."""
    return newest_runs(runs, 1).select(
        "run_id", "status", "end_time", _or_zero("errors").alias("errors"),
        _or_zero("rows_processed").alias("rows_processed"),
        _or_zero("total_latency_ms").alias("total_latency_ms"))


def _run_view(runs: DataFrame, *more: str) -> DataFrame:
    optional = [c for c in ("batches", "failed_batches", "resume_info", "applied_mappings") if c in runs.columns]
    return runs.select(
        "run_id", "status",
        F.coalesce("schema_version", F.lit(1)).alias("schema_version"),
        F.col("start_time").alias("started_at"), F.col("end_time").alias("completed_at"),
        _or_zero("total_latency_ms").alias("duration_ms"),
        *optional,
        F.struct(
            _or_zero("rows_processed").alias("extracted"),
            F.coalesce(F.nullif("rows_loaded", F.lit(0)), "rows_processed", F.lit(0)).cast("long").alias("loaded"),
            _or_zero("duplicates_skipped").alias("duplicates"),
            _or_zero("errors").alias("errors"),
            _or_zero("throttle_events").alias("throttle_events"),
        ).alias("stats"),
        *more,
    )


def run_history(runs: DataFrame, n: Any = None) -> DataFrame:
    """The newest runs with defaults filled in and a ``stats`` struct."""
    return _run_view(newest_runs(runs, limit_clamp(n, HISTORY_LIMIT)))


def run_detail(runs: DataFrame, run_id: str) -> DataFrame:
    """One run with its error message; no row means not found."""
    return _run_view(runs.filter(F.col("run_id") == run_id), "error_message")


def table_counts(raw: DataFrame, normalized: DataFrame) -> DataFrame:
    """Row counts of both data tables."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")

    return count(raw, "raw").unionByName(count(normalized, "normalized"))


def run_stats(runs: DataFrame, n: int = STATS_RUNS) -> DataFrame:
    """Mean latency and error rate over the newest runs. The row total starts at 1; no runs give 0."""
    return newest_runs(runs, n).agg(
        F.coalesce(F.round(F.avg(_or_zero("total_latency_ms"))).cast("long"), F.lit(0)).alias("latency_avg_ms"),
        F.coalesce(F.round(F.sum(_or_zero("errors")) / (F.sum(_or_zero("rows_processed")) + 1), 4), F.lit(0.0))
        .alias("error_rate"),
    )


def incremental_stats(runs: DataFrame, n: int = STATS_RUNS) -> DataFrame:
    """New and skipped rows of the newest run and all skips over the newest ``n``."""
    order = F.struct("end_time", "run_id")
    return newest_runs(runs, n).agg(
        F.coalesce(F.max_by(_or_zero("rows_processed"), order), F.lit(0)).alias("last_run_new_records"),
        F.coalesce(F.max_by(_or_zero("duplicates_skipped"), order), F.lit(0)).alias("last_run_skipped"),
        F.coalesce(F.sum(_or_zero("duplicates_skipped")), F.lit(0)).alias("total_duplicate_prevention"),
    )
