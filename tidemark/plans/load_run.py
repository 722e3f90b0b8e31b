"""One load run: every feed is staged, judged, merged and reported; the run ends as one ledger row.

Commit order is data, then progress, then summary and ledger. A run is named by the caller, so repeating it
after a crash replaces what the first attempt wrote. High-water marks are saved under the snapshot's name
when it is first loaded, so a repeat does not skip rows a half-finished attempt already put into the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Row, functions as F

from tidemark.model import LOAD_BATCH, SOURCE_REPORT, SOURCES
from tidemark.operators import drift, ledger, load, outliers
from tidemark.sources.tables import Tables


@dataclass
class Feed:
    """``rows`` gives unified records with ``raw_data`` and an order column; ``header`` its header table."""

    rows: Callable[[], DataFrame]
    header: Callable[[], DataFrame] | None = None
    seq: str = "seq"


def _mappings(rows: list[Row], status: str) -> list[tuple]:
    return [(r["from"], r["to"], r["confidence"]) for r in rows if r["status"] == status]


def _told(error: Exception) -> str:
    return str(error) or type(error).__name__


def _check_header(tables: Tables, header: DataFrame, run_id: str, source: str) -> dict:
    """Register the header if it is new or changed; one header is a few rows."""
    registry = tables.registry()
    known = drift.current_headers(registry).filter(F.col("feed").isin([source]))
    mapped = drift.classify_drift(drift.drift_mappings(known, header.filter(F.col("feed") == source)))
    rows = mapped.orderBy("from").collect() if not known.isEmpty() else []
    tables.append("schema_registry", drift.register(registry, header), f"{run_id}-{source}")
    version = tables.registry().filter(F.col("feed") == source).agg(F.max("version")).first()[0]
    return {
        "schema_version": version or 1,
        "applied_mappings": _mappings(rows, "applied"),
        "quarantined_mappings": _mappings(rows, "quarantined"),
        "skipped_mappings": _mappings(rows, "skipped"),
        "skipped_fields": [r["from"] for r in rows if r["status"] == "skipped"],
    }


def _stage(
    tables: Tables, source: str, feed: Feed, run_id: str, done: int, mark: datetime | None, sources: Sequence[str],
) -> str:
    """Write the feed's rows once, judged and numbered; all later steps read this table, pruned to their columns.

    Every row the feed delivers is staged under ``feed``; what it says its ``source`` is, is data to be judged.
    """
    numbered = load.assign_batches(feed.rows().withColumn("feed", F.lit(source)), by="feed", seq=feed.seq)
    if done:
        numbered = numbered.filter(F.col("row_index") >= done)
    path = f"{tables.root}/staged/{run_id}/{source}"
    marked = numbered.drop("arrival", "seq").withColumn("watermark", F.lit(mark).cast("timestamp"))
    load.judge(marked, sources).write.mode("overwrite").parquet(path)
    return path


def _detect(tables: Tables, staged: DataFrame, counts: list[Row], run_id: str, load_id: str) -> dict[str, int]:
    """Outliers against the saved history of all loads before, then the history after this one.

    History runs through the feeds in turn, so each feed's row numbers are moved behind those of the last one.
    """
    generation = tables.tail_generation(load_id)
    tail = tables.outlier_tail(generation, outliers.explode_fields(staged, "row_index"))
    base = tail.agg(F.coalesce(F.max("seq") + 1, F.lit(0))).first()[0]
    start = F.lit(None).cast("long")
    for r in counts:
        start = F.when(F.col("source") == r["source"], F.lit(base - r["first"])).otherwise(start)
        base += r["fetched"]
    ordered = staged.withColumn("seq", F.col("row_index") + start)
    tables.write_outliers(outliers.detect_outliers(ordered, keep=("source",), tail=tail), run_id)
    if counts:
        tables.advance_tail(outliers.explode_fields(ordered), tail, generation + 1)
    return {r["source"]: r["outliers"] for r in outliers.outliers_per_source(tables.outliers(run_id)).collect()}


def _report(
    headers: dict[str, dict], failures: dict[str, str], found: dict[str, int],
    counts: list[Row], batch_size: int,
) -> list[tuple]:
    """One report row per source, failed ones included."""
    plain = {"schema_version": 1, "applied_mappings": [], "quarantined_mappings": [], "skipped_mappings": [],
             "skipped_fields": []}
    rows = {r["source"]: r for r in counts}
    report = []
    for source in [*headers, *failures]:
        r, head = rows.get(source), headers.get(source) or plain
        n = [r[c] if r else 0 for c in (
            "fetched", "skipped_by_watermark", "processed", "validation_errors", "failed_records", "loaded")]
        failed = [(source, "unknown", failures[source], None)] if source in failures else []
        resumed = r["first"] // batch_size if r and r["first"] else None
        report.append((source, *n, failed, resumed, found.get(source, 0), *[head[c] for c in plain]))
    return report


def load_run(
    tables: Tables,
    feeds: dict[str, Feed],
    run_id: str,
    now: datetime,
    snapshot_id: str | None = None,
    sources: Sequence[str] = SOURCES,
    batch_size: int = LOAD_BATCH,
    forget: bool = False,
) -> DataFrame:
    """Run all feeds; one that cannot be read becomes a failed batch of the ledger row and spares the others.

    Feeds are staged one by one, because each may fail, and from there on handled together. ``snapshot_id``
    names the feed contents. Progress is kept under it, so a later run over the same snapshot takes up where
    an incomplete one stopped. Returns the ledger row as stored; a run that fails as a whole is logged and
    raises. With ``forget`` a run without failures drops what it kept for being repeated.
    """
    spark, stamp = tables.spark, F.lit(now).cast("timestamp")
    snapshot_id = snapshot_id or run_id
    headers: dict[str, dict] = {}
    failures: dict[str, str] = {}
    paths: list[str] = []

    def log(rows: list[tuple], message: str | None = None) -> None:
        report = spark.createDataFrame(rows, SOURCE_REPORT).withColumn("run_id", F.lit(run_id))
        ended = F.lit(max(now, datetime.now(now.tzinfo))).cast("timestamp")
        record = ledger.run_record(report, stamp, ended)
        if message is None:
            tables.write_summary(ledger.run_summary(report, stamp), run_id)
        tables.write_run(record if message is None else ledger.failed_run(record, message), run_id)

    try:
        tables.recover()
        # One mark and one index per feed of the run; these are the run's own settings.
        marks = {r["source"]: r["watermark"] for r in tables.marks(snapshot_id).filter(
            F.col("source").isin(*feeds)).collect()}
        batch_ids = [f"{snapshot_id}_{source}" for source in feeds]
        done = {r["source"]: r["last_index"] for r in load.latest_progress(
            tables.progress().filter(F.col("batch_id").isin(batch_ids))).collect()}
        for source, feed in feeds.items():
            try:
                path = _stage(tables, source, feed, run_id, done.get(source, 0), marks.get(source), sources)
                headers[source] = {} if feed.header is None else _check_header(
                    tables, feed.header(), run_id, source)
                paths.append(path)
            except Exception as error:  # whatever is wrong with one feed is recorded and spares the others
                headers.pop(source, None)
                failures[source] = _told(error)
        if not paths:
            log(_report(headers, failures, {}, [], batch_size))
            return tables.runs().filter(F.col("run_id") == run_id)

        staged = spark.read.parquet(*paths)
        by_feed = staged.withColumn("source", F.col("feed"))
        counts = load.load_report(by_feed, F.min("row_index").alias("first")).collect()
        order = list(feeds)
        counts.sort(key=lambda r: order.index(r["source"]))
        found = _detect(tables, by_feed, counts, run_id, f"{snapshot_id}-" + "-".join(
            f"{r['source']}.{r['first']}" for r in counts))
        tables.write_failed(load.failed_ids(staged), run_id)
        good = staged.filter(F.col("fate") == "load")
        tables.upsert(load.last_per_key(good, "row_index"), run_id, stamp, seq=None)
        batch_id = F.concat(F.lit(f"{snapshot_id}_"), "source")
        tables.save_progress(load.progress_after(by_feed, batch_id, F.lit(run_id), stamp), run_id)
        log(_report(headers, failures, found, counts, batch_size))
    except Exception as error:
        log(_report(headers, failures, {}, [], batch_size), _told(error))
        raise
    if not failures:
        tables.clear_progress(run_id, batch_ids)
        if forget:
            tables.forget(run_id, snapshot_id)
    return tables.runs().filter(F.col("run_id") == run_id)
