"""Incremental load: high-water marks, new-row filters, insert-if-absent, upsert, batches and progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tidemark.model import KEY, LOAD_BATCH, SOURCES
from tidemark.operators.skew import MAX_ROWS, SMALL_ROWS, arrival_index, join_small, row_index, small_copy
from tidemark.operators.validate import storage_ok, with_reason


def source_watermarks(target: DataFrame) -> DataFrame:
    """Newest loaded timestamp per source; a source without rows has none."""
    return target.groupBy("source").agg(F.max("timestamp").alias("watermark"))


def with_watermark(staged: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Attach each row's mark. There is one mark per source; the join checks that before broadcasting."""
    return join_small(staged, watermarks, ["source"], "left")


def is_new() -> Column:
    """Strictly newer than the mark of its source, or no mark yet; never null for a row with a timestamp."""
    return F.col("watermark").isNull() | (F.col("timestamp") > F.col("watermark"))


def incremental_filter(staged: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Rows the target has not passed yet."""
    return with_watermark(staged, watermarks).filter(is_new()).drop("watermark")


def _held(staged: DataFrame, target: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """Keys of ``target`` that ``staged`` may have, broadcast while the staged keys are few.

    A load is small beside what is stored: its keys go to the target's tasks, and what comes back is no more than they
    are, so the target is neither shuffled nor sorted. Beyond ``max_rows`` keys the caller's join shuffles both sides.
    """
    own = small_copy(staged.select(*keys).distinct(), max_rows)
    if own is None:
        return target.select(*keys)
    found = small_copy(target.select(*keys).join(F.broadcast(own), list(keys), "left_semi"), max_rows)
    return target.select(*keys) if found is None else F.broadcast(found)


def already_processed(
    staged: DataFrame, target: DataFrame, keys: Sequence[str] = KEY, max_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Staged rows whose key the target already holds."""
    return staged.join(_held(staged, target, keys, max_rows), list(keys), "left_semi")


def first_per_key(df: DataFrame, seq: str = "seq", keys: Sequence[str] = KEY) -> DataFrame:
    """Earliest row of each key; map partitions are cut to one row per key before the shuffle."""
    return _one_per_key(df, F.asc(seq), keys)


def last_per_key(df: DataFrame, seq: str = "seq", keys: Sequence[str] = KEY) -> DataFrame:
    """Latest row of each key."""
    return _one_per_key(df, F.desc(seq), keys)


def _one_per_key(df: DataFrame, order: Column, keys: Sequence[str]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= 1).drop("_rank")


def insert_if_absent(
    staged: DataFrame, target: DataFrame, seq: str = "seq", keys: Sequence[str] = KEY, max_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Rows to insert: one per new key, the earliest; keys already loaded are skipped silently."""
    return first_per_key(staged, seq, keys).join(_held(staged, target, keys, max_rows), list(keys), "left_anti")


def upsert(
    staged: DataFrame,
    target: DataFrame,
    run_id: Column,
    now: Column,
    seq: str | None = "seq",
    keys: Sequence[str] = KEY,
) -> DataFrame:
    """The target after the load. The last staged row of a key replaces everything but ``created_at``.

    ``target`` may be just the partitions the load touches. Keys are unique on both sides once the staged
    rows are reduced, so the full outer join has no hot key; the shuffle of the reduction is reused by it.
    ``seq=None`` says the staged keys are unique already.
    """
    keys = list(keys)
    latest = staged if seq is None else last_per_key(staged, seq, keys)
    body = [c for c in target.columns if c not in (*keys, "run_id", "created_at")]
    new = latest.select(*keys, F.struct(*body).alias("_new"))
    old = target.select(*keys, F.struct(*body, "run_id", "created_at").alias("_old"))
    hit = F.col("_new").isNotNull()
    values = {c: F.when(hit, F.col("_new")[c]).otherwise(F.col("_old")[c]) for c in body}
    values["run_id"] = F.when(hit, run_id).otherwise(F.col("_old.run_id"))
    values["created_at"] = F.when(F.col("_old").isNull(), now).otherwise(F.col("_old.created_at"))
    return new.join(old, keys, "full_outer").select(
        *[F.col(c) if c in keys else values[c].alias(c) for c in target.columns])


def assign_batches(
    df: DataFrame, size: int = LOAD_BATCH, by: str = "source", seq: str = "seq", max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add ``row_index`` (0-based position within the source) and ``batch`` = floor(row_index / size).

    ``seq`` is a number, or the ``arrival`` key of rows read from files.
    """
    if isinstance(df.schema[seq].dataType, StructType):
        indexed = arrival_index(df, [by], "row_index", seq, max_rows)
    else:
        indexed = row_index(df, [by], seq, "row_index", max_rows)
    return indexed.withColumn("batch", F.floor(F.col("row_index") / size))


def resume_from(indexed: DataFrame, progress: DataFrame) -> DataFrame:
    """Rows at or after the saved index of their source; sources without progress start at 0."""
    saved = progress.select("source", "last_index")
    return (
        join_small(indexed, saved, ["source"], "left")
        .filter(F.col("row_index") >= F.coalesce("last_index", F.lit(0)))
        .drop("last_index")
    )


def resumed_batch(progress: DataFrame, size: int = LOAD_BATCH) -> DataFrame:
    """Batch each source resumes from; null where nothing had been done."""
    at = F.when(F.col("last_index") > 0, F.floor(F.col("last_index") / size))
    return progress.select("source", at.alias("resumed_from_batch"))


def progress_after(indexed: DataFrame, batch_id: Column, run_id: Column, now: Column) -> DataFrame:
    """Progress rows once ``indexed`` is loaded."""
    return indexed.groupBy("source").agg((F.max("row_index") + 1).alias("last_index")).select(
        batch_id.alias("batch_id"), "source", run_id.alias("run_id"),
        F.col("last_index").cast("long").alias("last_index"), now.alias("updated_at"))


def latest_progress(log: DataFrame) -> DataFrame:
    """Current progress per (batch id, source) of an append-only log; a last row without an index clears it."""
    newest = F.max_by(F.struct("run_id", "last_index", "updated_at"), F.struct("updated_at", "last_index"))
    return log.groupBy("batch_id", "source").agg(newest.alias("_row")).select(
        "batch_id", "source", "_row.*").filter(F.col("last_index").isNotNull())


def list_progress(log: DataFrame, run_id: str) -> DataFrame:
    """Progress of one run by source."""
    return latest_progress(log).filter(F.col("run_id") == run_id).orderBy("source")


def clear_progress(log: DataFrame, run_id: str) -> DataFrame:
    """The log without the keys whose current progress belongs to ``run_id``."""
    done = latest_progress(log).filter(F.col("run_id") == run_id).select("batch_id", "source")
    return log.join(done, ["batch_id", "source"], "left_anti")


def judge(marked: DataFrame, sources: Sequence[str] = SOURCES, payload: bool = True) -> DataFrame:
    """Replace ``watermark`` by ``error`` (first broken rule) and ``fate``: invalid, skipped, failed or load.

    A record is validated before its mark is looked at, and only a new, valid record meets the storage rules.
    """
    fate = (
        F.when(F.col("error").isNotNull(), "invalid")
        .when(~is_new(), "skipped")
        .when(~storage_ok(sources, payload), "failed")
        .otherwise("load")
    )
    return with_reason(marked, sources, payload).withColumn("fate", fate).drop("watermark")


def judge_rows(staged: DataFrame, watermarks: DataFrame, sources: Sequence[str] = SOURCES, payload: bool = True) -> DataFrame:
    """:func:`judge` with the marks of a watermark table."""
    return judge(with_watermark(staged, watermarks), sources, payload)


def load_report(judged: DataFrame, *more: Column) -> DataFrame:
    """Counts per source in one pass; ``processed`` is fetched less skipped, so it counts bad rows too."""
    def n(kind: str) -> Column:
        return F.count_if(F.col("fate") == kind)

    return judged.groupBy("source").agg(
        F.count(F.lit(1)).alias("fetched"),
        n("skipped").alias("skipped_by_watermark"),
        (F.count(F.lit(1)) - n("skipped")).alias("processed"),
        n("invalid").alias("validation_errors"),
        n("failed").alias("failed_records"),
        n("load").alias("loaded"),
        *more,
    )


def failed_ids(judged: DataFrame) -> DataFrame:
    """Every record the store refuses; kept as rows, since the list can be as long as the feed."""
    return judged.filter(F.col("fate") == "failed").select("source", "symbol", "timestamp")
