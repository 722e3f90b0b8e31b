"""Incremental ingest as a stream: the steps of a load run inside ``foreachBatch``.

Rows at or below the mark of their source are late; they are judged ``skipped`` and counted. The mark is per source and
has no delay, so an event-time watermark of the stream, which is global and moves with every batch, would differ.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.model import KEY, SOURCES
from tidemark.operators import load
from tidemark.plans import bindings
from tidemark.session import new_scratch
from tidemark.sources.tables import Tables


def dedupe_batch(batch: DataFrame, seq: str = "seq") -> DataFrame:
    """One row per key within a micro-batch, the last; across batches the upsert keeps keys unique."""
    return load.last_per_key(batch, seq, KEY)


def load_batch(
    tables: Tables, batch: DataFrame, batch_id: int, now: Column, sources: Sequence[str] = SOURCES,
    name: str = "batch",
) -> None:
    """Stage, judge and merge one micro-batch. Everything is keyed by the batch id, so a replay is harmless.

    What the batch before kept for its replay is dropped: a batch starts once the one before it is committed.
    """
    load_id = f"{name}-{batch_id}"
    tables.recover()
    tables.forget(f"{name}-{batch_id - 1}")
    path = tables.path(f"staged/{load_id}")
    load.judge_rows(batch, tables.marks(load_id), sources).write.mode("overwrite").parquet(path)
    staged = tables.spark.read.parquet(path)
    tables.write_failed(load.failed_ids(staged), load_id)
    tables.upsert(dedupe_batch(staged.filter(F.col("fate") == "load")), load_id, now, seq=None)
    load.load_report(staged).withColumn("load_id", F.lit(load_id)).write.mode("overwrite").parquet(
        tables.path(f"load_reports/{load_id}"))


def incremental_ingest_stream(
    stream: DataFrame,
    tables: Tables,
    checkpoint: str,
    now: Callable[[], Column] = F.current_timestamp,
    sources: Sequence[str] = SOURCES,
) -> StreamingQuery:
    """Load unified records (with ``seq`` and ``raw_data``) until the source is drained, then stop."""
    return (
        stream.writeStream.foreachBatch(lambda batch, i: load_batch(tables, batch, i, now(), sources))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_on_events(spark: SparkSession, sf_dir: str) -> Tables:
    tables = Tables(spark, new_scratch(spark, "ingest-stream"))
    records = bindings.dirty_of(bindings.event_stream(spark, sf_dir))
    incremental_ingest_stream(
        records, tables, tables.path("checkpoint"), lambda: F.lit("2024-02-01").cast("timestamp"),
    ).awaitTermination()
    return tables


# Event times of three deliveries, open at both ends; each repeats some of the one before, and what it repeats is late.
# Events without a time come with the first.
DELIVERIES = ((None, "2024-01-12"), ("2024-01-08", "2024-01-20"), ("2024-01-16", None))
# Numbers of corrected records lie above those of the events.
CORRECTED = 1_000_000_000


def delivery(whole: DataFrame, start: str | None, end: str | None) -> DataFrame:
    ts, inside = F.col("ts"), F.lit(True)
    if start is not None:
        inside = inside & (ts >= F.lit(start).cast("timestamp"))
    if end is not None:
        inside = inside & (ts < F.lit(end).cast("timestamp"))
    return whole.filter(inside if start is not None else F.coalesce(inside, F.lit(True)))


def run_on_deliveries(spark: SparkSession, sf_dir: str, corrected: bool = False) -> Tables:
    """Events arriving in three overlapping deliveries, every one a micro-batch taken up from the checkpoint.

    With ``corrected`` an event whose payload number is 50 or more comes a second time in the same delivery, under the
    same key with its value raised by 1.
    """
    tables, folder = Tables(spark, new_scratch(spark, "ingest-deliveries")), new_scratch(spark, "deliveries")
    whole = bindings.table(spark, sf_dir, "events")
    for start, end in DELIVERIES:
        part = delivery(whole, start, end)
        if corrected:
            again = part.filter(F.get_json_object("props", "$.k").cast("int") >= 50).withColumns({
                "event_id": (F.col("event_id") + CORRECTED).cast(whole.schema["event_id"].dataType), "value": F.col("value") + 1})
            part = part.unionByName(again)
        part.write.mode("append").parquet(folder)
        stream = bindings.with_number(spark.readStream.schema(whole.schema).parquet(folder))
        incremental_ingest_stream(
            bindings.dirty_of(stream), tables, tables.path("checkpoint"), lambda: F.lit("2024-02-01").cast("timestamp"),
        ).awaitTermination()
    return tables
