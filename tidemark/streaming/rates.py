"""Per-second rates over event-time windows of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType, TimestampType

from tidemark.plans import bindings
from tidemark.session import new_scratch
from tidemark.sources.log import COMPACT_AFTER, Log, matching


def _summed(rows: DataFrame) -> DataFrame:
    """Rows of a window added up; none of them is written again, so they need no part of their own."""
    labels = [c for c in rows.columns if c not in ("n", "part")]
    return rows.groupBy(*labels).agg(F.sum("n").alias("n")).withColumn("part", F.lit("all"))


def rate_stream(
    stream: DataFrame, labels: Sequence[str], out: str, checkpoint: str, ts: str = "timestamp", span_s: int = 300,
    compact_after: int = COMPACT_AFTER,
) -> StreamingQuery:
    """Count per window and label, each micro-batch by itself under its own number.

    The counts of a window add up over the batches, so a row counts in its window however late it comes, and a replayed
    batch replaces what it wrote before. They are kept in a log that adds up finished batches from time to time, so a
    reader opens a bounded number of files after however many batches.
    """
    window = F.window(ts, f"{span_s} seconds").alias("_w")
    schema = StructType().add("window_start", TimestampType())
    for label in labels:
        schema = schema.add(label, stream.schema[label].dataType)
    log = Log(stream.sparkSession, out, schema.add("n", LongType()), _summed, compact_after)

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(window, *labels).agg(F.count(F.lit(1)).alias("n"))
        log.append(counts.select(F.col("_w.start").alias("window_start"), *labels, "n"), f"batch-{batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_rates(spark: SparkSession, out: str, labels: Sequence[str], span_s: int = 300) -> DataFrame:
    """Rate of every window over all batches so far."""
    written = matching(spark, f"{out}.v*/base") or [out]
    log = Log(spark, out, spark.read.parquet(written[0]).select("window_start", *labels, "n").schema)
    return log.read().groupBy("window_start", *labels).agg((F.sum("n") / span_s).alias("rate"))


def run_on_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch(spark, "rate-stream")
    records = bindings.ticks_of(bindings.event_stream(spark, sf_dir)).select("timestamp", "source")
    rate_stream(records, ["source"], f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return current_rates(spark, f"{path}/out", ["source"])
