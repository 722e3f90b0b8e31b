"""Outlier detection over a stream: the batch operator seeded with the saved last values of every series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.outliers import detect_outliers, explode_fields
from tidemark.plans import bindings
from tidemark.session import new_scratch
from tidemark.sources.log import drop_paths
from tidemark.sources.tables import Tables


def detect_batch(tables: Tables, batch: DataFrame, batch_id: int) -> None:
    """State generation ``n`` is what stood before batch ``n``; a replayed batch reads it again.

    Read and written are the series of the batch alone. Of the rows that arrived, those of the batch before go.
    """
    path = tables.path(f"arrived/batch-{batch_id}")
    batch.write.mode("overwrite").parquet(path)
    arrived = tables.spark.read.parquet(path)
    long = explode_fields(arrived)
    tail = tables.outlier_tail(batch_id, long)
    tables.write_outliers(detect_outliers(arrived, tail=tail), f"batch-{batch_id}")
    tables.advance_tail(long, tail, batch_id + 1)
    drop_paths(tables.spark, tables.path(f"arrived/batch-{batch_id - 1}"))


def outlier_stream(stream: DataFrame, tables: Tables, checkpoint: str) -> StreamingQuery:
    """Detect outliers in arrival order (``seq``) until the source is drained, then stop."""
    return (
        stream.writeStream.foreachBatch(lambda batch, i: detect_batch(tables, batch, i))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def found(tables: Tables) -> DataFrame:
    """All outliers of the stream so far."""
    return tables.spark.read.parquet(tables.path("outliers/*"))


def tables_of_events(spark: SparkSession, sf_dir: str) -> Tables:
    tables = Tables(spark, new_scratch(spark, "outlier-stream"))
    records = bindings.ticks_of(bindings.event_stream(spark, sf_dir))
    outlier_stream(records, tables, tables.path("checkpoint")).awaitTermination()
    return tables


def run_on_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(tables_of_events(spark, sf_dir)).select(
        "seq", "symbol", "field", "value", "type", "threshold", F.col("actual"))
