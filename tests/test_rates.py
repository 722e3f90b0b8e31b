"""Rates of a stream whose files arrive out of order equal those of the batch."""

from pyspark.sql import functions as F

from tidemark.operators.monitor import counter_rate
from tidemark.streaming.rates import current_rates, rate_stream


def test_late_rows_count_in_their_window(spark, tmp_path):
    rows = spark.range(600).select(
        F.timestamp_seconds(F.col("id") * 37 + 1_700_000_000).alias("timestamp"),
        F.when(F.col("id") % 3 > 0, "a").alias("source"))
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for late in (False, True):  # the older half is delivered last
        half = F.col("timestamp") < F.timestamp_seconds(F.lit(1_700_000_000 + 37 * 300))
        rows.filter(half if late else ~half).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        rate_stream(stream, ["source"], out, str(tmp_path / "checkpoint")).awaitTermination()
    want = counter_rate(rows, ["source"]).collect()
    got = current_rates(spark, out, ["source"]).collect()
    key = lambda r: (r["window_start"], r["source"] or "")
    assert sorted(map(tuple, want), key=str) == sorted(map(tuple, got), key=str) and len(got) == len({key(r) for r in got})
