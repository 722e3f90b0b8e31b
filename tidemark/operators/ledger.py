"""Run summary and ledger row, aggregated from the per-source reports of one or many runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

# Reports hold one row per (run, source). Lists are gathered per run and are as long as its list of sources.


def _zero(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")


def _gather(c: str) -> Column:
    """The lists of a run's sources one after the other, sources in order."""
    by_source = F.array_sort(F.collect_list(F.struct(_named(), F.col(c).alias("list"))))
    return F.flatten(F.transform(by_source, lambda e: F.coalesce(e["list"], F.array())))


def _named() -> Column:
    return F.coalesce("source", F.lit("unknown")).alias("source")


def _by_source(value: Column, merge: Callable[[Column], Column]) -> Column:
    """A map from source to the merged values of its reports; reports without a source count as ``unknown``."""
    entries = F.collect_list(F.when(value.isNotNull(), F.struct(_named(), value.alias("value"))))
    sources = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["source"])))
    own = lambda s: F.transform(F.filter(entries, lambda e: e["source"] == s), lambda e: e["value"])
    return F.map_from_arrays(sources, F.transform(sources, lambda s: merge(own(s))))


def _resume_info() -> Column:
    return _by_source(F.col("resumed_from_batch"), F.array_min)


def run_summary(reports: DataFrame, now: Column) -> DataFrame:
    """Totals of each run. Valid rows are the processed ones; invalid are failed plus rule-breaking ones."""
    return (
        reports.groupBy("run_id")
        .agg(
            _zero("fetched").alias("total_fetched"),
            _zero("processed").alias("valid_records"),
            (_zero("failed_records") + _zero("validation_errors")).alias("invalid_records"),
            _zero("validation_errors").alias("validation_errors"),
            _zero("failed_records").alias("failed_records"),
            _by_source(F.coalesce("fetched", F.lit(0)).cast("long"), lambda v: F.aggregate(v, F.lit(0).cast("long"), lambda a, x: a + x)).alias("sources"),
            _gather("failed_batches").alias("failed_batches"),
            _resume_info().alias("resume_info"),
        )
        .withColumn("timestamp", now)
    )


def run_status(reports: DataFrame) -> DataFrame:
    """partial_success as soon as one batch of the run failed, else success."""
    failed = F.coalesce(F.sum(F.size("failed_batches")), F.lit(0))
    return reports.groupBy("run_id").agg(
        F.when(failed > 0, "partial_success").otherwise("success").alias("status"))


def run_record(
    reports: DataFrame, started: Column, ended: Column, throttle_events: Column | None = None,
) -> DataFrame:
    """Ledger row of each run; ``batches`` lists what each source really loaded."""
    flat = reports.withColumn("schema_warnings", F.transform(
        F.concat("quarantined_mappings", "skipped_mappings"),
        lambda m: F.concat_ws(" -> ", m["from"], m["to"])))
    return (
        flat.groupBy("run_id")
        .agg(
            _zero("processed").alias("rows_processed"),
            _zero("loaded").alias("rows_loaded"),
            _zero("skipped_by_watermark").alias("duplicates_skipped"),
            (_zero("failed_records") + _zero("validation_errors")).alias("errors"),
            F.array_sort(F.array_distinct(_gather("skipped_fields"))).alias("skipped_fields"),
            _gather("applied_mappings").alias("applied_mappings"),
            _gather("quarantined_mappings").alias("quarantined_mappings"),
            _gather("skipped_mappings").alias("skipped_mappings"),
            _gather("schema_warnings").alias("schema_warnings"),
            F.coalesce(F.max("schema_version"), F.lit(1)).alias("schema_version"),
            _gather("failed_batches").alias("failed_batches"),
            _resume_info().alias("resume_info"),
            F.array_sort(F.collect_list(F.struct(
                F.col("source"), F.col("loaded").alias("rows"),
                F.when(F.size("failed_batches") > 0, "failed").otherwise("success").alias("status"),
            ))).alias("_batches"),
            F.array_sort(F.collect_set("source")).alias("sources"),
        )
        .select(
            "run_id", started.alias("start_time"), ended.alias("end_time"),
            F.when(F.size("failed_batches") > 0, "partial_success").otherwise("success").alias("status"),
            "rows_processed", "rows_loaded", "duplicates_skipped", "errors", "skipped_fields",
            (F.unix_millis(ended) - F.unix_millis(started)).alias("total_latency_ms"),
            "applied_mappings", "quarantined_mappings", "skipped_mappings", "schema_warnings",
            "schema_version", "failed_batches", "resume_info",
            F.coalesce(throttle_events if throttle_events is not None else F.lit(0), F.lit(0))
            .cast("long").alias("throttle_events"),
            F.lit(None).cast("string").alias("error_message"),
            F.transform("_batches", lambda b, i: F.struct(
                (i + 1).cast("long").alias("no"), b["rows"].alias("rows"), b["status"].alias("status"),
                b["source"].alias("source"))).alias("batches"),
            "sources",
        )
    )


def failed_run(record: DataFrame, message: str) -> DataFrame:
    """The ledger row of a run that was aborted: status failed, one more error, the message."""
    return record.withColumns({
        "status": F.lit("failed"),
        "errors": F.col("errors") + 1,
        "error_message": F.lit(message),
    })
