"""The stored tables as Parquet folders, and the writes that survive a lost executor or a killed driver.

Both data tables are partitioned by source and day, so filters on source and time prune folders and an upsert
rewrites only the days it touches. An upsert is written in two steps: the merged days go to a ``pending``
folder of the load first, and only then replace the same days of the tables. Either step can simply be run
again: the second one reads nothing but ``pending``, and ``recover`` does so for loads that were cut short.

High-water marks are carried forward: a load that is published logs the newest time of what it wrote, and the mark of a
source is the largest of those. No load reads the tables to learn them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructType, TimestampType

from tidemark.model import NORMALIZED, PROGRESS, RAW, REGISTRY, RUNS, SUMMARIES
from tidemark.operators.load import (
    already_processed, insert_if_absent, latest_progress, list_progress, source_watermarks, upsert,
)
from tidemark.operators.skew import join_keys
from tidemark.sources.log import COMPACT_AFTER, Log, drop_paths, file_system, matching
from tidemark.sources.ordered import OrderedCopy, touched_days
from tidemark.sources.series import SeriesState

PARTITIONS = ["source", "day"]
LOADS = StructType().add("load_id", StringType()).add("state", StringType())
MARKS = StructType().add("source", StringType()).add("watermark", TimestampType())
# An upsert touching more partitions than this looks them up by join rather than by a literal list.
MAX_LISTED = 5_000


def gather_days(df: DataFrame) -> DataFrame:
    """Bring rows of one (source, day) together for writing.

    ``rebalance`` lets AQE merge small partitions and split large ones, so a hot source or day becomes neither
    one task nor one file. Sorting by symbol inside the day lets a symbol filter skip row groups.
    """
    dated = df.withColumn("day", F.to_date("timestamp")).hint("rebalance", *PARTITIONS)
    return dated.sortWithinPartitions(*PARTITIONS, "symbol", "timestamp")


def write_data(df: DataFrame, path: str, mode: str = "append", overwrite: str = "dynamic") -> None:
    """Write rows that have a ``day`` into their (source, day) folders."""
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", overwrite)
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def unfinished_loads(rows: DataFrame) -> DataFrame:
    """Log rows of loads that were merged but not published."""
    done = rows.filter("state = 'done'").select("load_id").distinct()
    return rows.join(done, "load_id", "left_anti")


def newest_progress(rows: DataFrame) -> DataFrame:
    """Log rows with the current progress of a (batch id, source); cleared progress goes."""
    body = [c for c in rows.columns if c not in ("batch_id", "source")]
    newest = F.max_by(F.struct(*body), F.struct("updated_at", "last_index"))
    return rows.groupBy("batch_id", "source").agg(newest.alias("_row")).select(
        "batch_id", "source", "_row.*").filter("last_index is not null")


def largest_marks(rows: DataFrame) -> DataFrame:
    """One mark per source; marks only rise, so none has to be replaced later."""
    return rows.groupBy("source").agg(F.max("watermark").alias("watermark")).withColumn("part", F.lit("all"))


#: Logs of the warehouse with their columns and what of them is kept for good.
LOGS = {
    "runs": (RUNS, None), "run_summaries": (SUMMARIES, None), "schema_registry": (REGISTRY, None),
    "loads": (LOADS, unfinished_loads), "batch_progress": (PROGRESS, newest_progress), "mark_log": (MARKS, largest_marks),
}


class Tables:
    """All tables of one warehouse folder."""

    def __init__(self, spark: SparkSession, root: str, compact_after: int = COMPACT_AFTER):
        self.spark = spark
        self.root = root.rstrip("/")
        self.compact_after = compact_after
        self.series = SeriesState(spark, self.path("outlier_tail"))
        self.logs = {n: Log(spark, self.path(n), schema, fold, compact_after) for n, (schema, fold) in LOGS.items()}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        path, files = file_system(self.spark, self.path(name))
        return files.exists(path)

    def complete(self, name: str) -> bool:
        """Whether the last write to the folder was committed; a killed one leaves the folder without its mark."""
        path, files = file_system(self.spark, f"{self.path(name)}/_SUCCESS")
        return files.exists(path)

    def forget(self, load_id: str, snapshot_id: str | None = None) -> None:
        """Drop what a finished load kept for being repeated: staged rows, pending days, start marks and start of
        the outlier history. A load that is not published yet keeps all of it."""
        if load_id in self.open_loads():
            raise ValueError(f"load {load_id!r} is not published yet")
        snapshot_id = snapshot_id or load_id
        for name in (f"staged/{load_id}", f"pending/{load_id}", f"marks/{snapshot_id}", f"tail_start/{snapshot_id}-*"):
            drop_paths(self.spark, self.path(name))

    def _read(self, name: str, schema: StructType) -> DataFrame:
        if not self.exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(name))

    def _read_data(self, name: str, schema: StructType) -> DataFrame:
        return self._read(name, StructType([*schema.fields]).add("day", DateType()))

    def raw(self) -> DataFrame:
        return self._read_data("raw", RAW).drop("day").select(*RAW.names)

    def normalized(self) -> DataFrame:
        return self._read_data("normalized", NORMALIZED).drop("day").select(*NORMALIZED.names)

    def served(self) -> DataFrame:
        """Normalized rows with their ``day``, so that the serving queries can prune folders."""
        return self._read_data("normalized", NORMALIZED)

    def days(self) -> list[str]:
        """Days that have a folder, by listing folders alone."""
        found = matching(self.spark, f"{self.path('normalized')}/source=*/day=*")
        return sorted({f.rsplit("day=", 1)[1] for f in found} - {"__HIVE_DEFAULT_PARTITION__"})

    def watermarks(self) -> DataFrame:
        """Newest timestamp per source, from the log of published loads alone.

        A warehouse that was filled before there was a log is looked through once.
        """
        if self.logs["mark_log"].read().isEmpty() and self.exists("normalized"):
            self._move_marks(self._marks_of_newest_days(), "found")
        return largest_marks(self.logs["mark_log"].read()).drop("part")

    def _marks_of_newest_days(self) -> DataFrame:
        """Newest timestamp per source of the stored rows: it lies in the newest day of the source, and the days are
        known from the folders, so only those days' timestamps are read."""
        stored = self.served()
        newest = stored.groupBy("source").agg(F.max("day").alias("day")).limit(MAX_LISTED + 1).collect()
        if len(newest) <= MAX_LISTED:
            condition = F.lit(False)
            for source, day in newest:
                condition = condition | (F.col("source").eqNullSafe(source) & (F.col("day") == day))
            stored = stored.filter(condition)
        return source_watermarks(stored)

    def _move_marks(self, marks: DataFrame, part: str) -> None:
        self.logs["mark_log"].append(marks, part)

    def runs(self) -> DataFrame:
        return self.logs["runs"].read()

    def summaries(self) -> DataFrame:
        return self.logs["run_summaries"].read()

    def progress(self) -> DataFrame:
        return self.logs["batch_progress"].read()

    def registry(self) -> DataFrame:
        return self.logs["schema_registry"].read()

    # --- writes ------------------------------------------------------------------------------

    def write_raw(self, df: DataFrame) -> None:
        """Append full rows."""
        write_data(gather_days(df.select(*RAW.names)), self.path("raw"))

    def write_normalized(self, df: DataFrame) -> None:
        """Append rows without their payload; ``df`` is read a second time for their marks."""
        marks = self.watermarks()  # of what is there already, should there be no log yet
        part = f"plain-{uuid.uuid4().hex}"
        self._touch(touched_days(df), part)
        write_data(gather_days(df.select(*NORMALIZED.names)), self.path("normalized"))
        self._move_marks(largest_marks(marks.unionByName(source_watermarks(df))).drop("part"), part)

    def append(self, name: str, df: DataFrame, part: str) -> None:
        """Append to one of the logs under ``part``; running the same part again replaces it."""
        self.logs[name].append(df, part)

    def write_run(self, record: DataFrame, run_id: str) -> None:
        self.append("runs", record, run_id)

    def write_summary(self, summary: DataFrame, run_id: str) -> None:
        self.append("run_summaries", summary, run_id)

    def save_progress(self, progress: DataFrame, part: str) -> None:
        self.append("batch_progress", progress, part)

    def clear_progress(self, run_id: str, batch_ids: list[str] | None = None) -> None:
        """Forget the progress of a finished run, or all progress under ``batch_ids`` whichever run made it, by
        appending rows without an index."""
        if batch_ids is None:
            current = list_progress(self.progress(), run_id)
        else:
            current = latest_progress(self.progress()).filter(F.col("batch_id").isin(batch_ids))
        gone = current.withColumns({
            "last_index": F.lit(None).cast("long"),
            "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 MICROSECOND"),
        })
        self.save_progress(gone, f"{run_id}-cleared")

    def marks(self, snapshot_id: str) -> DataFrame:
        """High-water marks as they stood when the snapshot was first loaded; a repeat gets the same ones."""
        name = f"marks/{snapshot_id}"
        if not self.complete(name):
            self.watermarks().write.mode("overwrite").parquet(self.path(name))
        return self._read(name, MARKS)

    def affected_days(self, name: str, schema: StructType, staged: DataFrame) -> DataFrame:
        """The stored rows of the (source, day) folders that ``staged`` touches, by partition pruning."""
        return self._of_days(self._read_data(name, schema), touched_days(staged)).select(*schema.names)

    def _of_days(self, stored: DataFrame, days: DataFrame) -> DataFrame:
        listed = days.limit(MAX_LISTED + 1).collect()
        if len(listed) > MAX_LISTED:
            return join_keys(stored, days, PARTITIONS, "left_semi")
        by_source: dict[str | None, list] = {}
        for source, day in listed:
            by_source.setdefault(source, []).append(day)
        condition = F.lit(False)
        for source, when in by_source.items():
            dated = F.col("day").isin(*[d for d in when if d is not None])
            if None in when:
                dated = dated | F.col("day").isNull()
            condition = condition | (F.col("source").eqNullSafe(source) & dated)
        return stored.filter(condition)

    def ordered(self, by: str) -> OrderedCopy:
        """The copy of the served rows in the order of ``by``; there is one after its first ``refresh``."""
        return OrderedCopy(
            self.spark, self.path("ordered"), by, self.served, lambda days: self._of_days(self.served(), days),
            compact_after=self.compact_after)

    def _touch(self, days: DataFrame, part: str) -> None:
        for path in matching(self.spark, f"{self.path('ordered')}/*"):
            self.ordered(path.rsplit("/", 1)[1]).touch(days, part)

    def already_processed(self, staged: DataFrame) -> DataFrame:
        """Staged rows whose key is stored; looked for in the (source, day) folders of the staged rows only."""
        return already_processed(staged, self.affected_days("normalized", NORMALIZED, staged))

    def insert_if_absent(self, staged: DataFrame, seq: str = "seq") -> DataFrame:
        """Staged rows of new keys, one for each; looked for in the (source, day) folders of the staged rows only."""
        return insert_if_absent(staged, self.affected_days("normalized", NORMALIZED, staged), seq)

    def upsert(
        self, staged: DataFrame, load_id: str, now: Column, seq: str | None = "seq", run_id: str | None = None,
    ) -> None:
        """Merge validated rows into both data tables under the load's own ``pending`` folder."""
        target = self.affected_days("raw", RAW, staged)
        merged = upsert(staged, target, F.lit(run_id or load_id), now, seq)
        write_data(gather_days(merged), self.path(f"pending/{load_id}"), "overwrite", "static")
        self._log_load(load_id, "ready")
        self.publish(load_id)

    def publish(self, load_id: str) -> None:
        """Replace the touched days of both tables with the load's pending rows; safe to repeat.

        The pending files already lie by source and day, so these writes need no shuffle. Marks rise last, before the
        load is done: whoever comes in between repeats this first.
        """
        merged = self._read_data(f"pending/{load_id}", RAW)
        self._touch(touched_days(merged), load_id)
        write_data(merged.select(*RAW.names, "day"), self.path("raw"), "overwrite")
        write_data(merged.select(*NORMALIZED.names, "day"), self.path("normalized"), "overwrite")
        self._move_marks(source_watermarks(merged), load_id)
        self._log_load(load_id, "done")

    def _log_load(self, load_id: str, state: str) -> None:
        self.append("loads", self.spark.createDataFrame([(load_id, state)], LOADS), f"{load_id}-{state}")

    def open_loads(self) -> list[str]:
        """Loads that were merged but not finished publishing."""
        return sorted(r[0] for r in unfinished_loads(self.logs["loads"].read()).select("load_id").distinct().collect())

    def recover(self) -> list[str]:
        """Publish again what a killed run had merged but not finished publishing."""
        open_loads = self.open_loads()
        for load_id in open_loads:
            self.publish(load_id)
        return open_loads

    # --- outlier state -----------------------------------------------------------------------

    def tail_generation(self, load_id: str) -> int:
        """Generation of the saved history a load starts from; a repeat of the load starts from the same one."""
        name, schema = f"tail_start/{load_id}", StructType().add("g", LongType())
        if not self.complete(name):
            self.spark.createDataFrame([(self.series.newest(),)], schema).write.mode("overwrite").parquet(self.path(name))
        return self._read(name, schema).first()[0]

    def outlier_tail(self, generation: int, touched: DataFrame | None = None) -> DataFrame:
        """Saved history as of one generation: the last values of the series in ``touched``, or of all."""
        return self.series.tail(generation, touched)

    def advance_tail(self, long: DataFrame, tail: DataFrame, generation: int) -> None:
        """Save the history after ``long`` as ``generation``; only the series of ``long`` are written."""
        self.series.advance(long, tail, generation)

    def write_outliers(self, found: DataFrame, run_id: str) -> None:
        found.write.mode("overwrite").parquet(self.path(f"outliers/{run_id}"))

    def outliers(self, run_id: str) -> DataFrame:
        return self.spark.read.parquet(self.path(f"outliers/{run_id}"))

    def write_failed(self, failed: DataFrame, run_id: str) -> None:
        failed.write.mode("overwrite").parquet(self.path(f"failed/{run_id}"))
