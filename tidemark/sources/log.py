"""Append-only tables that stay cheap to read: a snapshot plus a short tail.

Rows are appended under a ``part``; appending a part again replaces it, so whoever is repeated after a crash changes
nothing. Once the tail holds ``COMPACT_AFTER`` parts, the next append first writes what is current as the snapshot of a
new generation. A generation counts from the moment its snapshot is committed: a compaction that was cut short leaves
the generation before it in force and is simply done again. Readers open one snapshot and at most ``COMPACT_AFTER``
parts, however many appends there have been. One writer at a time is assumed.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

#: Parts of the tail that are read one by one before they are folded into a snapshot.
COMPACT_AFTER = 32


def file_system(spark: SparkSession, path: str):
    """(path, file system) as Hadoop objects; whatever store Spark reads is listed through them."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern finds."""
    path, files = file_system(spark, pattern)
    return [str(f.getPath().toString()) for f in files.globStatus(path) or []]


def drop_paths(spark: SparkSession, pattern: str) -> None:
    path, files = file_system(spark, pattern)
    for found in files.globStatus(path) or []:
        files.delete(found.getPath(), True)


class Log:
    """Rows of ``schema`` below ``path``. ``fold`` takes all current rows, with their ``part``, to those worth keeping
    (with a ``part``, under which a repeat would replace them); by default all are."""

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, fold: Callable[[DataFrame], DataFrame] | None = None,
        compact_after: int = COMPACT_AFTER,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.fold, self.compact_after = fold or (lambda rows: rows), compact_after
        self.stored = StructType([*schema.fields]).add("part", StringType())

    def generation(self) -> int:
        """The newest generation whose snapshot is complete; 0 is the tail alone."""
        found = matching(self.spark, f"{self.path}.v*/base/_SUCCESS")
        return max([int(re.search(r"\.v(\d+)/base/_SUCCESS$", f)[1]) for f in found], default=0)

    def _tail(self, generation: int) -> str:
        return f"{self.path}.v{generation}/tail" if generation else self.path

    def _read(self, path: str) -> DataFrame:
        try:
            return self.spark.read.schema(self.stored).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.stored)

    def rows(self) -> DataFrame:
        """All current rows with their ``part``."""
        generation = self.generation()
        tail = self._read(self._tail(generation))
        if not generation:
            return tail
        base = self._read(f"{self.path}.v{generation}/base")
        return base.join(tail.select("part").distinct(), "part", "left_anti").select(*self.stored.names).unionByName(tail)

    def read(self) -> DataFrame:
        return self.rows().select(*self.schema.names)

    def append(self, df: DataFrame, part: str) -> None:
        generation = self.generation()
        if len(matching(self.spark, f"{self._tail(generation)}/part=*")) >= self.compact_after:
            generation = self.compact(part)
        df.select(*self.schema.names).withColumn("part", F.lit(part)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("part").parquet(self._tail(generation))

    def compact(self, without: str | None = None) -> int:
        """Write the current rows as the next generation's snapshot, but for a part that is about to be written again.
        The generation before it stays on disk for whoever is still reading, older ones go."""
        old = self.generation()
        target = f"{self.path}.v{old + 1}/base"
        # A rebalance makes files of the advised size, so a small log is one file and a large one many.
        rows = self.rows() if without is None else self.rows().filter(F.col("part") != without)
        self.fold(rows).select(*self.stored.names).hint("rebalance").write.mode("overwrite").parquet(target)
        if old == 1:
            drop_paths(self.spark, f"{self.path}/part=*")
        elif old > 1:
            drop_paths(self.spark, f"{self.path}.v{old - 1}")
        return old + 1
