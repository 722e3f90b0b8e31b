"""The last values of every series, kept from one load to the next.

A row holds one series with its last values. A load writes a delta: the new rows of the series it touched, and no others.
What stands as of a generation is the newest row of each series in a base and the deltas after it. The series lie in
buckets by their hash, and a load reads the buckets of its own series only. After ``COMPACT_AFTER`` deltas the next read
folds them into a new base; the base before it and what came after that stay for repeats, everything older goes.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructType

from tidemark.operators.outliers import SERIES, history_tail
from tidemark.sources.log import drop_paths, matching

#: Buckets of series; a load reads those of its own series.
BUCKETS = 64
#: Deltas that are read one by one before they are folded into a base.
COMPACT_AFTER = 16
VALUES = ArrayType(StructType().add("seq", LongType()).add("value", DoubleType()))
TAIL = StructType().add("seq", LongType()).add("symbol", StringType()).add("field", StringType()).add("value", DoubleType())
_STATE = StructType().add("symbol", StringType()).add("field", StringType()).add("values", VALUES)
_BASE = StructType([*_STATE.fields]).add("bucket", IntegerType())
_DELTA = StructType([*_BASE.fields]).add("generation", LongType())


def _bucket() -> Column:
    return F.pmod(F.xxhash64(*SERIES), F.lit(BUCKETS)).cast("int")


class SeriesState:
    """State of all series below ``path``; generation 0 is empty, and each advance makes the next one."""

    def __init__(self, spark: SparkSession, path: str, compact_after: int = COMPACT_AFTER):
        self.spark, self.path, self.compact_after = spark, path.rstrip("/"), compact_after

    def _bases(self) -> list[int]:
        found = matching(self.spark, f"{self.path}.base-*/_SUCCESS")
        return sorted(int(re.search(r"\.base-(\d+)/_SUCCESS$", f)[1]) for f in found)

    def _deltas(self) -> list[int]:
        return sorted(int(re.search(r"generation=(\d+)/_SUCCESS$", f)[1])
                      for f in matching(self.spark, f"{self.path}/generation=*/_SUCCESS"))

    def newest(self) -> int:
        """The newest complete generation."""
        return max([0, *self._bases(), *self._deltas()])

    def _rows(self, base: int, deltas: list[int]) -> DataFrame:
        """Rows of a base and of deltas, each with the generation it is of."""
        rows = self.spark.createDataFrame([], _DELTA)
        if base:
            rows = rows.unionByName(self.spark.read.schema(_BASE).parquet(f"{self.path}.base-{base}").withColumn(
                "generation", F.lit(base).cast("long")))
        if deltas:
            rows = rows.unionByName(self.spark.read.schema(_DELTA).option("basePath", self.path).parquet(
                *[f"{self.path}/generation={k}" for k in deltas]))
        return rows

    def _as_of(self, generation: int) -> DataFrame:
        """All rows that a state as of ``generation`` is made of; folds them first when there are many deltas."""
        bases = [b for b in self._bases() if b <= generation]
        if not bases and len(self._bases()) > 1:  # with one base, the deltas from the first on are all there
            raise ValueError(f"the state as of generation {generation} is no longer kept")
        base = max(bases, default=0)
        deltas = [k for k in self._deltas() if base < k <= generation]
        if len(deltas) < self.compact_after:
            return self._rows(base, deltas)
        folded = self._newest_of(self._rows(base, deltas)).withColumn("bucket", _bucket())
        folded.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}.base-{generation}")
        self._drop_before(base)
        return self._rows(generation, [])

    def _drop_before(self, generation: int) -> None:
        for b in self._bases():
            if b < generation:
                drop_paths(self.spark, f"{self.path}.base-{b}")
        for k in self._deltas():
            if k <= generation:
                drop_paths(self.spark, f"{self.path}/generation={k}")

    @staticmethod
    def _newest_of(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*SERIES).agg(F.max_by("values", "generation").alias("values"))

    def values(self, generation: int, touched: DataFrame | None = None) -> DataFrame:
        """(symbol, field, values) as of ``generation``, of the series in ``touched`` or of all."""
        rows = self._as_of(generation)
        if touched is not None:
            series = touched.select(*SERIES, _bucket().alias("bucket")).distinct()
            buckets = [r[0] for r in series.select("bucket").distinct().collect()]  # BUCKETS numbers at most
            rows = rows.where(F.col("bucket").isin(buckets)).join(series, [*SERIES, "bucket"], "left_semi")
        return self._newest_of(rows)

    def tail(self, generation: int, touched: DataFrame | None = None) -> DataFrame:
        """The same with a row (seq, symbol, field, value) for each value."""
        return self.values(generation, touched).select("symbol", "field", F.inline("values")).select(*TAIL.names)

    def advance(self, long: DataFrame, tail: DataFrame, generation: int) -> None:
        """Write the series of ``long`` as they stand after it as ``generation``; ``tail`` is what stood before of them.

        A repeat replaces what the first attempt wrote.
        """
        kept = history_tail(long.select(*TAIL.names).unionByName(tail))
        rows = kept.groupBy(*SERIES).agg(F.sort_array(F.collect_list(F.struct("seq", "value"))).alias("values"))
        rows.withColumn("bucket", _bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.path}/generation={generation}")

    def stats(self) -> DataFrame:
        """Count, latest value and mean of each series' last values, from the state alone."""
        total = F.aggregate("values", F.lit(0.0), lambda acc, v: acc + v["value"])
        return self.values(self.newest()).select(
            *SERIES, F.size("values").cast("long").alias("count"), F.element_at("values", -1)["value"].alias("latest"),
            (total / F.size("values")).alias("mean"))
