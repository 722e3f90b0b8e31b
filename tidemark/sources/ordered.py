"""Copies of the served rows in the order of another column, for pages that are sorted by it.

The tables lie by source and day, so a page of the largest volumes would look through all of them. An ordered copy is cut
into zones, ranges of one total order (the column, then the row id, so that a value a third of the rows have is cut like
any other), found by Spark's sample of that order. Every zone is a folder, and a small table has its smallest and largest
value. A page opens the first zones that hold enough rows.

A load does not touch the copy. Before its days are published they are noted as touched: from then on their rows are read
from the tables and no longer from the copy, until ``refresh`` writes the next copy. A copy counts once its table of zones
is committed; the one before it stays for whoever is still reading. One writer at a time is assumed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructType

from tidemark.operators.serve import ROW_ID, Page, after, limit_clamp, page_data, page_frame
from tidemark.operators.skew import join_keys
from tidemark.sources.log import COMPACT_AFTER, Log, drop_paths, matching

#: Rows a zone is meant to hold, and the most zones of a copy; their bounds are what the driver holds.
ZONE_ROWS, MAX_ZONES = 1_000_000, 10_000
DAYS = StructType().add("source", StringType()).add("day", DateType())


def touched_days(rows: DataFrame) -> DataFrame:
    return rows.select("source", F.to_date("timestamp").alias("day")).distinct()


class Zone(NamedTuple):
    zone: int
    low: Any
    high: Any
    nulls: int


class OrderedCopy:
    """``served()`` gives all rows with their ``day``; ``of_days(days)`` those of some (source, day) folders."""

    def __init__(
        self, spark: SparkSession, root: str, by: str, served: Callable[[], DataFrame],
        of_days: Callable[[DataFrame], DataFrame], row_id: Sequence[str] = ROW_ID, compact_after: int = COMPACT_AFTER,
    ):
        if by == "timestamp":
            raise ValueError("the tables lie by time already")
        self.spark, self.root, self.by = spark, f"{root}/{by}", by
        self.served, self.of_days, self.row_id, self.compact_after = served, of_days, row_id, compact_after

    def generation(self) -> int:
        found = matching(self.spark, f"{self.root}/v*/zones/_SUCCESS")
        return max([int(re.search(r"/v(\d+)/zones/_SUCCESS$", f)[1]) for f in found], default=0)

    def _touched(self, generation: int) -> Log:
        return Log(self.spark, f"{self.root}/v{generation}/touched", DAYS, compact_after=self.compact_after,
                   fold=lambda rows: rows.select(*DAYS.names).distinct().withColumn("part", F.lit("all")))

    def touch(self, days: DataFrame, part: str) -> None:
        """Note the days a load is about to replace; repeating a load changes nothing."""
        generation = self.generation()
        if generation:
            self._touched(generation).append(days, part)

    def refresh(self, zone_rows: int = ZONE_ROWS) -> int:
        """Write the next copy from the tables. The order is a total one but for repeated rows, so no zone is much larger
        than the others."""
        old, rows = self.generation(), self.served()
        zones = max(1, min(MAX_ZONES, -(-rows.count() // zone_rows)))
        target = f"{self.root}/v{old + 1}"
        order = [self.by, *[c for c in self.row_id if c != self.by]]
        placed = rows.repartitionByRange(zones, *order) if zones > 1 else rows.coalesce(1)
        placed = placed.withColumn("zone", F.spark_partition_id()).sortWithinPartitions("zone", *order)
        drop_paths(self.spark, f"{target}/touched*")
        placed.write.mode("overwrite").partitionBy("zone").parquet(f"{target}/rows")
        by = F.col(self.by)
        bounds = self._rows(old + 1).groupBy("zone").agg(
            F.min(by).alias("low"), F.max(by).alias("high"), F.count_if(by.isNull()).alias("nulls"))
        bounds.coalesce(1).write.mode("overwrite").parquet(f"{target}/zones")
        if old > 1:
            drop_paths(self.spark, f"{self.root}/v{old - 1}")
        return old + 1

    def _rows(self, generation: int) -> DataFrame:
        schema = StructType([*self.served().schema.fields]).add("zone", IntegerType())
        return self.spark.read.schema(schema).parquet(f"{self.root}/v{generation}/rows")

    def zones(self) -> list[Zone]:
        """The zones of the copy in ascending order."""
        generation = self.generation()
        if not generation:
            return []
        found = self.spark.read.parquet(f"{self.root}/v{generation}/zones").select(*Zone._fields).collect()
        return sorted((Zone(*r) for r in found), key=lambda z: z.zone)

    def rows(self, zones: Sequence[Zone] | None = None, within: Column | None = None) -> DataFrame:
        """All rows ``within`` a condition; of the copy only those of ``zones``, which must hold all it lets through."""
        generation = self.generation()
        within = F.lit(True) if within is None else within
        if not generation:
            return self.served().filter(within)
        copy = self._rows(generation)
        if zones is not None:
            numbers = [z.zone for z in zones]
            copy = copy.filter(F.col("zone").between(min(numbers), max(numbers)) if numbers else F.lit(False))
        days = self._touched(generation).read().distinct()
        kept = join_keys(copy.drop("zone").filter(within), days, DAYS.names, "left_anti")
        return kept.unionByName(self.of_days(days).filter(within))

    def reach(
        self, size: int, sort_dir: str = "desc", cursor: tuple | None = None,
        where: Callable[[DataFrame], DataFrame] = lambda df: df,
    ) -> DataFrame:
        """Rows that hold the first ``size`` ones after ``cursor`` among those that ``where`` keeps.

        One, two, four and so on of the zones that the cursor leaves are looked into until they hold enough.
        """
        by, up = F.col(self.by), sort_dir.lower() == "asc"
        ahead, since, value = self.zones(), F.lit(True), None if cursor is None else cursor[0]
        if cursor is not None and value is not None:
            # Nulls are the lowest values: behind an ascending cursor, ahead of a descending one.
            start = [z for z in ahead if z.high is not None and z.high >= value] if up else [
                z for z in ahead if z.nulls or z.low is None or z.low <= value]
            # NaN is the largest value here, but compares as false above.
            ahead = ahead if value != value else [z for z in ahead if z in start or z.high != z.high]
            since = (by >= F.lit(value)) if up else (by <= F.lit(value)) | by.isNull()
        elif cursor is not None and not up:
            ahead, since = [z for z in ahead if z.nulls], by.isNull()
        rest = since if cursor is None else since & after(cursor, self.by, sort_dir, self.row_id)
        order = ahead if up else ahead[::-1]
        wide = 1
        while wide < len(order):
            last = order[wide - 1]
            if up:
                inside = by.isNull() if last.high is None else (by <= F.lit(last.high)) | by.isNull()
                zones = [z for z in order if last.high is not None and (z.low is None or not z.low > last.high)
                         or last.high is None and z.nulls]
            elif last.nulls:
                break
            else:
                inside = by >= F.lit(last.low)
                zones = [z for z in order if z.high is not None and not z.high < last.low]
            part = where(self.rows(zones, inside & since))
            if part.filter(rest).limit(size).count() >= size:
                return part
            wide *= 2
        return where(self.rows(order if self.generation() else None, since))

    def page_frame(
        self, limit: int, sort_dir: str = "desc", cursor: tuple | None = None,
        where: Callable[[DataFrame], DataFrame] = lambda df: df,
    ) -> DataFrame:
        """As :func:`serve.page_frame` over the tables, filtered by ``where`` and sorted by the copy's column."""
        return page_frame(self.reach(limit, sort_dir, cursor, where), limit, self.by, sort_dir, cursor, self.row_id)

    def page(
        self, limit: Any = None, sort_dir: str = "desc", cursor: tuple | None = None,
        where: Callable[[DataFrame], DataFrame] = lambda df: df,
    ) -> Page:
        """As :func:`serve.page_data` over the tables, filtered by ``where`` and sorted by the copy's column."""
        near = self.reach(limit_clamp(limit) + 1, sort_dir, cursor, where)
        return page_data(near, limit, self.by, sort_dir, cursor, self.row_id)
