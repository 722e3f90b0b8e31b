"""Tables in the shared folder, which cut lineage and outlive executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.session import new_scratch


#: Rows go to Python and back in batches of about this size, of which a worker and its executor hold several at once.
BATCH_BYTES, BATCH_ROWS = "8m", "2000"


def small_batches(spark: SparkSession) -> None:
    """Bound what Python workers and executors hold of long texts; a query sets it before it runs."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def keep(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back."""
    spark = df.sparkSession
    path = new_scratch(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(df: DataFrame) -> list[str]:
    """The names of all columns as they have to be selected; a name may hold a dot or a backtick."""
    return ["`" + c.replace("`", "``") + "`" for c in df.columns]


def map_rows(df: DataFrame, run: Callable, *more: T.StructField) -> DataFrame:
    """``df.mapInArrow(run)`` with the columns of ``df`` and ``more``, whatever they are called: ``run`` sees and returns
    them by position, since Spark looks the columns up by names that must not hold dots."""
    fields = [*df.schema.fields, *more]
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])
    plain = df.toDF(*schema.names[:len(df.columns)])
    return plain.mapInArrow(run, schema).toDF(*[f.name for f in fields])
