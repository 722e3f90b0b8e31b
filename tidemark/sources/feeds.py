"""Feed readers. Values arrive as text or as the source's own JSON; cleaning happens in the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window, functions as F, types as T

# Where each JSON feed keeps the unified fields. Leaves are read as text, so that numbers and
# dressed-up number strings take the same cleaning path.
_USD = T.StructType([
    T.StructField(n, T.StringType()) for n in ("price", "volume_24h", "market_cap", "percent_change_24h")
])
NESTED = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("quotes", T.StructType([T.StructField("USD", _USD)])),
    T.StructField("last_updated", T.StringType()),
])
FLAT = T.StructType([
    T.StructField(n, T.StringType())
    for n in ("symbol", "name", "current_price", "total_volume", "market_cap",
              "price_change_percentage_24h", "last_updated")
])
CORRUPT = "_corrupt_record"


def arrival(df: DataFrame) -> DataFrame:
    """Add ``arrival``, an orderable key that follows the order of rows in the files just read.

    Within one file block the running id only ever compares in file order, so the key orders rows the same
    way on every attempt even though its numbers may differ.
    """
    return df.withColumn("arrival", F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ))


# Headers are compared on the driver; a folder with more different ones than this is no feed.
MAX_HEADERS = 1000


def _csv(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    """Quotes inside a quoted value are doubled; ``multi_line`` lets such a value hold line breaks, at the price of
    one task per file."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)


def csv_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a folder by their header line; only the first block of each file is looked into."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value").filter("block = 0")
    # One line per block passes the rank filter, before anything is shuffled.
    first = F.row_number().over(Window.partitionBy("file").orderBy("row"))
    heads = lines.withColumn("rank", first).filter("rank <= 1")
    files = heads.groupBy("value").agg(F.sort_array(F.collect_list("file")).alias("files")).limit(MAX_HEADERS + 1).collect()
    if len(files) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different header lines below {path}")
    return {r["value"]: r["files"] for r in sorted(files, key=lambda r: r["files"])}


def csv_schema(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> T.StructType:
    """All-text schema from the header line alone, plus a column that catches unreadable lines."""
    header = _csv(spark, multi_line).csv(path).schema
    return T.StructType([*header.fields, T.StructField(CORRUPT, T.StringType())])


def read_csv_feed(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """CSV with a header; every value stays text, rows keep ``arrival`` order.

    Short rows get nulls and over-long rows lose the surplus; :func:`unreadable_rows` lists both.
    All files must have one header: one that differs is an error, never read by position. Folders with several
    headers are read by :func:`read_csv_feeds`.
    """
    schema = csv_schema(spark, path, multi_line)
    df = (
        _csv(spark, multi_line).schema(schema)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    return arrival(df)


def read_csv_feeds(spark: SparkSession, path: str, multi_line: bool = False) -> list[DataFrame]:
    """One feed for each different header in a folder; map the columns of each, then union them by name."""
    return [read_csv_feed(spark, files, multi_line) for files in csv_headers(spark, path).values()]


def unreadable_rows(feed: DataFrame) -> DataFrame:
    """Lines whose shape did not fit the header."""
    return feed.filter(F.col(CORRUPT).isNotNull())


def csv_payload(feed: DataFrame) -> DataFrame:
    """Attach the whole original row as JSON before any column is renamed."""
    data = [c for c in feed.columns if c not in (CORRUPT, "arrival", "seq")]
    return feed.withColumn("raw_data", F.to_json(F.struct(*data)))


def read_json_payloads(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """One row per record with its JSON text in ``raw_data``.

    ``lines`` is newline-delimited and splits across tasks; ``array`` is one response page per file.
    """
    if layout == "lines":
        return arrival(spark.read.text(path)).withColumnRenamed("value", "raw_data").filter(
            F.trim("raw_data") != "")
    if layout != "array":
        raise ValueError(f"layout must be 'lines' or 'array', not {layout!r}")
    pages = arrival(spark.read.option("wholetext", True).text(path))
    items = F.from_json("value", T.ArrayType(T.StringType()))
    return pages.select("arrival", F.posexplode(items).alias("pos", "raw_data")).select(
        F.struct("arrival.file", "arrival.block", F.col("pos").cast("long").alias("row")).alias("arrival"),
        "raw_data")


def parse_payload(df: DataFrame, schema: T.StructType, payload: Column | str = "raw_data") -> DataFrame:
    """Unpack the feed's fields once, keeping every other column and the payload itself."""
    return df.withColumn("_record", F.from_json(payload, schema)).select(*df.columns, "_record.*")


def read_nested_json_feed(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Records whose figures sit under ``quotes.USD``."""
    return parse_payload(read_json_payloads(spark, path, layout), NESTED)


def read_flat_json_feed(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Records whose figures sit at the top level."""
    return parse_payload(read_json_payloads(spark, path, layout), FLAT)
