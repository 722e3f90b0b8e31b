"""Schema drift between two header versions of many feeds at once.

A header table has one row per (feed, column) with its position and type. Feeds are independent, and
everything below shuffles on the feed or on (feed, column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.names import confidence_class, drift_name
from tidemark.model import REGISTRY
from tidemark.operators import wide
from tidemark.operators.skew import join_small


def js_type(sql_type: str) -> str:
    """Type name used in the registry: number, string, boolean or object."""
    if sql_type in ("tinyint", "smallint", "int", "bigint", "float", "double") or sql_type.startswith("decimal"):
        return "number"
    return {"string": "string", "boolean": "boolean"}.get(sql_type, "object")


def infer_feed_schema(df: DataFrame, feed: str) -> DataFrame:
    """Header table of a typed feed. An empty feed has no schema, so it can never register as a change."""
    rows = [(feed, f.name, js_type(f.dataType.simpleString()), i) for i, f in enumerate(df.schema.fields)]
    header = df.sparkSession.createDataFrame(rows, "feed string, column string, type string, pos long")
    return header.filter(F.lit(not df.isEmpty()))


def infer_payload_schema(df: DataFrame, feed: str = "source", payload: str = "raw_data", seq: str = "seq") -> DataFrame:
    """Header table from the first JSON record of every feed.

    The first row is found by its number alone, so no payload is sorted or shuffled except the chosen ones.
    """
    numbered = df.select(F.col(feed).alias("feed"), F.col(seq).alias("_seq"), F.col(payload).alias("_first"))
    firsts = numbered.groupBy("feed").agg(F.min("_seq").alias("_seq"))
    first = join_small(numbered, firsts, ["feed", "_seq"], "left_semi")
    each = first.select("feed", "_first", F.posexplode(F.json_object_keys("_first")).alias("pos", "column"))
    kind = F.schema_of_variant(F.expr("try_variant_get(try_parse_json(_first), '$', 'map<string,variant>')[column]"))
    return each.select(
        "feed", "column",
        F.when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean")
        .when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), "number").otherwise("object").alias("type"),
        F.col("pos").cast("long").alias("pos"),
    )


def compare_headers(old: DataFrame, new: DataFrame) -> DataFrame:
    """(feed, column) with its type and position in either version, null where absent, by one aggregation.

    Each value is an aggregate of its own, so whoever needs positions only gets a plain hash aggregation.
    """
    def side(df: DataFrame, mine: str, other: str) -> DataFrame:
        return df.select(
            "feed", "column", F.col("type").alias(f"{mine}_type"), F.col("pos").cast("long").alias(f"{mine}_pos"),
            F.lit(None).cast("string").alias(f"{other}_type"), F.lit(None).cast("long").alias(f"{other}_pos"))

    return (
        side(old, "old", "new").unionByName(side(new, "new", "old"))
        .groupBy("feed", "column")
        .agg(*[F.max(c).alias(c) for c in ("old_type", "old_pos", "new_type", "new_pos")])
    )


def schema_changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per feed known before and now: did a column appear, vanish or change its type?"""
    same = F.col("old_type").eqNullSafe(F.col("new_type")) & F.col("old_pos").isNotNull() & F.col("new_pos").isNotNull()
    return (
        compare_headers(old, new).groupBy("feed")
        .agg(
            F.bool_or(~same).alias("changed"),
            F.bool_or(F.col("old_pos").isNotNull()).alias("_was"),
            F.bool_or(F.col("new_pos").isNotNull()).alias("_is"),
        )
        .filter(F.col("_was") & F.col("_is"))
        .select("feed", "changed")
    )


def removed_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    return compare_headers(old, new).filter(F.col("new_pos").isNull()).select(
        "feed", "column", F.col("old_pos").alias("pos"))


def added_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    return compare_headers(old, new).filter(F.col("old_pos").isNull()).select(
        "feed", "column", F.col("new_pos").alias("pos"))


#: Feeds with more removed or added columns than this are matched through an index.
NARROW = 256
#: Pairs of names that one task compares, about: a few seconds of work. The names are few bytes, and by bytes AQE would put
#: them all into one task.
PAIRS = 1_000_000


def drift_mappings(old: DataFrame, new: DataFrame, narrow: int = NARROW) -> DataFrame:
    """Closest added column for every removed one: ``feed, from, to, confidence`` (3 decimals).

    Of equal scores the earlier added column wins; a score of 0 is no match. While every feed has few of them, a feed's
    removed and added names are two arrays of one row, and rows are spread over tasks by the number of pairs; beyond ``narrow``
    names go through :func:`wide.closest`, which gives the same without a row or task that holds all names of a feed.
    """
    name = drift_name(F.col("column"))
    headers = compare_headers(old, new)
    gone, come = F.col("new_pos").isNull(), F.col("old_pos").isNull()
    added_name = F.struct(F.col("new_pos").alias("pos"), name.alias("name"))
    sizes = headers.groupBy("feed").agg(F.count_if(gone).alias("gone"), F.count_if(come).alias("come")).agg(
        F.max(F.greatest("gone", "come")), F.max("come"), F.sum((F.col("gone") + 1) * (F.col("come") + 1))).first()
    if (sizes[0] or 0) > narrow:
        removed = headers.filter(gone).select("feed", name.alias("name"))
        added = headers.filter(come).select("feed", F.inline(F.array(added_name)))
        rows = wide.closest(removed, added, -(-max(sizes[1], 1) // narrow))
    else:
        lists = headers.groupBy("feed").agg(
            F.collect_list(F.when(gone, name)).alias("_removed"), F.collect_list(F.when(come, added_name)).alias("_added"))
        tasks = -(-(sizes[2] or 0) // PAIRS)
        if tasks > 1:
            lists = lists.repartition(tasks, "feed")
        found = F.transform("_removed", lambda r: F.struct(r["name"].alias("from"), wide.best_of(r, F.col("_added")).alias("best")))
        rows = lists.select("feed", F.inline(found))
    return rows.filter(F.col("best.score") > 0).select(
        "feed", "from", F.col("best.to").alias("to"), F.round("best.score", 3).alias("confidence"))


def classify_drift(mappings: DataFrame) -> DataFrame:
    """Add ``status``: applied, quarantined or skipped."""
    return mappings.withColumn(
        "status", confidence_class(F.col("confidence"), ("applied", "quarantined", "skipped")))


def quarantine_rows(classified: DataFrame, at: Column) -> DataFrame:
    """Quarantined mappings of one detection, stamped."""
    return classified.filter(F.col("status") == "quarantined").drop("status").withColumn("quarantined_at", at)


def quarantine_table(log: DataFrame) -> DataFrame:
    """Latest quarantined mapping per (feed, from) of an append-only log."""
    latest = F.max_by(F.struct("to", "confidence", "quarantined_at"), F.struct("quarantined_at", "to"))
    return log.groupBy("feed", "from").agg(latest.alias("_row")).select("feed", "from", "_row.*")


def current_headers(registry: DataFrame) -> DataFrame:
    """Newest registered header of every feed."""
    newest = registry.groupBy("feed").agg(F.max("version").alias("version"))
    return registry.join(newest, ["feed", "version"])


def register(registry: DataFrame, headers: DataFrame) -> DataFrame:
    """Rows to append to the registry: version 1 of new feeds, the next version of changed ones.

    Registered and arriving headers are aggregated together, so neither side is joined or read twice.
    """
    both = registry.select("feed", "version", "column", "type", "pos").unionByName(
        headers.select("feed", F.lit(None).cast("int").alias("version"), "column", "type", F.col("pos").cast("long").alias("pos")))
    each = both.groupBy("feed", "version").agg(F.collect_list(F.struct("column", "type", "pos")).alias("cells"))
    known = F.col("version").isNotNull()
    latest = each.groupBy("feed").agg(
        F.max("version").alias("_version"),
        F.max_by(F.when(known, F.col("cells")), "version").alias("_old"),
        F.first(F.when(~known, F.col("cells")), ignorenulls=True).alias("_new"))
    shape = lambda c: F.array_sort(F.array_distinct(F.transform(c, lambda x: F.struct(x["column"], x["type"]))))
    return (
        latest.filter(F.col("_new").isNotNull() & (F.col("_version").isNull() | (shape("_old") != shape("_new"))))
        .select("feed", (F.coalesce("_version", F.lit(0)) + 1).cast("int").alias("version"), F.inline("_new"))
    )


def schema_versions(registry: DataFrame) -> DataFrame:
    """Version per feed, and the largest of them as the version a run reports."""
    per_feed = registry.groupBy("feed").agg(F.max("version").alias("schema_version"))
    newest = per_feed.agg(F.max("schema_version").alias("schema_version"))
    return per_feed.unionByName(newest.select(F.lit("*").alias("feed"), "schema_version"))


def empty_registry(spark) -> DataFrame:
    return spark.createDataFrame([], REGISTRY)


def with_positions(headers: DataFrame, order: str) -> DataFrame:
    """Dense 0-based column positions per feed from any ordering column of a header table."""
    rank = F.row_number().over(Window.partitionBy("feed").orderBy(order)) - 1
    return headers.withColumn("pos", rank.cast("long"))
