"""Record rules, reject reasons, storage rules and duplicate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.model import KEY, SOURCES

# Fixed value: beyond this magnitude an integer is no longer exact in a double.
SAFE_NUMBER = 9007199254740991.0


def _text_rule(c: str, say) -> list[tuple[Column, Column]]:
    return [
        (F.col(c).isNull(), say(c, "is required")),
        (F.col(c) == "", say(c, "is not allowed to be empty")),
    ]


def _number_rule(c: str, say, required: bool, floor: str | None) -> list[tuple[Column, Column]]:
    v = F.col(c)
    rules = [(v.isNull(), say(c, "is required"))] if required else []
    rules += [
        (F.isnan(v), say(c, "must be a number")),
        (F.abs(v) == float("inf"), say(c, "cannot be infinity")),
        (F.abs(v) > SAFE_NUMBER, say(c, "must be a safe number")),
    ]
    if floor == "positive":
        rules.append((v <= 0, say(c, "must be a positive number")))
    elif floor == "zero":
        rules.append((v < 0, say(c, "must be greater than or equal to 0")))
    return rules


def reject_reason(sources: Sequence[str] = SOURCES, payload: bool = True) -> Column:
    """Message of the first rule a record breaks, in column order; null for a valid record."""
    def say(c: str, text: str) -> Column:
        return F.lit(f'"{c}" {text}')

    rules = [
        *_text_rule("symbol", say),
        *_text_rule("name", say),
        *_number_rule("price_usd", say, True, "positive"),
        *_number_rule("volume_24h", say, True, "zero"),
        *_number_rule("market_cap", say, False, "zero"),
        *_number_rule("percent_change_24h", say, False, None),
        (F.col("timestamp").isNull(), say("timestamp", "must be a valid date")),
        (F.col("source").isNull(), say("source", "is required")),
        (~F.col("source").isin(*sources), say("source", f"must be one of [{', '.join(sources)}]")),
    ]
    if payload:
        rules += [
            (F.col("raw_data").isNull(), say("raw_data", "is required")),
            (F.json_object_keys("raw_data").isNull(), say("raw_data", "must be of type object")),
        ]
    reason = F.when(*rules[0])
    for condition, message in rules[1:]:
        reason = reason.when(condition, message)
    return reason


def with_reason(df: DataFrame, sources: Sequence[str] = SOURCES, payload: bool = True) -> DataFrame:
    """Add ``error``.

    The rules read most columns several times. Were ``error`` a plain column, a filter on it would be pushed
    below the projections that clean those columns and repeat the cleaning for every rule. A filter on the
    output of ``inline`` stays above them, so each value is computed once.
    """
    return df.select("*", F.inline(F.array(F.struct(reject_reason(sources, payload).alias("error")))))


def validate(df: DataFrame, sources: Sequence[str] = SOURCES, payload: bool = True) -> DataFrame:
    """Records that pass every rule."""
    return with_reason(df, sources, payload).filter(F.col("error").isNull()).drop("error")


def validate_rejects(df: DataFrame, sources: Sequence[str] = SOURCES, payload: bool = True) -> DataFrame:
    """Records that fail, with the first failing rule in ``error``."""
    return with_reason(df, sources, payload).filter(F.col("error").isNotNull())


def storage_ok(sources: Sequence[str] = SOURCES, payload: bool = True) -> Column:
    """The stored table's own rules: lengths, ranges and the source list; never null."""
    ok = (
        F.length("symbol").between(1, 20)
        & F.length("name").between(1, 100)
        & (F.col("price_usd") >= 0)
        & (F.col("volume_24h") >= 0)
        & (F.col("market_cap").isNull() | (F.col("market_cap") >= 0))
        & F.col("timestamp").isNotNull()
        & F.col("source").isin(*sources)
    )
    if payload:
        ok = ok & F.json_object_keys("raw_data").isNotNull()
    return F.coalesce(ok, F.lit(False))


def storage_check(df: DataFrame, sources: Sequence[str] = SOURCES, payload: bool = True) -> DataFrame:
    """Every row with ``storage_ok``."""
    return df.withColumn("storage_ok", storage_ok(sources, payload))


def validation_counts(df: DataFrame, sources: Sequence[str] = SOURCES, payload: bool = True) -> DataFrame:
    """Valid, invalid and total records per source in one pass."""
    return (
        df.select("source", reject_reason(sources, payload).isNull().alias("_ok"))
        .groupBy("source")
        .agg(
            F.count_if("_ok").alias("valid"),
            F.count_if(~F.col("_ok")).alias("invalid"),
            F.count(F.lit(1)).alias("total"),
        )
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def duplicate_summary(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Total rows, distinct keys and surplus rows."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("unique_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
    )
