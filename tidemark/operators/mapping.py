"""Mapping of feed columns onto the unified fields: aliases first, then the closest name by confidence."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.clean import clean_number_or_null, clean_text
from tidemark.functions.names import confidence_class, fold_header, target_scores
from tidemark.model import COLUMN_ALIASES, NUMERIC_FIELDS, UNIFIED_FIELDS


class Mapping(NamedTuple):
    """``column`` of the feed feeds unified ``target``."""

    column: str
    target: str
    confidence: float


def alias_columns(columns: list[str]) -> list[Mapping]:
    """Aliases present in a header, in the order of the alias table."""
    return [Mapping(alias, field, 1.0) for alias, field in COLUMN_ALIASES.items() if alias in columns]


def apply_aliases(df: DataFrame) -> DataFrame:
    """Rename known aliases. Of several aliases of one field the last in the alias table wins, present or null.

    A column that already has the unified name keeps it and its aliases are dropped, as in :func:`map_columns`.
    """
    aliases = alias_columns(df.columns)
    chosen = {m.target: m.column for m in aliases if m.target not in df.columns}
    others = [c for c in df.columns if c not in {m.column for m in aliases}]
    return df.select(*others, *[F.col(c).alias(field) for field, c in chosen.items()])


def _folded(headers: DataFrame) -> DataFrame:
    return headers.withColumns({"_folded": fold_header(F.col("column")), "_length": F.length("column")})


def score_columns(headers: DataFrame) -> DataFrame:
    """Score of every header column against every unified field."""
    scores = target_scores(F.col("_folded"), F.col("_length"), ranked=False)
    return _folded(headers).select(*headers.columns, F.inline(scores))


def best_match(headers: DataFrame) -> DataFrame:
    """Closest unified field per header column, found within the row; null when nothing is close at all."""
    scores = target_scores(F.col("_folded"), F.col("_length"), ranked=True)
    best = _folded(headers).select(*headers.columns, F.array_max(scores).alias("_best"))
    return best.select(
        *headers.columns,
        F.when(F.col("_best.score") > 0, F.col("_best.target")).alias("target"),
        F.col("_best.score").alias("score"),
    )


def classify_match(best: DataFrame) -> DataFrame:
    """Add ``action``: auto, quarantine or skip."""
    return best.withColumn("action", confidence_class(F.col("score")))


def unknown_columns(headers: DataFrame) -> DataFrame:
    """Header columns that are neither a unified field (up to case, space, underscore) nor an alias."""
    known = [f.lower().replace("_", "") for f in UNIFIED_FIELDS]
    return headers.filter(
        ~fold_header(F.col("column")).isin(*known) & ~F.col("column").isin(*COLUMN_ALIASES))


def match_header(df: DataFrame) -> list:
    """Classified matches of one feed's own header, in header order. Only the header reaches the driver."""
    columns = [c for c in df.columns if c not in COLUMN_ALIASES]
    if not columns:
        return []
    header = df.sparkSession.createDataFrame(list(enumerate(columns)), "pos int, column string")
    return classify_match(best_match(header)).orderBy("pos").collect()


def map_columns(df: DataFrame, keep: tuple[str, ...] = ("raw_data",)) -> tuple[DataFrame, list[Mapping]]:
    """Feed rows under unified names, cleaned, and the mappings applied.

    Aliases are applied first and closest names after them from left to right; the last writer of a field
    wins. Quarantined and skipped columns are not loaded.
    """
    skip = {*keep, "arrival", "seq", "_corrupt_record"}
    body = df.select(*[c for c in df.columns if c not in skip])
    applied = alias_columns(body.columns) + [
        Mapping(r["column"], r["target"], r["score"]) for r in match_header(body) if r["action"] == "auto"]
    writers = {m.target: m.column for m in applied}

    def value(field: str, column: str):
        c = F.col(f"`{column}`")
        if field in NUMERIC_FIELDS:
            return clean_number_or_null(c)
        if field == "timestamp":
            return F.nullif(c.cast("string"), F.lit(""))
        return clean_text(c.cast("string"))

    kept = [c for c in df.columns if c in keep or c in ("arrival", "seq")]
    return df.select(*kept, *[value(f, c).alias(f) for f, c in writers.items()]), applied
