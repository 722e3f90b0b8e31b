"""Similarity of column names. Candidates sit in one array per row, so no pair is ever a row of its own."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.clean import WHITESPACE
from tidemark.model import AUTO_MAP, COLUMN_ALIASES, QUARANTINE, UNIFIED_FIELDS


def fold_header(c: Column) -> Column:
    """Header form used when matching feed columns: lower case, no white space, no underscore."""
    return F.regexp_replace(F.lower(c), f"[{WHITESPACE}_]", "")


def fold_drift(c: Column) -> Column:
    """Header form used when comparing two schema versions: lower case, no underscore or dash."""
    return F.regexp_replace(F.lower(c), "[_-]", "")


def header_score(folded: Column, length: Column, target: str) -> Column:
    """Edit similarity of the folded names over the longer *unfolded* length."""
    longer = F.greatest(length, F.lit(max(len(target), 1)))
    return F.lit(1.0) - F.levenshtein(folded, fold_header(F.lit(target))) / longer


def target_scores(folded: Column, length: Column, *, ranked: bool) -> Column:
    """One struct per unified field: score and target, with a rank between them when the best is to be taken
    (of equal scores the earlier field ranks higher)."""
    def entry(i: int, t: str) -> Column:
        rank = [F.lit(-i).alias("rank")] if ranked else []
        return F.struct(header_score(folded, length, t).alias("score"), *rank, F.lit(t).alias("target"))

    return F.array(*[entry(i, t) for i, t in enumerate(UNIFIED_FIELDS)])


def drift_name(c: Column) -> Column:
    """What comparing one name against many needs to know about it, computed once."""
    known = F.lit(None).cast("string")
    for alias, field in COLUMN_ALIASES.items():
        known = F.when(c == alias, field).otherwise(known)
    return F.struct(c.alias("name"), fold_drift(c).alias("folded"), known.alias("alias"))


def drift_score(a: Column, b: Column) -> Column:
    """Similarity of two :func:`drift_name` values: 1.0 for an alias pair, 0.9 when one folded name holds the
    other, else edit similarity."""
    x, y = a["folded"], b["folded"]
    pair = F.coalesce(a["alias"] == b["name"], F.lit(False)) | F.coalesce(b["alias"] == a["name"], F.lit(False))
    return (
        F.when(pair, F.lit(1.0))
        .when(F.contains(x, y) | F.contains(y, x), F.lit(0.9))
        .otherwise(F.lit(1.0) - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y)))
    )


def confidence_class(score: Column, names: tuple[str, str, str] = ("auto", "quarantine", "skip")) -> Column:
    """Class by the two fixed limits; a missing score is the lowest class."""
    return (
        F.when(score >= AUTO_MAP, names[0])
        .when(score >= QUARANTINE, names[1])
        .otherwise(names[2])
    )
