"""Cleaning of dirty feed values, as Column expressions that stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters the feeds count as white space, and the shape of a leading number.
WHITESPACE = (
    "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)
NUMBER_NOISE = f"[,${WHITESPACE}]"
LEADING_NUMBER = r"^[+-]?(?:Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_number_or_null(c: Column | str) -> Column:
    """Leading number of a text once separators, currency sign and white space are gone, else null."""
    bare = F.regexp_replace(_col(c).cast("string"), NUMBER_NOISE, "")
    return F.nullif(F.regexp_extract(bare, LEADING_NUMBER, 0), F.lit("")).try_cast("double")


def clean_number(c: Column | str) -> Column:
    """As :func:`clean_number_or_null`, with 0 for everything missing or unreadable."""
    return F.coalesce(clean_number_or_null(c), F.lit(0.0))


def clean_text(c: Column | str) -> Column:
    """'' becomes null, anything else is trimmed (so a blank text becomes '', not null)."""
    return F.btrim(F.nullif(_col(c), F.lit("")), F.lit(WHITESPACE))


def text_or(c: Column, *fallbacks: Column) -> Column:
    """First non-empty text."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (c, *fallbacks)])


def _other_dates(c: Column) -> Column:
    """Mail-style and month-first dates, which the feeds also accept."""
    unnamed = F.regexp_replace(c, "^[A-Za-z]{3},\\s*", "")
    return F.coalesce(
        F.try_to_timestamp(unnamed, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(unnamed, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(c, F.lit("M/d/yyyy HH:mm:ss")),
        F.try_to_timestamp(c, F.lit("M/d/yyyy")),
    )


def clean_timestamp(
    c: Column | str,
    run_ts: Column | None = None,
    on_bad: str = "reject",
    numeric: bool = False,
    epoch_unit: str | None = None,
) -> Column:
    """ISO text to an instant; numbers are epoch milliseconds.

    ``on_bad="now"`` puts ``run_ts`` where the value is missing or unreadable; the default leaves null so
    that validation rejects the row instead of letting it move the high-water mark. ``epoch_unit`` ("s" or
    "ms") additionally reads digit-only text as an epoch, which is otherwise unreadable.
    """
    if on_bad not in ("reject", "now"):
        raise ValueError(f"on_bad must be 'reject' or 'now', not {on_bad!r}")
    if epoch_unit not in (None, "s", "ms"):
        raise ValueError(f"epoch_unit must be 's' or 'ms', not {epoch_unit!r}")
    c = _col(c)
    scale = 1000 if epoch_unit == "s" else 1
    if numeric:
        parsed = F.timestamp_millis((c * scale).cast("long"))
    else:
        text = F.btrim(c, F.lit(WHITESPACE))
        # A time without a date would be read as today's, another day on every run.
        dated = F.when(text.rlike("^[+-]?[0-9]{4}"), text)
        options = [dated.try_cast("timestamp"), _other_dates(text)]
        if epoch_unit:
            digits = F.when(text.rlike("^[0-9]{6,}$"), text.try_cast("long"))
            options.insert(0, F.timestamp_millis(digits * scale))
        parsed = F.coalesce(*options)
    if on_bad == "now":
        if run_ts is None:
            raise ValueError("on_bad='now' needs run_ts")
        parsed = F.coalesce(parsed, run_ts)
    return parsed
