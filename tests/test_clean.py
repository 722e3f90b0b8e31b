import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clean


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def got(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_numbers(spark):
    cases = {
        None: 0.0, "": 0.0, "12": 12.0, "$1,234.50": 1234.5, " 1 2 ": 12.0, "12abc": 12.0, "1.2.3": 1.2,
        "1e3": 1000.0, "1e": 1.0, ".5": 0.5, "5.": 5.0, "-$3": -3.0, "+7": 7.0, "abc": 0.0, "--1": 0.0,
        " 1　": 1.0, "Infinity": float("inf"), "-Infinityx": float("-inf"), "true": 0.0, ".": 0.0,
    }
    assert got(column(spark, cases), clean.clean_number("v")) == list(cases.values())


def test_number_or_null(spark):
    cases = {None: None, "": None, "x": None, "$0": 0.0, "9 %": 9.0}
    assert got(column(spark, cases), clean.clean_number_or_null("v")) == list(cases.values())


def test_numbers_stay(spark):
    assert got(column(spark, [1.5, None, 0.0], "double"), clean.clean_number("v")) == [1.5, 0.0, 0.0]


def test_text(spark):
    cases = {None: None, "": None, "  ": "", " a b\t": "a b", " x﻿": "x"}
    assert got(column(spark, cases), clean.clean_text("v")) == list(cases.values())


def test_timestamps(spark):
    noon = dt.datetime(2025, 10, 13, 12)
    cases = {
        "2025-10-13T12:00:00Z": noon, "2025-10-13T12:00:00.000Z": noon, "2025-10-13T14:00:00+02:00": noon,
        "2025-10-13 12:00:00": noon, "2025-10-13": dt.datetime(2025, 10, 13),
        "Mon, 13 Oct 2025 12:00:00 GMT": noon, "13 Oct 2025 12:00:00 +0000": noon,
        "10/13/2025 12:00:00": noon, "10/13/2025": dt.datetime(2025, 10, 13),
        "1697198400": None, "soon": None, "": None, None: None,
    }
    df = column(spark, cases)
    assert got(df, clean.clean_timestamp("v")) == list(cases.values())
    now = dt.datetime(2030, 1, 1)
    filled = got(df, clean.clean_timestamp("v", F.lit("2030-01-01").cast("timestamp"), on_bad="now"))
    assert filled == [v or now for v in cases.values()]


def test_epoch(spark):
    day = dt.datetime(2023, 10, 13, 12)
    df = column(spark, ["1697198400"])
    assert got(df, clean.clean_timestamp("v", epoch_unit="s")) == [day]
    ms = column(spark, [1697198400000], "bigint")
    assert got(ms, clean.clean_timestamp("v", numeric=True)) == [day]
    seconds_as_ms = column(spark, [1697198400], "bigint")
    assert got(seconds_as_ms, clean.clean_timestamp("v", numeric=True))[0].year == 1970


def test_bad_options(spark):
    with pytest.raises(ValueError):
        clean.clean_timestamp(F.lit("x"), on_bad="guess")
    with pytest.raises(ValueError):
        clean.clean_timestamp(F.lit("x"), on_bad="now")
    with pytest.raises(ValueError):
        clean.clean_timestamp(F.lit("x"), epoch_unit="us")
