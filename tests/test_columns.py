import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelforge.functions import columns as C


@pytest.mark.parametrize(("text", "want"), [("1.0", 1), ("2.5", 3), ("-3.5", -4), ("x", None), (None, None)])
def test_to_int_rounds_half_away_and_tolerates(spark, text, want):
    assert spark.createDataFrame([(text,)], "x string").select(C.to_int("x")).first()[0] == want


def test_flags_ratios_and_tokens(spark):
    df = spark.createDataFrame([("1.0", 4.0, 0.0, "NA"), ("0.0", 4.0, 2.0, "b"), (None, None, 2.0, None)], "f string, x double, y double, t string")
    rows = df.select(C.flag("f").alias("f"), C.ratio("x", "y").alias("r"), C.null_tokens("t").alias("t")).collect()
    assert [tuple(r) for r in rows] == [(1, None, None), (0, 2.0, "b"), (0, None, None)]


def test_surrogate_keys_tell_nulls_from_their_neighbours(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert len({r[0] for r in df.select(C.surrogate_key(["x", "y"])).collect()}) == 2


def test_lines_probabilities_and_labels(spark):
    df = spark.createDataFrame([(3.5,), (-3.5,), (0.0,), (None,)], "s double")
    got = df.select(F.round(C.implied_probability("s"), 4), C.favourite("s"), C.recommendation("s"), C.to_line("s", 0)).collect()
    assert [tuple(r) for r in got] == [(0.6155, "home", "BET HOME", 4.0), (0.3845, "away", "BET AWAY", -4.0), (0.5, "pick'em", "NO BET", 0.0), (None, None, "NO BET", None)]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(2.0,), (-1.0,), (None,)], "x double")
    assert [r[0] for r in df.select(C.clamp(F.col("x"), 0.0, 1.0)).collect()] == [1.0, 0.0, None]


@pytest.mark.parametrize(("day", "season", "week"), [("2024-09-03", 2024, 1), ("2024-09-10", 2024, 2), ("2025-01-15", 2024, 18), ("2025-03-01", 2025, 1)])
def test_season_and_week(spark, day, season, week):
    df = spark.createDataFrame([(dt.date.fromisoformat(day),)], "d date")
    assert tuple(df.select(C.season_of("d"), C.week_of("d")).first()) == (season, week)
