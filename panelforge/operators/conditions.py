"""What a condition (weather) does to entities: split roll-ups, differences, tiers, shrinkage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.columns import bucket, indicator


def condition_flags(games: DataFrame) -> DataFrame:
    wind, temp = F.col("wind"), F.col("temp")
    return games.withColumns({
        "adverse": indicator((wind >= 15) | (temp <= 32) | (temp >= 90)),
        "severity": F.when((wind >= 20) | (temp <= 20), "Severe").when((wind >= 15) | (temp <= 32) | (temp >= 90), "Moderate").otherwise("Normal"),
    })


def condition_rollup(events: DataFrame, games: DataFrame, game: str, keys: Sequence[str], value: str) -> DataFrame:
    """Metrics by entity, season, condition and severity; the games' side is one row a game."""
    rows = events.join(condition_flags(games).select(game, "adverse", "severity"), game).filter(F.col(value).isNotNull())
    return rows.groupBy(*keys, "adverse", "severity").agg(F.count_distinct(game).alias("games"), F.count("*").alias("plays"), F.avg(value).alias("value"), F.avg(F.col("is_success").cast("double")).alias("success"), F.sum("turnover").cast("long").alias("turnovers"))


def condition_impact(split: DataFrame, keys: Sequence[str], season: str, least_games: int = 2, weighted: bool = False) -> DataFrame:
    """Good against adverse conditions per entity and season, and what to expect with few games.

    An entity with rows of two severities takes the larger value (or, `weighted`, the mean by
    plays). Below `least_games` adverse games the season's average stands in for the entity's own.
    """
    def value(flag: int, x: str):
        on = F.col("adverse") == flag
        return (F.sum(F.when(on, F.col(x) * F.col("plays"))) / F.sum(F.when(on, F.col("plays")))) if weighted else F.max(F.when(on, F.col(x)))

    one = split.groupBy(*keys).agg(
        value(0, "value").alias("good_value"), value(1, "value").alias("adverse_value"), value(0, "success").alias("good_success"), value(1, "success").alias("adverse_success"),
        F.sum(F.when(F.col("adverse") == 0, F.col("games")).otherwise(0)).cast("long").alias("good_games"), F.sum(F.when(F.col("adverse") == 1, F.col("games")).otherwise(0)).cast("long").alias("adverse_games"),
    )
    enough = (F.col("good_games") >= least_games) & (F.col("adverse_games") >= least_games)
    one = one.withColumn("value_impact", F.when(enough, F.col("adverse_value") - F.col("good_value")))
    one = one.withColumn("resistance", bucket("value_impact", ((0.05, "Excellent"), (-0.05, "Good"), (-0.15, "Average")), "Poor", below=False))
    one = one.withColumn("resistance", F.when(F.col("value_impact").isNull(), "Insufficient Data").otherwise(F.col("resistance")))
    league = one.filter(F.col("value_impact").isNotNull()).groupBy(season).agg(F.avg("value_impact").alias("league_impact"), F.stddev_samp("value_impact").alias("league_deviation"))
    out = one.join(league, season, "left")
    return out.withColumns({"expected_impact": F.coalesce("value_impact", "league_impact", F.lit(0.0)), "confidence": bucket("adverse_games", ((4, "High"), (2, "Medium")), "Low", below=False)})
