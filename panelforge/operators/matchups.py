"""Matchup rows: both sides' features from before the period, derived columns, baselines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.columns import bucket, clamp, indicator


def game_schedule(events: DataFrame, game: str, keys: Sequence[str], home: str, side: str, score: str) -> DataFrame:
    """One row a game: the largest score of either side."""
    at_home = F.col(side) == F.col(home)
    return events.groupBy(game, *keys).agg(F.max(F.when(at_home, F.col(score))).alias("home_score"), F.max(F.when(~at_home, F.col(score))).alias("away_score"))


def game_weather(events: DataFrame, game: str, columns: Sequence[str] = ("temp", "wind", "roof")) -> DataFrame:
    """One row a game, each value the largest that is known; a game with two readings doesn't fan out."""
    return events.groupBy(game).agg(*[F.max(x).alias(x) for x in columns])


def with_groups(games: DataFrame, groups: DataFrame, entity: str, group: str) -> DataFrame:
    """A flag for games within one group of entities; groups is a small table (entity, group)."""
    side = lambda p: groups.select(F.col(entity).alias(f"{p}_team"), F.col(group).alias(f"_{p}"))
    out = games.join(side("home"), "home_team", "left").join(side("away"), "away_team", "left")
    return out.withColumn("same_group", indicator(F.col("_home") == F.col("_away"))).drop("_home", "_away")


def lagged_sides(games: DataFrame, panel: DataFrame, entity: str, season: str, period: str, features: Sequence[str], lag: int = 1, asof: bool = False) -> DataFrame:
    """home_ and away_ copies of the entity's features of `lag` periods before.

    The panel's key is shifted, so both joins are plain equi-joins. A side without a row in exactly
    that period gets nulls; with `asof` it gets its latest row before the game's period.
    """
    if asof:
        # games travel through the window as structs, both sides at once, so they are made once and repeated ids don't fan out
        rows = games.select(F.monotonically_increasing_id().alias("_gid"), F.struct(*games.columns).alias("_game"))
        rows = rows.select("*", F.explode(F.array(F.lit("home"), F.lit("away"))).alias("_side"))
        team = F.when(F.col("_side") == "home", F.col("_game.home_team")).otherwise(F.col("_game.away_team"))
        asks = rows.select(team.alias("_team"), F.col(f"_game.{season}").alias("_season"), F.col(f"_game.{period}").alias("_period"), "_gid", "_game", "_side")
        me = panel.select(F.col(entity).alias("_team"), F.col(season).alias("_season"), F.col(period).alias("_period"), F.struct(*features).alias("_row"))
        w = Window.partitionBy("_team", "_season").orderBy("_period", F.col("_gid").isNotNull().desc()).rowsBetween(Window.unboundedPreceding, -1)
        known = me.unionByName(asks, allowMissingColumns=True).withColumn("_seen", F.last("_row", ignorenulls=True).over(w)).filter("_gid is not null")
        both = known.groupBy("_gid").agg(F.first("_game").alias("_game"), *[F.first(F.when(F.col("_side") == p, F.col("_seen")), ignorenulls=True).alias(f"_{p}") for p in ("home", "away")])
        return both.select(*[F.col(f"_game.{c}").alias(c) for c in games.columns], *[F.col(f"_{p}.{x}").alias(f"{p}_{x}") for p in ("home", "away") for x in features])
    out = games
    for p in ("home", "away"):
        side = panel.select(F.col(entity).alias(f"{p}_team"), F.col(season), (F.col(period) + lag).alias(period), *[F.col(x).alias(f"{p}_{x}") for x in features])
        out = out.join(side, [f"{p}_team", season, period], "left")
    return out


def latest_sides(games: DataFrame, panel: DataFrame, entity: str, season: str, period: str, features: Sequence[str]) -> DataFrame:
    """Both sides' latest features of the season, for games still to come."""
    latest = panel.groupBy(entity, season).agg(F.max_by(F.struct(*features), period).alias("_row"))
    out = games
    for p in ("home", "away"):
        out = out.join(latest.select(F.col(entity).alias(f"{p}_team"), season, *[F.col(f"_row.{x}").alias(f"{p}_{x}") for x in features]), [f"{p}_team", season], "left")
    return out


def differentials(games: DataFrame, columns: Sequence[str]) -> DataFrame:
    return games.withColumns({f"{x}_diff": F.col(f"home_{x}") - F.col(f"away_{x}") for x in columns} | {f"{x}_sum": F.col(f"home_{x}") + F.col(f"away_{x}") for x in columns})


def weather_adjustments(games: DataFrame, default_temp: float = 72.0) -> DataFrame:
    """Defaults for unknown weather, the totals' step function, the pass-heavy side's loss in wind, home advantage."""
    g = games.withColumns({"temp": F.coalesce("temp", F.lit(default_temp)), "wind": F.coalesce("wind", F.lit(0)), "roof": F.coalesce("roof", F.lit("outdoors"))})
    inside = F.col("roof").isin("dome", "closed")
    return g.withColumns({
        "total_adjustment": F.when(inside, 0.0).when((F.col("wind") >= 20) | (F.col("temp") <= 20), -4.0).when((F.col("wind") >= 15) | (F.col("temp") <= 32), -2.0).when(F.col("wind") >= 10, -1.0).otherwise(0.0),
        "wind_spread_adjustment": F.when(~inside & (F.col("wind") >= 15), F.col("pass_share_diff") * -0.5).otherwise(0.0),
        "home_advantage": F.when(inside, 2.0).when(F.col("temp") <= 32, 3.0).otherwise(2.5),
        "high_wind": indicator(F.col("wind") >= 15), "cold": indicator(F.col("temp") <= 32), "hot": indicator(F.col("temp") >= 85), "indoors": indicator(inside),
    })


def baselines(games: DataFrame) -> DataFrame:
    """Simple and enhanced spread, base and adjusted total, normalised features, confidence labels."""
    gap, success = F.col("value_l4_diff"), F.col("success_l4_diff")
    out = games.withColumns({
        "simple_spread": 14 * gap + F.col("home_advantage"),
        "enhanced_spread": 12 * gap + 8 * success + 0.5 * F.col("wind_spread_adjustment") + F.col("home_advantage"),
        "base_total": 45 + 10 * F.col("value_l4_sum"),
    })
    return out.withColumns({
        "adjusted_total": F.col("base_total") + F.col("total_adjustment"),
        "gap_norm": clamp((gap + 0.5) / 1.0, 0.0, 1.0), "spread_confidence": bucket(F.abs("enhanced_spread"), ((10.0, "High"), (4.0, "Medium")), "Low", below=False),
        "trend_gap": F.abs(F.col("home_trend") - F.col("away_trend")),
    })


def upcoming(games: DataFrame, score: str = "home_score", names: Mapping[str, str] = {}) -> DataFrame:
    """Games without a score, columns renamed, and the late-season flag."""
    return games.filter(F.col(score).isNull()).withColumnsRenamed(dict(names)).withColumn("is_playoff", indicator(F.col("week") >= 18))


def consistency(features: DataFrame, panel: DataFrame, entity: str, season: str, period: str, column: str, lag: int = 1, tolerance: float = 1e-9) -> DataFrame:
    """Per season: matchups, and those in which a side's feature isn't what the panel has `lag` periods before.

    Doubles are equal within `tolerance` of the larger (of 1 at least), as sums of the same rows in another order differ in
    their last digits.
    """
    out = features
    for p in ("home", "away"):
        side = panel.select(F.col(entity).alias(f"{p}_team"), F.col(season), (F.col(period) + lag).alias(period), F.col(column).alias(f"_{p}"))
        out = out.join(side, [f"{p}_team", season, period], "left")
    inexact = {dict(features.dtypes)[f"home_{column}"], dict(panel.dtypes)[column]} & {"double", "float"}

    def same(x: Column, y: Column) -> Column:
        if not inexact:
            return x.eqNullSafe(y)
        off = F.abs(x - y)
        near = (off <= tolerance * F.greatest(F.abs(x), F.abs(y), F.lit(1.0))) & (off < float("inf"))
        return x.eqNullSafe(y) | F.coalesce(near, F.lit(False))

    differs = ~same(F.col(f"home_{column}"), F.col("_home")) | ~same(F.col(f"away_{column}"), F.col("_away"))
    return out.groupBy(season).agg(F.count("*").alias("games"), F.count_if(differs).alias("mismatches"))


def complete_rows(games: DataFrame, features: Sequence[str], period: str, least: int = 2) -> DataFrame:
    ok = F.col(period) >= least
    for x in features:
        ok = ok & F.col(f"home_{x}").isNotNull() & F.col(f"away_{x}").isNotNull()
    return games.filter(ok)


def with_override(games: DataFrame, overrides: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Columns of a small table take the place of those of the games, where it has them."""
    o = overrides.select(key, *[F.col(x).alias(f"{x}_csv") for x in columns])
    return games.join(o, key, "left").withColumns({x: F.coalesce(f"{x}_csv", x) for x in columns}).drop(*[f"{x}_csv" for x in columns])


def derived_features(df: DataFrame, prefix: str = "fe_") -> DataFrame:
    """Training-time features, each only where its inputs exist."""
    specs: Mapping[str, tuple[tuple[str, ...], str]] = {
        "value_matchup": (("home_value_l4", "away_def_value_l4"), "home_value_l4 - away_def_value_l4"),
        "away_value_matchup": (("away_value_l4", "home_def_value_l4"), "away_value_l4 - home_def_value_l4"),
        "value_diff": (("home_value_l4", "away_value_l4"), "home_value_l4 - away_value_l4"),
        "success_diff": (("home_success_l4", "away_success_l4"), "home_success_l4 - away_success_l4"),
        "trend_diff": (("home_trend", "away_trend"), "home_trend - away_trend"),
        "wind_pass": (("wind", "home_pass_share", "away_pass_share"), "wind * (home_pass_share - away_pass_share)"),
        "group_value": (("same_group", "home_value_l4", "away_value_l4"), "same_group * (home_value_l4 - away_value_l4)"),
        "expected_margin": (("home_value_l4", "away_value_l4"), "25 * (home_value_l4 - away_value_l4)"),
        "temp_gap": (("temp",), "abs(temp - 72)"),
    }
    return df.withColumns({prefix + n: F.expr(e) for n, (needs, e) in specs.items() if set(needs) <= set(df.columns)})


def missing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return sorted(set(wanted) - set(df.columns))


def require(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    if lost := missing_columns(df, wanted):
        raise ValueError(f"columns are missing: {', '.join(lost)}")
    return df


def training_frame(games: DataFrame, features: Sequence[str], target: str, null_policy: str = "drop") -> DataFrame:
    """Target, derived features, and either only whole rows or zeros for what is unknown."""
    target_of = {"spread": F.col("home_score") - F.col("away_score"), "total": F.col("home_score") + F.col("away_score")}
    df = derived_features(games).withColumn("target", target_of[target].cast("double"))
    own = [*features, *[x for x in df.columns if x.startswith("fe_")]]
    df = df.select("game_id", "season", "week", "target", *[F.col(x).try_cast("double").alias(x) for x in own])
    return df.dropna(subset=["target", *own]) if null_policy == "drop" else df.dropna(subset=["target"]).fillna(0.0, own)
