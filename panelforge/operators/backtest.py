"""Scoring predictions: errors, sides, betting returns, calibration, by season, week and model."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.columns import bucket, c, conditional_rate, confidence, indicator, logistic, recommendation


def directional(p: Column | str, a: Column | str, ties: bool = True) -> Column:
    """Same sign; with `ties` 0 against 0 is right, without it no tie is."""
    return F.signum(c(p)) == F.signum(c(a)) if ties else c(p) * c(a) > 0


def regression_metrics(df: DataFrame, p: str = "prediction", a: str = "actual", by: Sequence[str] = (), within: float = 3.0) -> DataFrame:
    """mae, rmse, r2, residual mean and (population) deviation, direction, share within, and n; one pass."""
    e = F.col(a) - F.col(p)
    out = df.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("mean_residual"), F.stddev_pop(e).alias("std_residual"),
        conditional_rate(directional(p, a)).alias("direction"), conditional_rate(F.abs(e) < within).alias("within"), F.count("*").alias("n"), F.sum(e * e).alias("_sse"), (F.var_pop(a) * F.count("*")).alias("_sst"),
    )
    return out.withColumn("r2", 1 - F.col("_sse") / F.nullif(F.col("_sst"), F.lit(0.0))).drop("_sse", "_sst")


def by_confidence(df: DataFrame, p: str = "prediction", a: str = "actual", cut: float = 7.0) -> DataFrame:
    """Metrics of bold and of cautious predictions; a side without rows has n = 0."""
    sides = df.sparkSession.createDataFrame([("high",), ("low",)], "side string")
    found = regression_metrics(df.withColumn("side", F.when(F.abs(p) >= cut, "high").otherwise("low")), p, a, ["side"])
    return sides.join(found, "side", "left").fillna(0, ["n"])


def cv_metrics(df: DataFrame, season: str, p: str = "prediction", a: str = "actual", line: str | None = None) -> DataFrame:
    """Per season and over all (a null season), in one roll-up; ats is over rows with a line, if one is named."""
    e = F.col(p) - F.col(a)
    more = [conditional_rate((F.col(p) > F.col(line)) == (F.col(a) > F.col(line)), F.col(line).isNotNull()).alias("ats")] if line else []
    return df.rollup(season).agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), conditional_rate(directional(p, a)).alias("direction"), F.count("*").alias("n"), *more)


def _bets(df: DataFrame, p: str, line: str, edge: float) -> DataFrame:
    return df.filter(F.col(line).isNotNull() & (F.abs(F.col(p) - F.col(line)) >= edge))


def ats_accuracy(df: DataFrame, p: str = "prediction", a: str = "actual", line: str = "line", edge: float = 0.0) -> DataFrame:
    """Share of bets on the right side of the line; a push counts as the away side, no bets as one half."""
    right = (F.col(p) > F.col(line)) == (F.col(a) > F.col(line))
    return _bets(df, p, line, edge).agg(F.coalesce(conditional_rate(right), F.lit(0.5)).alias("ats"), F.count("*").alias("bets"))


def ats_by_product(df: DataFrame, p: str = "prediction", a: str = "actual", line: str = "line") -> DataFrame:
    """The same by the sign of the product, so that ties are losses."""
    return df.filter(F.col(line).isNotNull()).agg(conditional_rate((F.col(p) - F.col(line)) * (F.col(a) - F.col(line)) > 0).alias("ats"), F.count("*").alias("bets"))


def roi(df: DataFrame, p: str = "prediction", a: str = "actual", line: str = "line", edge: float = 3.0, odds: int = -110, by: Sequence[str] = ()) -> DataFrame:
    """Wins, losses, pushes, profit per unit stake at American odds, win rate and return."""
    gain = 100 / -odds if odds < 0 else odds / 100
    push = F.col(a) == F.col(line)
    won = ~push & ((F.col(p) > F.col(line)) == (F.col(a) > F.col(line)))
    out = _bets(df, p, line, edge).groupBy(*by).agg(F.count("*").alias("bets"), F.count_if(won).alias("wins"), F.count_if(push).alias("pushes"))
    out = out.withColumn("losses", F.col("bets") - F.col("wins") - F.col("pushes")).withColumn("profit", F.col("wins") * gain - F.col("losses"))
    none = F.lit(0.0)
    return out.withColumns({"win_rate": F.coalesce(F.col("wins") / F.nullif(F.col("wins") + F.col("losses"), F.lit(0)), none), "roi": F.coalesce(F.col("profit") / F.nullif(F.col("bets"), F.lit(0)), none)})


def brier(df: DataFrame, p: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier"), F.count("*").alias("n"))


def model_comparison(df: DataFrame, models: Sequence[str], a: str = "actual", line: str = "line", edge: float = 3.0) -> DataFrame:
    """A row per model from one wide table: errors, ats, Brier score, bets and return at `edge`, best by mae and by ats."""
    long = df.unpivot([a, line], list(models), "model", "prediction")
    e, known = F.col("prediction") - F.col(a), F.col(line).isNotNull()
    right = (F.col("prediction") > F.col(line)) == (F.col(a) > F.col(line))
    bet, push = known & (F.abs(F.col("prediction") - F.col(line)) >= edge), F.col(a) == F.col(line)
    out = long.groupBy("model").agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), conditional_rate(right, known).alias("ats"), F.count("*").alias("n"),
        F.avg(F.pow(logistic("prediction") - indicator(F.col(a) > 0), 2)).alias("brier"), F.count_if(bet).alias("bets"), F.count_if(bet & ~push & right).alias("wins"), F.count_if(bet & ~push & ~right).alias("losses"),
    )
    out = out.withColumn("roi", F.coalesce((F.col("wins") * (100 / 110) - F.col("losses")) / F.nullif(F.col("bets"), F.lit(0)), F.lit(0.0)))
    w = Window.partitionBy(F.lit(0))  # a row per model
    return out.withColumns({"best": indicator(F.col("mae") == F.min("mae").over(w)), "best_by_ats": indicator(F.col("ats") == F.max("ats").over(w))})


def market_comparison(df: DataFrame, p: str = "prediction", a: str = "actual", line: str = "line") -> DataFrame:
    return df.filter(F.col(line).isNotNull()).agg(F.avg(F.abs(F.col(p) - F.col(a))).alias("model_mae"), F.avg(F.abs(F.col(line) - F.col(a))).alias("market_mae"), F.count("*").alias("n"))


def season_report(df: DataFrame, season: str = "season", p: str = "prediction", a: str = "actual", stake: float = 100.0, pay: float = 90.91) -> DataFrame:
    """Accuracy overall and by confidence, calibration, bets at even odds less the vig, and a verdict."""
    error, right = F.abs(F.col(p) - F.col(a)), directional(p, a, ties=False)
    bold = F.abs(F.col(p)) >= 7
    out = df.groupBy(season).agg(
        F.count("*").alias("games"), F.avg(error).alias("mae"), conditional_rate(right).alias("accuracy"), conditional_rate(right, bold).alias("bold_accuracy"), conditional_rate(right, ~bold).alias("cautious_accuracy"),
        conditional_rate(right, F.abs(F.col(a)) <= 7).alias("close_accuracy"), F.count_if(bold).alias("bold_bets"), F.count_if(bold & right).alias("bold_wins"),
    )
    out = out.withColumn("profit", F.col("bold_wins") * pay - (F.col("bold_bets") - F.col("bold_wins")) * stake)
    return out.withColumns({
        "calibration": F.when(F.col("bold_accuracy") > F.col("cautious_accuracy"), "Well Calibrated").otherwise("Needs Calibration"),
        "profitable": indicator(F.col("profit") > 0), "verdict": bucket("accuracy", ((0.55, "Strong"), (0.5238, "Marginal")), "Avoid", below=False),
    })


def formula_predictions(games: DataFrame) -> DataFrame:
    """Two spreads and three totals by fixed formulas over a matchup's features.

    Fixed values: the weights, and 42 points as the level of a total.
    """
    x = F.col
    base = 42 + 25 * x("value_l4_sum") - 15 * x("def_value_l4_sum")
    return games.withColumns({
        "plain_spread": 14 * x("value_l4_diff") + x("home_advantage"),
        "full_spread": 12 * x("value_l4_diff") + 8 * x("success_l4_diff") + 0.5 * x("matchup_gap") + x("home_advantage") + 0.3 * x("total_adjustment"),
        "base_total": base, "weather_total": base + x("total_adjustment"),
        "full_total": 42 + 20 * x("value_l4_sum") - 12 * x("def_value_l4_sum") + 15 * x("explosive_l4_sum") + 8 * x("near_td_l4_sum") + x("total_adjustment") - F.when(x("same_group") == 1, 2.5).otherwise(0.0),
    })


SPREADS, TOTALS, LEVEL = ("plain_spread", "full_spread"), ("base_total", "weather_total", "full_total"), 47


def graded(games: DataFrame) -> DataFrame:
    """Errors, sides (of 0 for spreads, of LEVEL for totals; a tie is wrong) and confidence of each formula."""
    spread, total = F.col("home_score") - F.col("away_score"), F.col("home_score") + F.col("away_score")
    right = lambda p, a, level: indicator((F.col(p) - level) * (a - level) > 0)
    return games.withColumns(
        {f"{p}_error": F.abs(F.col(p) - spread) for p in SPREADS} | {f"{p}_error": F.abs(F.col(p) - total) for p in TOTALS}
        | {f"{p}_right": right(p, spread, 0) for p in SPREADS} | {f"{p}_right": right(p, total, LEVEL) for p in TOTALS}
        | {"spread_confidence": bucket(F.abs("plain_spread"), ((7, "High"), (3, "Medium")), "Low", below=False), "total_confidence": bucket(F.abs(F.col("full_total") - LEVEL), ((6, "High"), (3, "Medium")), "Low", below=False)}
    )


def validation_report(rows: DataFrame, season: str = "season", stake: float = 100.0, pay: float = 90.91, even: float = 0.5238) -> DataFrame:
    """One row a season of `graded` games: accuracy overall and by confidence, weather, group, closeness and feature strength; returns; verdicts.

    All of it is conditional aggregation over one grouping, so nothing is joined back.
    """
    s, t = F.col("full_spread_right").cast("double"), F.col("full_total_right").cast("double")
    when = lambda x, test: F.avg(F.when(test, x))
    level = lambda kind, name: F.col(f"{kind}_confidence") == name
    out = rows.groupBy(season).agg(
        F.count("*").alias("games"), *[F.avg(F.col(f"{p}_right").cast("double")).alias(f"{p}_accuracy") for p in (*SPREADS, "base_total", "full_total")], *[F.avg(f"{p}_error").alias(f"{p}_error") for p in (*SPREADS, "base_total", "full_total")],
        *[when(x, level(k, n)).alias(f"{n.lower()}_{k}_accuracy") for k, x in (("spread", s), ("total", t)) for n in ("High", "Medium", "Low")], *[F.count_if(level(k, n)).alias(f"{n.lower()}_{k}_games") for k in ("spread", "total") for n in ("High", "Medium")],
        when(t, F.col("wind") >= 15).alias("windy_total_accuracy"), when(t, F.col("temp") <= 32).alias("cold_total_accuracy"),
        when(s, F.col("same_group") == 1).alias("group_spread_accuracy"), when(t, F.col("same_group") == 1).alias("group_total_accuracy"), when(s, F.abs("value_l4_diff") < 0.1).alias("close_spread_accuracy"),
        when(s, F.abs("value_l4_diff") >= 0.15).alias("large_gap_accuracy"), when(s, F.abs("value_l4_diff") < 0.05).alias("small_gap_accuracy"), when(t, F.col("value_l4_sum") >= 0.2).alias("strong_offense_accuracy"), when(t, F.col("value_l4_sum") <= -0.1).alias("weak_offense_accuracy"),
        when(t, F.abs("total_adjustment") >= 2).alias("weather_accuracy"), when(t, F.col("total_adjustment") == 0).alias("fair_weather_accuracy"), when(s, F.col("matchup_gap") >= 2).alias("strong_matchup_accuracy"), when(s, F.abs("matchup_gap") < 0.5).alias("even_matchup_accuracy"),
        *[F.count_if(x == 1).alias(f"{k}_wins") for k, x in (("spread", s), ("total", t))],
    )
    profit = lambda k: F.col(f"{k}_wins") * pay - (F.col("games") - F.col(f"{k}_wins")) * stake
    calibrated = lambda k: F.when(F.col(f"high_{k}_accuracy") > F.col(f"low_{k}_accuracy"), "Well_Calibrated").otherwise("Poorly_Calibrated")
    status = lambda k: bucket(f"full_{k}_accuracy", ((even, "Profitable"), (0.5, "Break_Even")), "Losing", below=False, strict=True)
    advice = F.when((F.col("high_spread_accuracy") > 0.6) & (F.col("high_spread_games") >= 20), "Focus_High_Confidence_Spreads").when(F.col("full_spread_accuracy") > F.col("full_total_accuracy"), "Focus_Spreads").when(F.col("full_total_accuracy") > 0.53, "Focus_Totals").otherwise("Model_Needs_Improvement")
    return out.withColumns({f"{k}_{n}": f(k) for k in ("spread", "total") for n, f in (("profit", profit), ("calibration", calibrated), ("status", status))} | {"advice": advice})


def weekly_trend(df: DataFrame, season: str = "season", week: str = "week", p: str = "prediction", a: str = "actual") -> DataFrame:
    """Weekly accuracy and its mean over the last four weeks of the season."""
    one = df.groupBy(season, week).agg(F.count("*").alias("games"), F.avg(F.abs(F.col(p) - F.col(a))).alias("mae"), conditional_rate(directional(p, a, ties=False)).alias("accuracy"))
    w = Window.partitionBy(season).orderBy(week).rowsBetween(-3, 0)
    return one.withColumns({"mae_l4": F.avg("mae").over(w), "accuracy_l4": F.avg("accuracy").over(w)})


def feature_strength(df: DataFrame, gap: str, cut: float, season: str = "season", p: str = "prediction", a: str = "actual") -> DataFrame:
    right, big = directional(p, a, ties=False), F.abs(F.col(gap)) >= cut
    return df.groupBy(season).agg(conditional_rate(right, big).alias("big_gap_accuracy"), conditional_rate(right, ~big).alias("small_gap_accuracy"))


def distribution(df: DataFrame, p: str = "prediction") -> DataFrame:
    x = F.col(p)
    return df.agg(F.count("*").alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("least"), F.max(x).alias("largest"), F.count_if(x > 0).alias("home"), F.count_if(x < 0).alias("away"), F.count_if(F.abs(x) <= 1).alias("within_one"))


def residual_histogram(df: DataFrame, p: str = "prediction", a: str = "actual", bins: int = 30) -> DataFrame:
    """Counts of residuals in bins of equal width; the extremes are joined as one row."""
    r = df.select((F.col(a) - F.col(p)).alias("r")).filter("r is not null")
    ends = F.broadcast(r.agg(F.min("r").alias("lo"), F.max("r").alias("hi")).withColumn("_k", F.lit(1)))
    at = F.least(F.lit(bins - 1), F.floor((F.col("r") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * bins))
    return r.withColumn("_k", F.lit(1)).join(ends, "_k").groupBy(F.coalesce(at, F.lit(0)).cast("long").alias("bin")).agg(F.count("*").alias("n"), F.min("r").alias("least"))


def exact_quantiles(df: DataFrame, column: str, levels: Sequence[float], accuracy: int = 10000) -> DataFrame:
    """level, value: exact quantiles (between two values by straight line), with no buffer that grows with the data.

    A mergeable sketch gives an interval around each wanted rank, values outside of all intervals are only counted,
    and those inside, some 4 / accuracy of the rows a level, are ordered interval by interval. Where a sketch is
    further off than it says, the missing rank is looked for among the whole gap between two intervals.
    """
    spark = df.sparkSession
    r = df.select(F.col(column).cast("double").alias("r")).filter("r is not null and not isnan(r)").groupBy("r").agg(F.count("*").alias("k"))
    wide = 2.0 / accuracy
    around = sorted({min(max(p + d, 0.0), 1.0) for p in levels for d in (-wide, wide)})
    number = F.when(~F.isnan(F.col(column).cast("double")), F.col(column).cast("double"))
    cuts = df.agg(F.percentile_approx(number, list(around), accuracy).alias("c"), F.count(number).alias("n")).first()  # two numbers a level
    n, edges = cuts["n"], sorted(set(cuts["c"] or []))
    if not n:
        return spark.createDataFrame([], "level double, value double")
    at = F.array(*[F.lit(float(x)) for x in edges])
    place = F.size(F.filter(at, lambda x: x < F.col("r")))  # in (edges[i - 1], edges[i]]
    counted = r.withColumn("_at", place)
    totals = {x["_at"]: x["k"] for x in counted.groupBy("_at").agg(F.sum("k").alias("k")).collect()}  # an interval a row
    before, run = {}, 0
    for i in range(len(edges) + 1):
        before[i], run = run, run + totals.get(i, 0)
    wanted = {int(k) for p in levels for k in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}
    open_ = sorted({i for i in totals for k in wanted if before[i] <= k < before[i] + totals[i]})
    offsets = F.create_map(*[F.lit(x) for i in open_ for x in (i, before[i])])
    own = Window.partitionBy("_at").orderBy("r")
    ranked = counted.filter(F.col("_at").isin(open_)).withColumn("_end", F.sum("k").over(own) + offsets[F.col("_at")])
    ranks = F.array(*[F.lit(k) for k in sorted(wanted)])
    hit = ranked.select("r", F.explode(F.filter(ranks, lambda x: (x < F.col("_end")) & (x >= F.col("_end") - F.col("k")))).alias("rank")).collect()  # two rows a level
    value = {x["rank"]: x["r"] for x in hit}
    out = []
    for p in levels:
        x = p * (n - 1)
        lo, hi = value[math.floor(x)], value[math.ceil(x)]
        out.append((float(p), lo + (hi - lo) * (x - math.floor(x))))
    return spark.createDataFrame(out, "level double, value double")


def normal_quantiles(df: DataFrame, p: str = "prediction", a: str = "actual") -> DataFrame:
    """Pairs for a Q-Q view of residuals: percentiles 1 to 99, exact, and what a normal of the same mean and deviation has there."""
    r = df.select((F.col(a) - F.col(p)).alias("r")).filter("r is not null")
    found = exact_quantiles(r, "r", [k / 100 for k in range(1, 100)])
    normal = df.sparkSession.createDataFrame([(k / 100, k, NormalDist().inv_cdf(k / 100)) for k in range(1, 100)], "level double, percent long, z double")
    facts = r.agg(F.avg("r").alias("m"), F.stddev_pop("r").alias("s")).withColumn("_k", F.lit(1))
    out = found.join(F.broadcast(normal), "level").withColumn("_k", F.lit(1)).join(F.broadcast(facts), "_k")  # 99 rows, one row
    return out.select("percent", F.col("value").alias("residual"), (F.col("m") + F.col("z") * F.col("s")).alias("expected"))


def scored_with_fallback(games: DataFrame, models: Sequence[str], line: str = "line", least: float = 3.0) -> DataFrame:
    """The first model in order that has a prediction, its edge over the line, win probability, and what to do."""
    found = F.coalesce(*[F.when(F.col(m).isNotNull(), F.struct(F.lit(m).alias("model"), F.col(m).cast("double").alias("spread"))) for m in models])
    out = games.withColumn("_found", found).withColumns({"model": F.col("_found.model"), "predicted_spread": F.col("_found.spread")}).drop("_found")
    out = out.withColumn("edge", F.col("predicted_spread") - F.col(line))
    return out.withColumns({"home_win_probability": logistic("predicted_spread"), "recommendation": recommendation("edge", least), "confidence": confidence("edge")})


def strength_ranking(df: DataFrame, entity: str, value: str, top: int | None = None) -> DataFrame:
    """Entities by value; df has one row per entity, so the one sort is small."""
    out = df.select(entity, value, F.row_number().over(Window.orderBy(F.desc(value), entity)).cast("long").alias("rank"))
    return out.filter(F.col("rank") <= top) if top else out
