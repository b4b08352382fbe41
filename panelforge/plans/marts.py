"""Queries of the marts: staging, backtest report, training reads, audits, scoring."""

from __future__ import annotations

import uuid
from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import backtest, matchups, panels
from panelforge.plans.adapter import GAMES_SQL, defense, games, offense, plays, results
from panelforge.plans.queries import DEFENSE_SQL, OFFENSE_SQL, query
from panelforge.sources import clustered, tables
from panelforge.sources.scratch import scratch_path

OFF = ("value_l4", "success_l4", "explosive_l4", "near_td_l4")


def backtest_games(spark: SparkSession, d: str) -> DataFrame:
    """Finished games with both sides' features of the week before, the five formulas and their grades."""
    o = offense(spark, d).select("team", "season", "week", *OFF, "pass_share")
    f = defense(spark, d).select("team", "season", "week", F.col("value_l4").alias("def_value_l4"))
    panel = o.join(f, ["team", "season", "week"], "left")
    g = matchups.lagged_sides(results(spark, d), panel, "team", "season", "week", [*OFF, "pass_share", "def_value_l4"])
    g = matchups.differentials(g, [*OFF, "pass_share", "def_value_l4"])
    g = matchups.with_groups(matchups.weather_adjustments(g), tables.read_table(spark, d, "nation"), "n_name", "n_regionkey")
    gap = (F.col("home_value_l4") - F.col("away_def_value_l4")) - (F.col("away_value_l4") - F.col("home_def_value_l4"))
    known = g.withColumn("matchup_gap", gap).filter("home_value_l4 is not null and away_value_l4 is not null")
    return backtest.graded(backtest.formula_predictions(known))


GRADED = f"""{GAMES_SQL}, {OFFENSE_SQL}, {DEFENSE_SQL}, panel AS (SELECT o.team, o.season, o.week, o.value_l4, o.success_l4, o.explosive_l4, o.near_td_l4, d.value_l4 AS def_value_l4 FROM offense o LEFT JOIN defense d USING (team, season, week)),
b1 AS (SELECT r.*, r.actual AS spread, r.home_score + r.away_score AS total, h.value_l4 AS hv, a.value_l4 AS av, h.value_l4 - a.value_l4 AS gap, h.value_l4 + a.value_l4 AS both_value, h.success_l4 - a.success_l4 AS sgap, h.explosive_l4 + a.explosive_l4 AS ex, h.near_td_l4 + a.near_td_l4 AS rz, h.def_value_l4 + a.def_value_l4 AS dv,
  h.value_l4 - a.def_value_l4 - a.value_l4 + h.def_value_l4 AS mg, CASE WHEN n1.n_regionkey = n2.n_regionkey THEN 1 ELSE 0 END AS same_group, r.roof IN ('dome', 'closed') AS inside
  FROM results r JOIN panel h ON r.home_team = h.team AND r.season = h.season AND r.week = h.week + 1 JOIN panel a ON r.away_team = a.team AND r.season = a.season AND r.week = a.week + 1 JOIN nation n1 ON n1.n_name = r.home_team JOIN nation n2 ON n2.n_name = r.away_team WHERE h.value_l4 IS NOT NULL AND a.value_l4 IS NOT NULL),
b2 AS (SELECT *, CASE WHEN inside THEN 0.0 WHEN wind >= 20 OR temp <= 20 THEN -4.0 WHEN wind >= 15 OR temp <= 32 THEN -2.0 WHEN wind >= 10 THEN -1.0 ELSE 0.0 END AS adj, CASE WHEN inside THEN 2.0 WHEN temp <= 32 THEN 3.0 ELSE 2.5 END AS hfa FROM b1),
b3 AS (SELECT *, gap * 14 + hfa AS plain_spread, gap * 12 + sgap * 8 + mg * 0.5 + hfa + adj * 0.3 AS full_spread, 42 + both_value * 25 - dv * 15 AS base_total, 42 + both_value * 25 - dv * 15 + adj AS weather_total, 42 + both_value * 20 - dv * 12 + ex * 15 + rz * 8 + adj + CASE WHEN same_group = 1 THEN -2.5 ELSE 0 END AS full_total FROM b2),
b AS (SELECT *, abs(plain_spread - spread) AS plain_spread_error, abs(full_spread - spread) AS full_spread_error, abs(base_total - total) AS base_total_error, abs(weather_total - total) AS weather_total_error, abs(full_total - total) AS full_total_error,
  CASE WHEN (plain_spread > 0 AND spread > 0) OR (plain_spread < 0 AND spread < 0) THEN 1 ELSE 0 END AS plain_spread_right, CASE WHEN (full_spread > 0 AND spread > 0) OR (full_spread < 0 AND spread < 0) THEN 1 ELSE 0 END AS full_spread_right,
  CASE WHEN (base_total > 47 AND total > 47) OR (base_total < 47 AND total < 47) THEN 1 ELSE 0 END AS base_total_right, CASE WHEN (weather_total > 47 AND total > 47) OR (weather_total < 47 AND total < 47) THEN 1 ELSE 0 END AS weather_total_right, CASE WHEN (full_total > 47 AND total > 47) OR (full_total < 47 AND total < 47) THEN 1 ELSE 0 END AS full_total_right,
  CASE WHEN abs(plain_spread) >= 7 THEN 'High' WHEN abs(plain_spread) >= 3 THEN 'Medium' ELSE 'Low' END AS spread_confidence, CASE WHEN abs(full_total - 47) >= 6 THEN 'High' WHEN abs(full_total - 47) >= 3 THEN 'Medium' ELSE 'Low' END AS total_confidence FROM b3)"""

FORMULAS = (*backtest.SPREADS, *backtest.TOTALS)
GRADES = " ".join([*[f"{p}_right" for p in FORMULAS], "spread_confidence", "total_confidence"])


@query("p66_backtest_games", "SELECT * FROM b", " ".join([*FORMULAS, *[f"{p}_error" for p in FORMULAS]]), f"game_id season week {GRADES}", GRADED)
def _p66(spark, d):
    return backtest_games(spark, d).select("game_id", "season", "week", *FORMULAS, *[f"{p}_error" for p in FORMULAS], *GRADES.split())


def _validation_sql() -> str:
    s, t = "full_spread_right", "full_total_right"
    acc = {f"{p}_accuracy": f"avg({p}_right)" for p in (*backtest.SPREADS, "base_total", "full_total")} | {f"{p}_error": f"avg({p}_error)" for p in (*backtest.SPREADS, "base_total", "full_total")}
    acc |= {f"{n.lower()}_{k}_accuracy": f"avg({x}) FILTER ({k}_confidence = '{n}')" for k, x in (("spread", s), ("total", t)) for n in ("High", "Medium", "Low")}
    acc |= {f"{n.lower()}_{k}_games": f"count(*) FILTER ({k}_confidence = '{n}')" for k in ("spread", "total") for n in ("High", "Medium")}
    tests = {"windy_total": (t, "wind >= 15"), "cold_total": (t, "temp <= 32"), "group_spread": (s, "same_group = 1"), "group_total": (t, "same_group = 1"), "close_spread": (s, "abs(gap) < 0.1"), "large_gap": (s, "abs(gap) >= 0.15"), "small_gap": (s, "abs(gap) < 0.05"), "strong_offense": (t, "both_value >= 0.2"), "weak_offense": (t, "both_value <= -0.1"), "weather": (t, "abs(adj) >= 2"), "fair_weather": (t, "adj = 0"), "strong_matchup": (s, "mg >= 2"), "even_matchup": (s, "abs(mg) < 0.5")}
    acc |= {f"{n}_accuracy": f"avg({x}) FILTER ({test})" for n, (x, test) in tests.items()} | {"spread_wins": f"count(*) FILTER ({s} = 1)", "total_wins": f"count(*) FILTER ({t} = 1)"}
    one = f"SELECT season, count(*) AS games, {', '.join(f'{e} AS {n}' for n, e in acc.items())} FROM b GROUP BY season"
    more = ", ".join(f"{k}_wins * 90.91 - (games - {k}_wins) * 100 AS {k}_profit, CASE WHEN high_{k}_accuracy > low_{k}_accuracy THEN 'Well_Calibrated' ELSE 'Poorly_Calibrated' END AS {k}_calibration, CASE WHEN full_{k}_accuracy > 0.5238 THEN 'Profitable' WHEN full_{k}_accuracy > 0.5 THEN 'Break_Even' ELSE 'Losing' END AS {k}_status" for k in ("spread", "total"))
    advice = "CASE WHEN high_spread_accuracy > 0.6 AND high_spread_games >= 20 THEN 'Focus_High_Confidence_Spreads' WHEN full_spread_accuracy > full_total_accuracy THEN 'Focus_Spreads' WHEN full_total_accuracy > 0.53 THEN 'Focus_Totals' ELSE 'Model_Needs_Improvement' END AS advice"
    return f"SELECT *, {more}, {advice} FROM ({one})"


WHOLE = "season games high_spread_games medium_spread_games high_total_games medium_total_games spread_wins total_wins spread_calibration total_calibration spread_status total_status advice"
RATES = [f"{n}_accuracy" for n in (*backtest.SPREADS, "base_total", "full_total", "high_spread", "medium_spread", "low_spread", "high_total", "medium_total", "low_total", "windy_total", "cold_total", "group_spread", "group_total", "close_spread", "large_gap", "small_gap", "strong_offense", "weak_offense", "weather", "fair_weather", "strong_matchup", "even_matchup")]
RATES += [*[f"{p}_error" for p in (*backtest.SPREADS, "base_total", "full_total")], "spread_profit", "total_profit"]


@query("a17_validation_report", _validation_sql(), " ".join(RATES), WHOLE, GRADED)
def _a17(spark, d):
    return backtest.validation_report(backtest_games(spark, d)).select(*WHOLE.split(), *RATES)


@query("p2_staging_projection", "SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) AS whole_price, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done, CAST(o_orderdate AS DATE) AS day, o_orderstatus FROM orders", "", "o_orderkey whole_price done day o_orderstatus")
def _p2(spark, d):
    o = tables.read_table(spark, d, "orders")
    raw = tables.as_text(o.select("O_ORDERKEY", F.col("o_totalprice").alias("WHOLE_PRICE"), F.when(F.col("o_orderstatus") == "F", "1.0").otherwise("0.0").alias("DONE"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("DAY"), "o_orderstatus"))
    out = tables.projected(raw, {"o_orderkey": "double", "whole_price": "int", "done": "flag", "day": "date"})
    return out.withColumn("o_orderkey", F.col("o_orderkey").cast("long"))


@query("f_json_paths", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total, count(*) FILTER (json_extract(props, '$.none') IS NULL) AS without FROM events GROUP BY event_type", "", "event_type n total without")
def _json(spark, d):
    e = tables.json_fields(tables.read_table(spark, d, "events"), "props", {"k": ("$.k", "bigint"), "none": ("$.none", "string")})
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("total"), F.count_if(F.col("none").isNull()).alias("without"))


@query("s20_training_read", "SELECT * FROM games WHERE season >= 1994 AND home_score IS NOT NULL AND away_score IS NOT NULL", "prediction", "game_id season week home_team away_team home_score away_score", GAMES_SQL)
def _s20(spark, d):
    return tables.training_read(games(spark, d), 1994, ["season", "week", "game_id"]).select("game_id", "season", "week", "home_team", "away_team", "home_score", "away_score", "prediction")


@query("a33_training_profile", "SELECT season, count(*) AS games, count(DISTINCT week) AS weeks, (SELECT count(DISTINCT t) FROM (SELECT home_team AS t FROM results x WHERE x.season = r.season UNION SELECT away_team FROM results x WHERE x.season = r.season)) AS teams, (SELECT min(season) FROM results) AS first_season, (SELECT max(season) FROM results) AS last_season FROM results r GROUP BY season", "", "season games weeks teams first_season last_season", GAMES_SQL)
def _a33(spark, d):
    return tables.training_profile(results(spark, d))


@query("q7_null_audit", " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS null_count FROM {t}" for t, cs in (("plays", ("epa", "yardline", "kind")), ("games", ("line", "prediction"))) for c in cs), "", "table_name column_name row_count null_count", GAMES_SQL)
def _q7(spark, d):
    return tables.null_audit({"plays": (plays(spark, d), ("epa", "yardline", "kind")), "games": (games(spark, d), ("line", "prediction"))})


@query("p64_upcoming", "SELECT game_id, season, week, upper(trim(home_team)) AS home_team, away_team, prediction AS predicted, CASE WHEN week >= 18 THEN 1 ELSE 0 END AS is_playoff, CAST(NULL AS VARCHAR) AS gametime FROM games WHERE line IS NULL", "predicted", "game_id season week home_team away_team is_playoff gametime", GAMES_SQL)
def _p64(spark, d):
    g = matchups.upcoming(games(spark, d), "line", {"prediction": "predicted"})
    return g.select("game_id", "season", "week", F.upper(F.trim("home_team")).alias("home_team"), "away_team", "predicted", "is_playoff", F.lit(None).cast("string").alias("gametime"))


@query("j12_consistency", "SELECT g.season, count(*) AS games, count(*) FILTER (g.week = 3 AND p.value_l4 IS NOT NULL) AS mismatches FROM games g LEFT JOIN offense p ON p.team = g.home_team AND p.season = g.season AND p.week = 2 GROUP BY g.season", "", "season games mismatches", f"{GAMES_SQL}, {OFFENSE_SQL}")
def _j12(spark, d):
    """A written mart against the panel: home values of week 3 are off by one in the mart."""
    o = offense(spark, d)
    g = matchups.lagged_sides(games(spark, d), o, "team", "season", "week", ["value_l4"])
    path = scratch_path(spark, "mart")
    g.withColumn("home_value_l4", F.when(F.col("week") == 3, F.col("home_value_l4") + 1).otherwise(F.col("home_value_l4"))).write.parquet(path)
    return matchups.consistency(spark.read.parquet(path), o, "team", "season", "week", "value_l4")


@query("j3_games_with_weather", "SELECT g.game_id, g.season, g.week, w.wind, w.temp, w.roof, g.line FROM games g LEFT JOIN (SELECT concat_ws('_', CAST(season AS VARCHAR), CAST(week AS VARCHAR), opp, team) AS game_id, max(wind) AS wind, max(temp) AS temp, max(roof) AS roof FROM plays GROUP BY 1) w USING (game_id)", "line", "game_id season week wind temp roof", GAMES_SQL)
def _j3(spark, d):
    named = plays(spark, d).withColumn("game_id", F.concat_ws("_", F.col("season").cast("string"), F.col("week").cast("string"), "opp", "team"))
    g = games(spark, d).select("game_id", "season", "week", "line")
    return g.select("game_id", "season", "week").join(matchups.game_weather(named, "game_id"), "game_id", "left").join(g.select("game_id", "line"), "game_id", "left")


EDGE = "CASE WHEN e >= 3 THEN 'BET HOME' WHEN e <= -3 THEN 'BET AWAY' ELSE 'NO BET' END AS recommendation, CASE WHEN abs(e) >= 5 THEN 'HIGH' WHEN abs(e) >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS confidence"


@query("m11_batch_scores", f"SELECT *, e AS edge, 1 / (1 + exp(-predicted_spread / 5.5)) AS home_win_probability, {EDGE} FROM (SELECT game_id, model, predicted_spread, predicted_spread - line AS e FROM (SELECT game_id, line, CASE WHEN abs(prediction) < 20 THEN 'ensemble' ELSE 'other_prediction' END AS model, CASE WHEN abs(prediction) < 20 THEN prediction ELSE other_prediction END AS predicted_spread FROM games))", "predicted_spread edge home_win_probability", "game_id model recommendation confidence", GAMES_SQL)
def _m11(spark, d):
    g = games(spark, d).withColumn("ensemble", F.when(F.abs("prediction") < 20, F.col("prediction")))
    return backtest.scored_with_fallback(g, ["ensemble", "other_prediction"]).select("game_id", "model", "predicted_spread", "edge", "home_win_probability", "recommendation", "confidence")


NORMAL = ", ".join(f"({k}, {NormalDist().inv_cdf(k / 100)!r})" for k in range(1, 100))


@query("m16_residual_quantiles", f"SELECT q.percent, q.residual, f.m + v.z * f.s AS expected FROM (SELECT unnest(range(1, 100)) AS percent, unnest(quantile_cont(actual - prediction, {[k / 100 for k in range(1, 100)]})) AS residual FROM results) q JOIN (VALUES {NORMAL}) v(p, z) ON p = q.percent, (SELECT avg(actual - prediction) AS m, stddev_pop(actual - prediction) AS s FROM results) f", "residual expected", "percent", GAMES_SQL)
def _m16q(spark, d):
    return backtest.normal_quantiles(results(spark, d))


@query("a24_cv_with_ats", "SELECT season, avg(abs(prediction - actual)) AS mae, sqrt(avg((prediction - actual) * (prediction - actual))) AS rmse, avg(CASE WHEN (prediction > line) = (actual > line) THEN 1.0 ELSE 0.0 END) FILTER (line IS NOT NULL) AS ats, count(*) AS n FROM results GROUP BY ROLLUP (season)", "mae rmse ats", "season n", GAMES_SQL)
def _a24(spark, d):
    return backtest.cv_metrics(results(spark, d), "season", line="line").drop("direction")


@query("p57_distinct_names", "SELECT DISTINCT upper(trim(home_team)) AS team FROM games WHERE season >= 1996", "", "team", GAMES_SQL)
def _p57(spark, d):
    return games(spark, d).filter("season >= 1996").select(F.upper(F.trim("home_team")).alias("team")).distinct()


@query("s8_reject_report", " UNION ALL ".join(f"SELECT '{c}' AS column_name, 'double' AS type, count(v) AS failures, min(v) AS sample FROM (SELECT CASE WHEN TRY_CAST({c} AS DOUBLE) IS NULL THEN {c} END AS v FROM orders)" for c in ("o_orderstatus", "o_orderpriority")), "", "column_name type failures sample")
def _s8(spark, d):
    return tables.reject_report(tables.as_text(tables.read_table(spark, d, "orders")), {"o_orderstatus": "double", "o_orderpriority": "double"})


@query("q6_volumes", "SELECT season, count(*) AS plays, count(DISTINCT game_id) AS games, count(DISTINCT week) AS weeks, avg(epa) AS value, CASE WHEN count(*) BETWEEN 4000 AND 50000 AND count(DISTINCT week) = 12 AND abs(avg(epa)) <= 0.3 THEN 1 ELSE 0 END AS expected FROM plays GROUP BY season", "value", "season plays games weeks expected")
def _q6(spark, d):
    one = plays(spark, d).groupBy("season").agg(F.count("*").alias("plays"), F.count_distinct("game_id").alias("games"), F.count_distinct("week").alias("weeks"), F.avg("epa").alias("value"))
    return one.withColumn("expected", F.when(F.col("plays").between(4000, 50000) & (F.col("weeks") == 12) & (F.abs("value") <= 0.3), 1).otherwise(0))


def clustered_panel(spark: SparkSession, d: str) -> DataFrame:
    """The offense panel in 8 buckets by team, sorted in time."""
    name = f"panel_{uuid.uuid4().hex}"
    clustered.write_clustered(offense(spark, d).select("team", "season", "week", "value_per_play", "plays"), name, ["team"], ["season", "week"], 8, scratch_path(spark, "panel"))
    return clustered.read_clustered(spark, name)


@query("l1_clustered_panel", "SELECT team, season, week, avg(value_per_play) OVER w AS value_l4, CAST(sum(plays) OVER w AS BIGINT) AS plays_l4 FROM offense WINDOW w AS (PARTITION BY team ORDER BY season, week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)", "value_l4", "team season week plays_l4", OFFENSE_SQL)
def _l1(spark, d):
    """Rolling columns over the clustered panel: the window shuffles nothing."""
    return panels.rolling(clustered_panel(spark, d), {"value_l4": "avg(value_per_play)", "plays_l4": "sum(plays)"}, "team", "season", "week").select("team", "season", "week", "value_l4", "plays_l4")


@query("l7_top_audit", " UNION ALL ".join(f"(SELECT '{c.removeprefix('round(').removesuffix(', 9)')}' AS column_name, '{side}' AS side, row_number() OVER (ORDER BY {c} {way}, team, season, week) AS place, {c} AS value, team, season, week FROM offense WHERE {c} IS NOT NULL QUALIFY place <= 10)" for c in ("plays_l4", "round(success_l4, 9)") for side, way in (("top", "DESC"), ("bottom", "ASC"))), "value", "column_name side place team season week", OFFENSE_SQL)
def _l7(spark, d):
    return clustered.top_audit(offense(spark, d).withColumn("success_l4", F.round("success_l4", 9)), ["plays_l4", "success_l4"], ["team", "season", "week"])
