"""Queries over the given tables, one per operator that has a result of its own, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions import columns as C
from panelforge.operators import backtest, conditions, folds, learn, matchups, panels, quality, ratings, training
from panelforge.plans.adapter import DEFENSE, GAMES_SQL, OFFENSE, PLAYS_SQL, SPEC, defense, games, offense, plays, results
from panelforge.sources import tables
from panelforge.sources import discovery, registry
from panelforge.sources.scratch import Rounds, cleared, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def shown(df: DataFrame) -> DataFrame:
    """Doubles rounded, whole numbers as bigint: the same in any engine."""
    twice = lambda x: F.round(F.round(x, DIGITS + 3), DIGITS)  # noqa: E731  ties of a mean are ties in any engine
    out = {"double": lambda c: twice(F.col(c)), "float": lambda c: twice(F.col(c).cast("double")), "int": lambda c: F.col(c).cast("bigint"), "tinyint": lambda c: F.col(c).cast("bigint")}
    return df.select([out.get(t, F.col)(c).alias(c) for c, t in df.dtypes])


def query(name: str, sql: str | None = None, doubles: str = "", rest: str = "", ctes: str = ""):
    """Registers a query. SQL: the rows; `doubles` are rounded, `rest` stay, both lists of columns."""

    def keep(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, d: shown(f(spark, d))
        if sql:
            cols = [f"CAST(round(CAST(CAST({x} AS DOUBLE) AS DECIMAL(38, {DIGITS + 3})), {DIGITS}) AS DOUBLE) AS {x}" for x in doubles.split()] + rest.split()
            ORACLES[name] = f"WITH {PLAYS_SQL.strip()}, {ctes + ', ' if ctes else ''}answer AS ({sql}) SELECT {', '.join(cols)} FROM answer"
        return f

    return keep


def _agg(where: str, e: str) -> str:
    return f"avg(CASE WHEN {where} THEN {e} END)"


LIVE = "(is_pass = 1 OR is_rush = 1)"


def panel_sql(me: str) -> str:
    return f"""
SELECT {me} AS team, season, week, count(*) FILTER ({LIVE}) AS plays, sum(epa) FILTER ({LIVE}) AS total_value, {_agg(LIVE, 'epa')} AS value_per_play, {_agg(LIVE, 'is_success')} AS success_rate,
  {_agg(LIVE, 'is_explosive')} AS explosive_rate, count(*) FILTER (is_pass = 1) AS pass_plays, count(*) FILTER (is_rush = 1) AS rush_plays, {_agg('is_pass = 1', 'epa')} AS pass_value, {_agg('is_rush = 1', 'epa')} AS rush_value,
  {_agg(LIVE, 'CASE WHEN is_pass = 1 AND is_success = 1 THEN 1.0 ELSE 0.0 END')} AS pass_success_rate, {_agg(LIVE, 'CASE WHEN is_rush = 1 AND is_success = 1 THEN 1.0 ELSE 0.0 END')} AS rush_success_rate,
  count(*) FILTER ({LIVE} AND touchdown = 1) AS touchdowns, count(*) FILTER ({LIVE} AND turnover = 1) AS turnovers, {_agg(LIVE, 'turnover')} AS turnover_rate, sum(yards) FILTER ({LIVE}) AS total_gain, {_agg(LIVE, 'yards')} AS gain_per_play,
  {_agg(LIVE, 'CASE WHEN is_pass = 1 AND yards >= 15 THEN 1.0 ELSE 0.0 END')} AS explosive_pass_rate, {_agg(LIVE, 'CASE WHEN is_rush = 1 AND yards >= 10 THEN 1.0 ELSE 0.0 END')} AS explosive_rush_rate,
  {_agg('is_pass = 1', 'yards')} AS gain_per_pass, {_agg('is_rush = 1', 'yards')} AS gain_per_rush, count(*) FILTER ({LIVE} AND down = 3) AS third_downs, count(*) FILTER ({LIVE} AND third_conv = 1) AS third_conversions,
  {_agg(LIVE + ' AND down = 3', 'third_conv')} AS third_rate, count(*) FILTER (is_pass = 1 AND touchdown = 1) AS pass_touchdowns, count(*) FILTER (is_rush = 1 AND touchdown = 1) AS rush_touchdowns,
  count(*) FILTER ({LIVE} AND sack = 1) AS sacks, {_agg('is_pass = 1 OR (is_rush = 1 AND sack = 1)', 'sack')} AS sack_rate,
  count(*) FILTER ({LIVE} AND yardline <= 20) AS near_plays, {_agg(LIVE + ' AND yardline <= 20', 'touchdown')} AS near_td_rate, {_agg(LIVE + ' AND yardline <= 20', 'epa')} AS near_value,
  count(DISTINCT (game_id, drive)) AS drives, count(*) FILTER (is_pass = 1) / NULLIF(CAST(count(*) FILTER ({LIVE}) AS DOUBLE), 0) AS pass_share,
  sum(6 * touchdown + 3 * field_goal) / NULLIF(CAST(count(DISTINCT (game_id, drive)) AS DOUBLE), 0) AS approx_points_per_drive, sum(yards) / NULLIF(CAST(count(DISTINCT (game_id, drive)) AS DOUBLE), 0) AS gain_per_drive
FROM plays GROUP BY {me}, season, week HAVING count(*) FILTER ({LIVE}) > 0"""


PANEL_DOUBLES = "total_value value_per_play success_rate explosive_rate pass_value rush_value pass_success_rate rush_success_rate turnover_rate total_gain gain_per_play near_td_rate near_value explosive_pass_rate explosive_rush_rate gain_per_pass gain_per_rush third_rate sack_rate pass_share approx_points_per_drive gain_per_drive"
PANEL_COUNTS = "team season week plays pass_plays rush_plays touchdowns turnovers third_downs third_conversions pass_touchdowns rush_touchdowns sacks near_plays drives"
FRAME = "ORDER BY season, week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW"

def _rolled(columns: dict[str, str]) -> str:
    return ", ".join(f"CAST({e} OVER w AS BIGINT) AS {n}" if e.startswith("sum") else f"{e} OVER w AS {n}" for n, e in columns.items())


OFFENSE_SQL = f"offense_panel AS ({panel_sql('team')}), offense AS (SELECT *, {_rolled(OFFENSE)}, value_per_play - avg(value_per_play) OVER w AS trend FROM offense_panel WINDOW w AS (PARTITION BY team {FRAME}))"
DEFENSE_SQL = f"defense_panel AS ({panel_sql('opp')}), defense AS (SELECT *, {_rolled(DEFENSE)} FROM defense_panel WINDOW w AS (PARTITION BY team {FRAME}))"


@query("s3_text_round_trip", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS returned FROM lineitem", "l_quantity l_extendedprice", "l_orderkey l_linenumber returned")
def _s3(spark, d):
    raw = tables.as_text(tables.read_table(spark, d, "lineitem"))
    return raw.select(C.to_int("l_orderkey").cast("long").alias("l_orderkey"), C.to_int("l_linenumber").alias("l_linenumber"), C.to_double("l_quantity").alias("l_quantity"), C.to_double("l_extendedprice").alias("l_extendedprice"), C.flag(F.when(F.col("l_returnflag") == "A", "1.0").otherwise("0.0")).alias("returned"))


@query("s11_table_audit", "SELECT 'orders' AS table_name, count(*) AS row_count, count(*) FILTER (o_orderdate IS NULL) AS missing_year, min(year(o_orderdate)) AS min_year, max(year(o_orderdate)) AS max_year, count(DISTINCT year(o_orderdate)) AS distinct_years, strftime(max(o_orderdate), '%Y-%m-%d') AS last_load FROM orders UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (l_shipdate IS NULL), min(year(l_shipdate)), max(year(l_shipdate)), count(DISTINCT year(l_shipdate)), strftime(max(l_shipdate), '%Y-%m-%d') FROM lineitem", "", "table_name row_count missing_year min_year max_year distinct_years last_load")
def _s11(spark, d):
    one = lambda t, c: tables.table_audit(tables.read_table(spark, d, t).select(F.year(c).alias("y"), F.to_date(c).alias("at")), t, "y", "at")
    return one("orders", "o_orderdate").unionByName(one("lineitem", "l_shipdate"))


@query("s12_freshness", "SELECT 'events' AS table_name, count(*) AS row_count, strftime(max(ts), '%Y-%m-%d') AS last_load, count(DISTINCT year(ts)) AS seasons, max(year(ts)) AS latest_season, (SELECT max(month(ts)) FROM events WHERE year(ts) = (SELECT max(year(ts)) FROM events)) AS latest_week FROM events", "", "table_name row_count last_load seasons latest_season latest_week")
def _s12(spark, d):
    e = tables.read_table(spark, d, "events").select(F.to_date("ts").alias("at"), F.year("ts").alias("season"), F.month("ts").alias("week"))
    return tables.freshness(e, "events", "at", "season", "week")


def _profile_sql(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS type, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS null_count, min(CAST({c} AS VARCHAR)) AS least, max(CAST({c} AS VARCHAR)) AS largest FROM {table}" for c, t in columns.items())


@query("s18_profile", _profile_sql("nation", {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"}), "", "column_name type row_count null_count least largest")
def _s18(spark, d):
    n = tables.read_table(spark, d, "nation")
    return tables.profile(n.select([F.col(c).cast("int").alias(c) if t == "bigint" else F.col(c) for c, t in n.dtypes]))


@query("p20_classified", "SELECT game_id, drive, part, supp, is_success, is_explosive, CASE WHEN touchdown = 1 OR field_goal = 1 THEN 1 ELSE 0 END AS is_scoring, CASE WHEN yardline <= 10 THEN 'Goal Line' WHEN yardline <= 20 THEN 'Red Zone' WHEN yardline <= 50 THEN 'Opponent Territory' WHEN yardline <= 80 THEN 'Own Territory' ELSE 'Deep Own Territory' END AS field_zone, CASE WHEN down = 3 AND togo <= 3 THEN 'Third and Short' WHEN down = 3 AND togo BETWEEN 4 AND 7 THEN 'Third and Medium' WHEN down = 3 AND togo > 7 THEN 'Third and Long' WHEN down = 4 THEN 'Fourth Down' ELSE 'Early Down' END AS down_distance, CASE WHEN abs(margin) <= 7 THEN 'One Score' WHEN abs(margin) <= 14 THEN 'Two Score' ELSE 'Blowout' END AS score_situation, abs(start_yardline - yardline) AS progress FROM plays WHERE season >= 1997 AND kind IS NOT NULL AND kind NOT IN ('no_play', 'qb_kneel')", "", "game_id drive part supp is_success is_explosive is_scoring field_zone down_distance score_situation progress")
def _p20(spark, d):
    p = panels.cleaned(plays(spark, d), ["no_play", "qb_kneel"], "kind", "season", 1997)
    return p.select("game_id", "drive", "part", "supp", "is_success", "is_explosive", "is_scoring", "field_zone", "down_distance", "score_situation", "progress")


@query("p23_situations", "SELECT game_id, drive, part, supp, CASE WHEN yardline <= 20 THEN 'red_zone' WHEN yardline <= 50 THEN 'scoring_range' WHEN yardline <= 80 THEN 'midfield' ELSE 'own_territory' END AS zone_situation, CASE down WHEN 1 THEN 'first' WHEN 2 THEN 'second' WHEN 3 THEN 'third' WHEN 4 THEN 'fourth' ELSE 'other' END AS down_situation, CASE WHEN togo <= 2 THEN 'short' WHEN togo <= 7 THEN 'medium' WHEN togo <= 15 THEN 'long' ELSE 'very_long' END AS distance_situation, CASE WHEN abs(margin) <= 3 THEN 'close' WHEN abs(margin) <= 8 THEN 'one_score' WHEN abs(margin) <= 14 THEN 'two_score' ELSE 'blowout' END AS score_situation, CASE WHEN half_seconds <= 120 THEN 'two_minute' WHEN half_seconds <= 300 THEN 'late_half' ELSE 'normal' END AS clock_situation FROM plays", "", "game_id drive part supp zone_situation down_situation distance_situation score_situation clock_situation")
def _p23(spark, d):
    return panels.situation_labels(plays(spark, d)).select("game_id", "drive", "part", "supp", "zone_situation", "down_situation", "distance_situation", "score_situation", "clock_situation")


@query("p12_surrogate_key", "SELECT o_orderkey, md5(concat_ws('-', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), coalesce(nullif(o_orderstatus, 'P'), '_null_'))) AS pk FROM orders", "", "o_orderkey pk")
def _p12(spark, d):
    o = tables.read_table(spark, d, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return o.select("o_orderkey", C.surrogate_key(["o_orderkey", "o_custkey", "status"]).alias("pk"))


@query("p54_season_week", "SELECT event_id, CASE WHEN month(ts) < 3 THEN year(ts) - 1 ELSE year(ts) END AS season, month(ts) IN (9, 10, 11, 12, 1, 2) AS in_season FROM events", "", "event_id season in_season")
def _p54(spark, d):
    return tables.read_table(spark, d, "events").select("event_id", C.season_of(F.to_date("ts")).alias("season"), C.in_season("ts").alias("in_season"))


@query("w1_number_in_group", "SELECT game_id, drive, part, supp, price, row_number() OVER (PARTITION BY game_id ORDER BY drive, part, supp, price) AS number_in_group FROM plays", "price", "game_id drive part supp number_in_group")
def _w1(spark, d):
    return panels.numbered_in_group(plays(spark, d), ["game_id"], SPEC.order).select("game_id", "drive", "part", "supp", "price", "number_in_group")


@query("a1_offense_panel", panel_sql("team"), PANEL_DOUBLES, PANEL_COUNTS)
def _a1(spark, d):
    return panels.weekly_panel(plays(spark, d), SPEC)


@query("a4_defense_panel", panel_sql("opp"), PANEL_DOUBLES, PANEL_COUNTS)
def _a4(spark, d):
    return panels.weekly_panel(plays(spark, d), SPEC, by="opp")


ROLLED = " ".join(n for n, e in OFFENSE.items() if e.startswith("avg"))


@query("w4_rolling4", "SELECT * FROM offense", f"{ROLLED} trend", "team season week plays_l4 turnovers_l4", OFFENSE_SQL)
def _w4(spark, d):
    return offense(spark, d).select("team", "season", "week", *OFFENSE, "trend")


@query("w5_rolling_defense", "SELECT * FROM defense", f"{ROLLED} sack_l4", "team season week plays_l4 turnovers_l4", DEFENSE_SQL)
def _w5(spark, d):
    return defense(spark, d).select("team", "season", "week", *DEFENSE)


RANKS = {"value_rank": ("value_l4", True), "gain_rank": ("gain_l4", True), "points_rank": ("points_l4", True), "turnover_rank": ("turnover_l4", False)}


@query("w7_defense_ranks", "SELECT team, season, week, " + ", ".join(f"rank() OVER (PARTITION BY season, week ORDER BY round({x}, 9) {'ASC NULLS LAST' if up else 'DESC NULLS FIRST'}) AS {n}" for n, (x, up) in RANKS.items()) + " FROM defense", "", "team season week value_rank gain_rank points_rank turnover_rank", DEFENSE_SQL)
def _w7d(spark, d):
    rounded = defense(spark, d).withColumns({x: F.round(x, 9) for x, _ in RANKS.values()})
    return panels.period_ranks(rounded, RANKS, "season", "week").select("team", "season", "week", *RANKS)


@query("w9_rolling_prior", "SELECT team, season, week, avg(value_per_play) OVER (PARTITION BY team, season ORDER BY week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS prior FROM offense", "prior", "team season week", OFFENSE_SQL)
def _w9(spark, d):
    return panels.rolling(panels.weekly_panel(plays(spark, d), SPEC), {"prior": "avg(value_per_play)"}, "team", "season", "week", reset=True, prior_only=True).select("team", "season", "week", "prior")


@query("w7_period_rank", "SELECT team, season, week, round(CASE WHEN turnovers_l4 = 3 THEN NULL ELSE value_l4 END, 9) AS metric FROM offense", "metric", "team season week value_rank turnover_rank", OFFENSE_SQL)
def _w7(spark, d):
    o = offense(spark, d).withColumn("metric", F.round(F.when(F.col("turnovers_l4") != 3, F.col("value_l4")), 9))
    return panels.period_ranks(o, {"value_rank": ("metric", False), "turnover_rank": ("turnovers_l4", True)}, "season", "week").select("team", "season", "week", "metric", "value_rank", "turnover_rank")


ORACLES["w7_period_rank"] = f"WITH {PLAYS_SQL.strip()}, {OFFENSE_SQL}, m AS (SELECT team, season, week, turnovers_l4, round(CASE WHEN turnovers_l4 = 3 THEN NULL ELSE value_l4 END, 9) AS metric FROM offense) SELECT team, season, week, round(metric, {DIGITS}) AS metric, rank() OVER (PARTITION BY season, week ORDER BY metric DESC NULLS FIRST) AS value_rank, rank() OVER (PARTITION BY season, week ORDER BY turnovers_l4 ASC NULLS LAST) AS turnover_rank FROM m"

SITUATIONS = {"red_zone": "yardline <= 20", "third_down": "down = 3", "two_minute": "half_seconds <= 120", "short": "togo <= 2"}


def _situational_sql() -> str:
    parts = [f"count(*) FILTER ({t}) AS {n}_plays, avg(epa) FILTER ({t}) AS {n}_value, avg(is_success) FILTER ({t}) AS {n}_success_rate, sum(touchdown) FILTER ({t}) / NULLIF(CAST(count(DISTINCT (game_id, drive)) FILTER ({t}) AS DOUBLE), 0) AS {n}_td_rate" for n, t in SITUATIONS.items()]
    return f"SELECT team, season, week, {', '.join(parts)} FROM plays WHERE epa IS NOT NULL GROUP BY team, season, week HAVING count(*) FILTER ({' OR '.join(SITUATIONS.values())}) > 0"


SIT_DOUBLES = " ".join(f"{n}_{x}" for n in SITUATIONS for x in ("value", "success_rate", "td_rate"))
SIT_COUNTS = "team season week " + " ".join(f"{n}_plays" for n in SITUATIONS)


@query("a6_situational_panel", _situational_sql(), SIT_DOUBLES, SIT_COUNTS)
def _a6(spark, d):
    return panels.situational_panel(plays(spark, d), SPEC, {n: F.expr(t) for n, t in SITUATIONS.items()})


@query("a7_situational_pivot", _situational_sql(), SIT_DOUBLES, SIT_COUNTS)
def _a7(spark, d):
    return panels.situational_panel_by_pivot(plays(spark, d), SPEC, {n: F.expr(t) for n, t in SITUATIONS.items()})


SIT_L4 = {f"{n}_l4": f"avg({n}_value)" for n in SITUATIONS}


@query("w6_situational_rolling", f"SELECT team, season, week, {', '.join(f'{e} OVER w AS {n}' for n, e in SIT_L4.items())} FROM s WINDOW w AS (PARTITION BY team, season ORDER BY week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)", " ".join(SIT_L4), "team season week", f"s AS ({_situational_sql()})")
def _w6(spark, d):
    return panels.rolling(_a6(spark, d), SIT_L4, "team", "season", "week", reset=True).select("team", "season", "week", *SIT_L4)


@query("j2_team_features", "SELECT o.team, o.season, o.week, o.value_l4, d.value_l4 AS def_value_l4, o.trend, CASE WHEN o.value_l4 > 0.15 THEN 'elite' WHEN o.value_l4 > 0.05 THEN 'good' WHEN o.value_l4 > -0.05 THEN 'average' ELSE 'poor' END AS efficiency_tier, CASE WHEN d.value_l4 < -0.1 THEN 'elite' WHEN d.value_l4 < 0 THEN 'good' WHEN d.value_l4 < 0.1 THEN 'average' ELSE 'poor' END AS def_strength_tier FROM offense o LEFT JOIN defense d ON o.team = d.team AND o.season = d.season AND o.week = d.week", "value_l4 def_value_l4 trend", "team season week efficiency_tier def_strength_tier", f"{OFFENSE_SQL}, {DEFENSE_SQL}")
def _j2(spark, d):
    return panels.team_features(offense(spark, d).drop("trend"), defense(spark, d), SPEC).select("team", "season", "week", "value_l4", "def_value_l4", "trend", "efficiency_tier", "def_strength_tier")


@query("w2_first_per_group", "SELECT o_custkey, o_orderkey AS first_order, o_totalprice AS first_price FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1", "first_price", "o_custkey first_order")
def _w2(spark, d):
    o = tables.read_table(spark, d, "orders")
    return panels.first_per_group(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"]).withColumnsRenamed({"o_orderkey": "first_order", "o_totalprice": "first_price"})


@query("w3_latest_per_group", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1", "", "user_id event_id event_type")
def _w3(spark, d):
    return panels.first_per_group(tables.read_table(spark, d, "events"), ["user_id"], ["ts", "event_id"], ["event_id", "event_type"], last=True)


@query("p24_implied_probability", "SELECT game_id, line, CASE WHEN line > 0 THEN 0.5 + abs(line) * 0.033 WHEN line < 0 THEN 0.5 - abs(line) * 0.033 WHEN line = 0 THEN 0.5 END AS implied, 1 / (1 + exp(-prediction / 5.5)) AS home_probability, CASE WHEN abs(line) <= 3 THEN 'Close' WHEN abs(line) <= 7 THEN 'Moderate' ELSE 'Large' END AS category FROM games WHERE prediction IS NOT NULL", "line implied home_probability", "game_id category", GAMES_SQL)
def _p24(spark, d):
    g = games(spark, d).filter("prediction is not null")
    return g.select("game_id", "line", C.implied_probability("line").alias("implied"), C.logistic("prediction").alias("home_probability"), C.bucket(F.abs("line"), ((3, "Close"), (7, "Moderate")), "Large").alias("category"))


FEATURES = ["value_l4", "success_l4", "pass_share", "trend"]


def _sided(on: str) -> str:
    cols = ", ".join(f"h.{x} AS home_{x}, a.{x} AS away_{x}" for x in FEATURES)
    return f"SELECT g.*, {cols} FROM games g LEFT JOIN offense h ON g.home_team = h.team AND g.season = h.season AND {on.format(s='h')} LEFT JOIN offense a ON g.away_team = a.team AND g.season = a.season AND {on.format(s='a')}"


LAGGED = _sided("g.week = {s}.week + 1")
SIDES = " ".join(f"{p}_{x}" for p in ("home", "away") for x in FEATURES)


def game_features(spark: SparkSession, d: str) -> DataFrame:
    g = matchups.lagged_sides(games(spark, d), offense(spark, d), "team", "season", "week", FEATURES)
    return matchups.baselines(matchups.weather_adjustments(matchups.differentials(g, FEATURES)))


@query("j4_lagged_join", LAGGED, SIDES, "game_id season week home_team away_team", f"{GAMES_SQL}, {OFFENSE_SQL}")
def _j4(spark, d):
    g = matchups.lagged_sides(games(spark, d), offense(spark, d), "team", "season", "week", FEATURES)
    return g.select("game_id", "season", "week", "home_team", "away_team", *SIDES.split())


DERIVED = f"""l AS ({LAGGED}), x AS (SELECT *, home_value_l4 - away_value_l4 AS gap, home_success_l4 - away_success_l4 AS sgap, home_pass_share - away_pass_share AS pgap, roof IN ('dome', 'closed') AS inside FROM l),
y AS (SELECT *, CASE WHEN inside THEN 0.0 WHEN wind >= 20 OR temp <= 20 THEN -4.0 WHEN wind >= 15 OR temp <= 32 THEN -2.0 WHEN wind >= 10 THEN -1.0 ELSE 0.0 END AS total_adjustment, CASE WHEN NOT inside AND wind >= 15 THEN pgap * -0.5 ELSE 0.0 END AS wind_spread_adjustment, CASE WHEN inside THEN 2.0 WHEN temp <= 32 THEN 3.0 ELSE 2.5 END AS home_advantage FROM x)"""


@query("p35_game_features", "SELECT game_id, total_adjustment, wind_spread_adjustment, home_advantage, 14 * gap + home_advantage AS simple_spread, 12 * gap + 8 * sgap + 0.5 * wind_spread_adjustment + home_advantage AS enhanced_spread, 45 + 10 * (home_value_l4 + away_value_l4) + total_adjustment AS adjusted_total, greatest(least(gap + 0.5, 1.0), 0.0) AS gap_norm, abs(home_trend - away_trend) AS trend_gap FROM y WHERE week >= 2 AND home_value_l4 IS NOT NULL AND away_value_l4 IS NOT NULL", "total_adjustment wind_spread_adjustment home_advantage simple_spread enhanced_spread adjusted_total gap_norm trend_gap", "game_id", f"{GAMES_SQL}, {OFFENSE_SQL}, {DERIVED}")
def _p35(spark, d):
    g = matchups.complete_rows(game_features(spark, d), ["value_l4"], "week")
    return g.select("game_id", "total_adjustment", "wind_spread_adjustment", "home_advantage", "simple_spread", "enhanced_spread", "adjusted_total", "gap_norm", "trend_gap")


@query("j4_asof_join", "SELECT g.game_id, (SELECT max_by(o.value_l4, o.week) FROM offense o WHERE o.team = g.home_team AND o.season = g.season AND o.week < g.week) AS home_value_l4, (SELECT max_by(o.value_l4, o.week) FROM offense o WHERE o.team = g.away_team AND o.season = g.season AND o.week < g.week) AS away_value_l4 FROM games g", "home_value_l4 away_value_l4", "game_id", f"{GAMES_SQL}, {OFFENSE_SQL}")
def _asof(spark, d):
    return matchups.lagged_sides(games(spark, d), offense(spark, d), "team", "season", "week", ["value_l4"], asof=True).select("game_id", "home_value_l4", "away_value_l4")


@query("j6_upcoming_features", "SELECT g.game_id, h.value_l4 AS home_value_l4, a.value_l4 AS away_value_l4 FROM games g LEFT JOIN (SELECT * FROM offense QUALIFY row_number() OVER (PARTITION BY team, season ORDER BY week DESC) = 1) h ON g.home_team = h.team AND g.season = h.season LEFT JOIN (SELECT * FROM offense QUALIFY row_number() OVER (PARTITION BY team, season ORDER BY week DESC) = 1) a ON g.away_team = a.team AND g.season = a.season", "home_value_l4 away_value_l4", "game_id", f"{GAMES_SQL}, {OFFENSE_SQL}")
def _j6(spark, d):
    return matchups.latest_sides(games(spark, d), offense(spark, d), "team", "season", "week", ["value_l4"]).select("game_id", "home_value_l4", "away_value_l4")


@query("p28_same_group", "SELECT game_id, CASE WHEN h.n_regionkey = a.n_regionkey THEN 1 ELSE 0 END AS same_group FROM games JOIN nation h ON home_team = h.n_name JOIN nation a ON away_team = a.n_name", "", "game_id same_group", GAMES_SQL)
def _p28(spark, d):
    return matchups.with_groups(games(spark, d), tables.read_table(spark, d, "nation"), "n_name", "n_regionkey").select("game_id", "same_group")


WEATHER = """gw AS (SELECT game_id, max(wind) AS wind, max(temp) AS temp FROM plays GROUP BY game_id), gc AS (SELECT game_id, CASE WHEN wind >= 15 OR temp <= 32 OR temp >= 90 THEN 1 ELSE 0 END AS adverse, CASE WHEN wind >= 20 OR temp <= 20 THEN 'Severe' WHEN wind >= 15 OR temp <= 32 OR temp >= 90 THEN 'Moderate' ELSE 'Normal' END AS severity FROM gw),
split AS (SELECT team, season, adverse, severity, count(DISTINCT game_id) AS games, count(*) AS plays, avg(epa) AS value, avg(is_success) AS success, sum(turnover) AS turnovers FROM plays JOIN gc USING (game_id) WHERE epa IS NOT NULL GROUP BY team, season, adverse, severity),
one AS (SELECT team, season, max(value) FILTER (adverse = 0) AS good_value, max(value) FILTER (adverse = 1) AS adverse_value, CAST(coalesce(sum(games) FILTER (adverse = 0), 0) AS BIGINT) AS good_games, CAST(coalesce(sum(games) FILTER (adverse = 1), 0) AS BIGINT) AS adverse_games FROM split GROUP BY team, season),
two AS (SELECT *, CASE WHEN good_games >= 2 AND adverse_games >= 2 THEN adverse_value - good_value END AS value_impact FROM one), league AS (SELECT season, avg(value_impact) AS league_impact, stddev_samp(value_impact) AS league_deviation FROM two WHERE value_impact IS NOT NULL GROUP BY season)"""


def _weather(spark, d):
    p = plays(spark, d)
    g = matchups.game_weather(p, "game_id", ("wind", "temp"))
    return conditions.condition_rollup(p.drop("wind", "temp"), g, "game_id", ["team", "season"], "epa")


@query("a11_condition_split", "SELECT team, season, adverse, severity, games, plays, value, success, CAST(turnovers AS BIGINT) AS turnovers FROM split", "value success", "team season adverse severity games plays turnovers", WEATHER)
def _a11(spark, d):
    return _weather(spark, d)


@query("a15_condition_impact", "SELECT team, season, good_value, adverse_value, good_games, adverse_games, value_impact, league_impact, league_deviation, coalesce(value_impact, league_impact, 0.0) AS expected_impact, CASE WHEN value_impact IS NULL THEN 'Insufficient Data' WHEN value_impact >= 0.05 THEN 'Excellent' WHEN value_impact >= -0.05 THEN 'Good' WHEN value_impact >= -0.15 THEN 'Average' ELSE 'Poor' END AS resistance FROM two LEFT JOIN league USING (season)", "good_value adverse_value value_impact league_impact league_deviation expected_impact", "team season good_games adverse_games resistance", WEATHER)
def _a15(spark, d):
    return conditions.condition_impact(_weather(spark, d), ["team", "season"], "season").select("team", "season", "good_value", "adverse_value", "good_games", "adverse_games", "value_impact", "league_impact", "league_deviation", "expected_impact", "resistance")


RIGHT = "CASE WHEN prediction * actual > 0 THEN 1.0 ELSE 0.0 END"


@query("a21_season_report", f"SELECT *, bold_wins * 90.91 - (bold_bets - bold_wins) * 100 AS profit, CASE WHEN accuracy >= 0.55 THEN 'Strong' WHEN accuracy >= 0.5238 THEN 'Marginal' ELSE 'Avoid' END AS verdict, CASE WHEN bold_accuracy > cautious_accuracy THEN 'Well Calibrated' ELSE 'Needs Calibration' END AS calibration, CASE WHEN bold_wins * 90.91 - (bold_bets - bold_wins) * 100 > 0 THEN 1 ELSE 0 END AS profitable FROM (SELECT season, count(*) AS games, avg(abs(prediction - actual)) AS mae, avg({RIGHT}) AS accuracy, avg({RIGHT}) FILTER (abs(prediction) >= 7) AS bold_accuracy, avg({RIGHT}) FILTER (NOT abs(prediction) >= 7) AS cautious_accuracy, avg({RIGHT}) FILTER (abs(actual) <= 7) AS close_accuracy, count(*) FILTER (abs(prediction) >= 7) AS bold_bets, count(*) FILTER (abs(prediction) >= 7 AND prediction * actual > 0) AS bold_wins FROM results GROUP BY season)", "mae accuracy bold_accuracy cautious_accuracy close_accuracy profit", "season games bold_bets bold_wins verdict calibration profitable", GAMES_SQL)
def _a21(spark, d):
    return backtest.season_report(results(spark, d))


@query("a18_weekly_trend", f"SELECT season, week, games, mae, accuracy, avg(mae) OVER w AS mae_l4, avg(accuracy) OVER w AS accuracy_l4 FROM (SELECT season, week, count(*) AS games, avg(abs(prediction - actual)) AS mae, avg({RIGHT}) AS accuracy FROM results GROUP BY season, week) WINDOW w AS (PARTITION BY season ORDER BY week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)", "mae accuracy mae_l4 accuracy_l4", "season week games", GAMES_SQL)
def _a18(spark, d):
    return backtest.weekly_trend(results(spark, d))


@query("a19_feature_strength", f"SELECT season, avg({RIGHT}) FILTER (abs(line) >= 4) AS big_gap_accuracy, avg({RIGHT}) FILTER (NOT abs(line) >= 4) AS small_gap_accuracy FROM results GROUP BY season", "big_gap_accuracy small_gap_accuracy", "season", GAMES_SQL)
def _a19(spark, d):
    return backtest.feature_strength(results(spark, d), "line", 4)


METRICS = "avg(abs(actual - prediction)) AS mae, sqrt(avg((actual - prediction) * (actual - prediction))) AS rmse, avg(actual - prediction) AS mean_residual, stddev_pop(actual - prediction) AS std_residual, avg(CASE WHEN sign(prediction) = sign(actual) THEN 1.0 ELSE 0.0 END) AS direction, avg(CASE WHEN abs(actual - prediction) < 3 THEN 1.0 ELSE 0.0 END) AS within, count(*) AS n, 1 - sum((actual - prediction) * (actual - prediction)) / nullif(var_pop(actual) * count(*), 0) AS r2"
METRIC_DOUBLES = "mae rmse mean_residual std_residual direction within r2"


@query("a22_regression_metrics", f"SELECT season, {METRICS} FROM results GROUP BY season", METRIC_DOUBLES, "season n", GAMES_SQL)
def _a22(spark, d):
    return backtest.regression_metrics(results(spark, d), by=["season"])


@query("a23_by_confidence", f"SELECT CASE WHEN abs(prediction) >= 7 THEN 'high' ELSE 'low' END AS side, {METRICS} FROM results GROUP BY 1", METRIC_DOUBLES, "side n", GAMES_SQL)
def _a23(spark, d):
    return backtest.by_confidence(results(spark, d))


@query("a24_cv_metrics", "SELECT season, avg(abs(prediction - actual)) AS mae, sqrt(avg((prediction - actual) * (prediction - actual))) AS rmse, avg(CASE WHEN sign(prediction) = sign(actual) THEN 1.0 ELSE 0.0 END) AS direction, count(*) AS n FROM results GROUP BY ROLLUP (season)", "mae rmse direction", "season n", GAMES_SQL)
def _a24(spark, d):
    return backtest.cv_metrics(results(spark, d), "season")


@query("a25_ats", "SELECT coalesce(avg(CASE WHEN (prediction > line) = (actual > line) THEN 1.0 ELSE 0.0 END), 0.5) AS ats, count(*) AS bets FROM results WHERE line IS NOT NULL AND abs(prediction - line) >= 2", "ats", "bets", GAMES_SQL)
def _a25(spark, d):
    return backtest.ats_accuracy(results(spark, d), edge=2.0)


@query("a26_ats_by_product", "SELECT avg(CASE WHEN (prediction - line) * (actual - line) > 0 THEN 1.0 ELSE 0.0 END) AS ats, count(*) AS bets FROM results WHERE line IS NOT NULL", "ats", "bets", GAMES_SQL)
def _a26(spark, d):
    return backtest.ats_by_product(results(spark, d))


@query("a27_roi", "SELECT *, bets - wins - pushes AS losses, wins * (100.0 / 110) - (bets - wins - pushes) AS profit, CAST(wins AS DOUBLE) / nullif(bets - pushes, 0) AS win_rate, (wins * (100.0 / 110) - (bets - wins - pushes)) / bets AS roi FROM (SELECT season, count(*) AS bets, count(*) FILTER (actual <> line AND (prediction > line) = (actual > line)) AS wins, count(*) FILTER (actual = line) AS pushes FROM results WHERE line IS NOT NULL AND abs(prediction - line) >= 3 GROUP BY season)", "profit win_rate roi", "season bets wins pushes losses", GAMES_SQL)
def _a27(spark, d):
    return backtest.roi(results(spark, d), by=["season"])


@query("a28_brier", "SELECT season, avg(power(1 / (1 + exp(-prediction / 5.5)) - CASE WHEN actual > 0 THEN 1.0 ELSE 0.0 END, 2)) AS brier, count(*) AS n FROM results GROUP BY season", "brier", "season n", GAMES_SQL)
def _a28(spark, d):
    r = results(spark, d).withColumns({"p": C.logistic("prediction"), "y": F.when(F.col("actual") > 0, 1.0).otherwise(0.0)})
    return backtest.brier(r, "p", "y", ["season"])


@query("a29_model_comparison", "SELECT *, coalesce((wins * (100.0 / 110) - losses) / nullif(bets, 0), 0.0) AS roi, CASE WHEN mae = min(mae) OVER () THEN 1 ELSE 0 END AS best, CASE WHEN ats = max(ats) OVER () THEN 1 ELSE 0 END AS best_by_ats FROM (SELECT model, avg(abs(v - actual)) AS mae, sqrt(avg((v - actual) * (v - actual))) AS rmse, avg(CASE WHEN (v > line) = (actual > line) THEN 1.0 ELSE 0.0 END) FILTER (line IS NOT NULL) AS ats, count(*) AS n, avg(power(1 / (1 + exp(-v / 5.5)) - CASE WHEN actual > 0 THEN 1.0 ELSE 0.0 END, 2)) AS brier, count(*) FILTER (abs(v - line) >= 3) AS bets, count(*) FILTER (abs(v - line) >= 3 AND actual <> line AND (v > line) = (actual > line)) AS wins, count(*) FILTER (abs(v - line) >= 3 AND actual <> line AND (v > line) <> (actual > line)) AS losses FROM (SELECT 'prediction' AS model, prediction AS v, actual, line FROM results UNION ALL SELECT 'other_prediction', other_prediction, actual, line FROM results) GROUP BY model)", "mae rmse ats brier roi", "model n bets wins losses best best_by_ats", GAMES_SQL)
def _a29(spark, d):
    return backtest.model_comparison(results(spark, d), ["prediction", "other_prediction"])


@query("a30_market_comparison", "SELECT avg(abs(prediction - actual)) AS model_mae, avg(abs(line - actual)) AS market_mae, count(*) AS n FROM results WHERE line IS NOT NULL", "model_mae market_mae", "n", GAMES_SQL)
def _a30(spark, d):
    return backtest.market_comparison(results(spark, d))


@query("a31_distribution", "SELECT count(*) AS n, avg(prediction) AS mean, stddev_pop(prediction) AS std, min(prediction) AS least, max(prediction) AS largest, count(*) FILTER (prediction > 0) AS home, count(*) FILTER (prediction < 0) AS away, count(*) FILTER (abs(prediction) <= 1) AS within_one FROM results", "mean std least largest", "n home away within_one", GAMES_SQL)
def _a31(spark, d):
    return backtest.distribution(results(spark, d))


@query("a32_recommendations", "SELECT recommendation, confidence, count(*) AS n FROM (SELECT CASE WHEN prediction - line >= 3 THEN 'BET HOME' WHEN prediction - line <= -3 THEN 'BET AWAY' ELSE 'NO BET' END AS recommendation, CASE WHEN abs(prediction - line) >= 5 THEN 'HIGH' WHEN abs(prediction - line) >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM results) GROUP BY ALL", "", "recommendation confidence n", GAMES_SQL)
def _a32(spark, d):
    r = results(spark, d).withColumn("edge", F.col("prediction") - F.col("line"))
    return r.groupBy(C.recommendation("edge").alias("recommendation"), C.confidence("edge").alias("confidence")).agg(F.count("*").alias("n"))


@query("l8_best_edges", "SELECT game_id, prediction - line AS edge FROM results WHERE line IS NOT NULL ORDER BY round(abs(prediction - line), 9) DESC, game_id LIMIT 20", "edge", "game_id", GAMES_SQL)
def _l8(spark, d):
    r = results(spark, d).filter("line is not null").withColumn("edge", F.col("prediction") - F.col("line"))
    return r.orderBy(F.round(F.abs("edge"), 9).desc(), "game_id").limit(20).select("game_id", "edge")


@query("a34_standardised", "SELECT game_id, (prediction - avg(prediction) OVER ()) / CASE WHEN stddev_pop(prediction) OVER () < 1e-8 THEN 1.0 ELSE stddev_pop(prediction) OVER () END AS prediction FROM results", "prediction", "game_id", GAMES_SQL)
def _a34(spark, d):
    return folds.standardised(results(spark, d).select("game_id", "prediction"), ["prediction"])


@query("a35_usage_daily", "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, sum(value) AS total, avg(value) AS mean FROM events GROUP BY ALL", "total mean", "day event_type n")
def _a35(spark, d):
    return tables.read_table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.avg("value").alias("mean"))


@query("a36_coverage", "SELECT season, count(*) AS plays, count(DISTINCT game_id) AS games, count(DISTINCT week) AS weeks, min(week) AS first_week, max(week) AS last_week FROM plays GROUP BY season", "", "season plays games weeks first_week last_week")
def _a36(spark, d):
    return plays(spark, d).groupBy("season").agg(F.count("*").alias("plays"), F.count_distinct("game_id").alias("games"), F.count_distinct("week").alias("weeks"), F.min("week").alias("first_week"), F.max("week").alias("last_week"))


@query("m12_walk_forward", "SELECT f.season AS fold, CASE WHEN r.season = f.season THEN 'test' ELSE 'train' END AS role, count(*) AS n FROM results r JOIN (SELECT season, dense_rank() OVER (ORDER BY season) AS i FROM (SELECT DISTINCT season FROM results)) f ON f.i > 3 AND r.season <= f.season GROUP BY ALL", "", "fold role n", GAMES_SQL)
def _m12(spark, d):
    return folds.walk_forward(results(spark, d), "season", 3).groupBy("fold", "role").agg(F.count("*").alias("n"))


@query("m13_holdout", "SELECT season, CASE WHEN season >= (SELECT min(season) FROM (SELECT DISTINCT season FROM results ORDER BY season DESC LIMIT 2)) THEN 'test' ELSE 'train' END AS role, count(*) AS n FROM results GROUP BY ALL", "", "season role n", GAMES_SQL)
def _m13(spark, d):
    return folds.holdout(results(spark, d), "season", 2).groupBy("season", "role").agg(F.count("*").alias("n"))


@query("m14_chronological_tail", "SELECT season, role, count(*) AS n FROM (SELECT season, CASE WHEN row_number() OVER (ORDER BY season, week, game_id) > floor(count(*) OVER () * 0.8) THEN 'valid' ELSE 'train' END AS role FROM results) GROUP BY ALL", "", "season role n", GAMES_SQL)
def _m14(spark, d):
    return folds.chronological_tail(results(spark, d), "season", "week", "game_id").groupBy("season", "role").agg(F.count("*").alias("n"))


@query("p45_training_frame", "SELECT game_id, season, week, CAST(home_score - away_score AS DOUBLE) AS target, home_value_l4, away_value_l4, home_value_l4 - away_value_l4 AS fe_value_diff, wind * (home_pass_share - away_pass_share) AS fe_wind_pass, 25 * (home_value_l4 - away_value_l4) AS fe_expected_margin FROM l WHERE home_value_l4 IS NOT NULL AND away_value_l4 IS NOT NULL AND home_pass_share IS NOT NULL AND away_pass_share IS NOT NULL AND home_success_l4 IS NOT NULL AND away_success_l4 IS NOT NULL AND home_trend IS NOT NULL AND away_trend IS NOT NULL", "target home_value_l4 away_value_l4 fe_value_diff fe_wind_pass fe_expected_margin", "game_id season week", f"{GAMES_SQL}, {OFFENSE_SQL}, l AS ({LAGGED})")
def _p45(spark, d):
    g = matchups.lagged_sides(games(spark, d), offense(spark, d), "team", "season", "week", FEATURES)
    return matchups.training_frame(g, SIDES.split(), "spread").select("game_id", "season", "week", "target", "home_value_l4", "away_value_l4", "fe_value_diff", "fe_wind_pass", "fe_expected_margin")


@query("m16_residual_histogram", "SELECT CAST(coalesce(least(29, floor((r - lo) / nullif(hi - lo, 0) * 30)), 0) AS BIGINT) AS bin, count(*) AS n, min(r) AS least FROM (SELECT actual - prediction AS r, min(actual - prediction) OVER () AS lo, max(actual - prediction) OVER () AS hi FROM results) GROUP BY 1", "least", "bin n", GAMES_SQL)
def _m16(spark, d):
    return backtest.residual_histogram(results(spark, d))


@query("m9_disagreement", "SELECT game_id, abs(prediction - other_prediction) / 2 AS deviation FROM results", "deviation", "game_id", GAMES_SQL)
def _m9(spark, d):
    return results(spark, d).select("game_id", learn.disagreement(["prediction", "other_prediction"]).alias("deviation"))


@query("u4_entity_universe", "SELECT home_team AS team FROM games UNION SELECT away_team FROM games", "", "team", GAMES_SQL)
def _u4(spark, d):
    return ratings.entity_universe(games(spark, d))


@query("w10_strength_ranking", "SELECT home_team, mean, row_number() OVER (ORDER BY mean DESC, home_team) AS rank FROM (SELECT home_team, round(avg(actual), 9) AS mean FROM results GROUP BY home_team)", "mean", "home_team rank", GAMES_SQL)
def _w10(spark, d):
    return backtest.strength_ranking(results(spark, d).groupBy("home_team").agg(F.round(F.avg("actual"), 9).alias("mean")), "home_team", "mean")


@query("q_dq_report", "SELECT 'not_null' AS \"check\", 'orders' AS \"table\", 'o_orderkey' AS \"column\", 'error' AS severity, count(*) FILTER (o_orderkey IS NULL) AS failures FROM orders UNION ALL SELECT 'accepted_values', 'orders', 'o_orderstatus', 'warn', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders UNION ALL SELECT 'unique', 'orders', 'o_orderkey', 'error', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) UNION ALL SELECT 'unique', 'lineitem', 'l_orderkey+l_linenumber', 'error', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) UNION ALL SELECT 'range', 'lineitem', 'l_quantity', 'warn', count(*) FILTER (NOT l_quantity BETWEEN 1 AND 45) FROM lineitem", "", "\"check\" \"table\" \"column\" severity failures passed")
def _q(spark, d):
    o, li = tables.read_table(spark, d, "orders"), tables.read_table(spark, d, "lineitem")
    return quality.report(quality.not_null(o, ["o_orderkey"], "orders"), quality.accepted_values(o, {"o_orderstatus": ["F", "O"]}, "orders", "warn"), quality.unique(o, ["o_orderkey"], "orders"), quality.unique(li, ["l_orderkey", "l_linenumber"], "lineitem", concat=True), quality.in_range(li, {"l_quantity": (1, 45)}, "lineitem"))


ORACLES["q_dq_report"] = ORACLES["q_dq_report"].replace("severity, failures, passed FROM", "severity, failures, CAST(CASE WHEN failures = 0 THEN 1 ELSE 0 END AS BIGINT) AS passed FROM").replace("severity failures passed", "")


@query("q8_conversion_failures", "SELECT 'o_orderstatus' AS column_name, count(*) FILTER (o_orderstatus IS NOT NULL AND TRY_CAST(o_orderstatus AS DOUBLE) IS NULL) AS failures FROM orders UNION ALL SELECT 'o_orderpriority', count(*) FILTER (o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS DOUBLE) IS NULL) FROM orders UNION ALL SELECT 'o_totalprice', count(*) FILTER (o_totalprice IS NOT NULL AND TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) IS NULL) FROM orders", "", "column_name failures")
def _q8(spark, d):
    return tables.conversion_failures(tables.as_text(tables.read_table(spark, d, "orders")), {"o_orderstatus": "double", "o_orderpriority": "double", "o_totalprice": "double"})


def line_games(spark, d):
    """A game per customer, at home, part and month: the quantity bought against the part's size."""
    t = lambda name: spark.read.parquet(f"{d}/{name}.parquet")
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    lines = lines.select(F.year("o_orderdate").cast("long").alias("season"), F.month("o_orderdate").cast("long").alias("week"), "o_custkey", "l_partkey", "l_quantity", "p_size")
    g = lines.groupBy("season", "week", "o_custkey", "l_partkey").agg(F.sum("l_quantity").cast("long").alias("home_score"), F.sum("p_size").cast("long").alias("away_score"))
    g = g.select("season", "week", F.concat(F.lit("C"), "o_custkey").alias("home_team"), F.concat(F.lit("P"), "l_partkey").alias("away_team"), "home_score", "away_score")
    return g.withColumns({"pool": F.lit("all"), "game_id": F.concat_ws("_", "season", "week", "home_team", "away_team")})


#: The same sweeps as a recursion over all games, a fixed number of them.
ELO_SQL = """
WITH RECURSIVE g AS (
  SELECT concat_ws('_', season, week, home_team, away_team) AS game_id, season, week, home_team, away_team, CAST(CAST(sum(l_quantity) AS BIGINT) - sum(p_size) AS DOUBLE) AS margin
  FROM (SELECT CAST(year(o_orderdate) AS BIGINT) AS season, CAST(month(o_orderdate) AS BIGINT) AS week, 'C' || o_custkey AS home_team, 'P' || l_partkey AS away_team, l_quantity, p_size
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey) GROUP BY ALL
), s AS (
  SELECT g.*, r.i FROM g JOIN (SELECT season, dense_rank() OVER (ORDER BY season) AS i FROM (SELECT DISTINCT season FROM g)) r USING (season)
), sweeps AS (
  SELECT 0 AS n, s.*, CAST(0 AS DOUBLE) AS move, CAST(0 AS DOUBLE) AS home_pre, CAST(0 AS DOUBLE) AS away_pre FROM s
  UNION ALL
  SELECT n + 1, game_id, season, week, home_team, away_team, margin, i,
    20 * ln(abs(margin) + 1) * (CASE WHEN home_pre - away_pre + 48 > 0 AND margin > 0 THEN 2.2 / ((home_pre - away_pre + 48) * 0.001 + 2.2) ELSE 1.0 END)
      * ((CASE WHEN margin = 0 THEN 0.5 WHEN margin > 0 THEN 1.0 ELSE 0.0 END) - 1 / (1 + pow(10, -(home_pre - away_pre + 48) / 400))) AS move, home_pre, away_pre
  FROM (
    SELECT n, game_id, season, week, home_team, away_team, margin, i, max(pre) FILTER (at_home) AS home_pre, max(pre) FILTER (NOT at_home) AS away_pre
    FROM (
      SELECT *, 1505 - 5 * pow(0.67, i - first_value(i) OVER own) + pow(0.67, i) * coalesce(sum(gain * pow(0.67, -i)) OVER (own ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre
      FROM (SELECT w.*, h AS at_home, CASE WHEN h THEN home_team ELSE away_team END AS team, CASE WHEN h THEN move ELSE -move END AS gain FROM sweeps w, (VALUES (true), (false)) v(h) WHERE n < 40)
      WINDOW own AS (PARTITION BY team ORDER BY season, week, game_id)
    ) GROUP BY ALL
  )
), history AS (
  SELECT 'all' AS pool, game_id, season, week, home_team, away_team, home_pre, away_pre, home_pre + move AS home_post, away_pre - move AS away_post FROM sweeps WHERE n = 40
)
"""
HISTORY = "pool game_id season week home_team away_team"


@query("m1_elo_history", f"{ELO_SQL} SELECT * FROM history", "home_pre away_pre home_post away_post", HISTORY)
def _m1(spark, d):
    return ratings.elo_history(line_games(spark, d))


@query("m3_current_ratings", f"{ELO_SQL} SELECT pool, team, arg_max(rating, (season, week, game_id)) AS rating FROM (SELECT pool, home_team AS team, season, week, game_id, home_post AS rating FROM history UNION ALL SELECT pool, away_team, season, week, game_id, away_post FROM history) GROUP BY pool, team", "rating", "pool team")
def _m3(spark, d):
    return ratings.current_ratings(_m1(spark, d))


@query("j13_elo_predictions", f"{ELO_SQL} SELECT h.game_id, (coalesce(a.rating, 1500) - coalesce(b.rating, 1500) + 48) / 25 AS spread, 1 / (1 + pow(10, -(coalesce(a.rating, 1500) - coalesce(b.rating, 1500) + 48) / 400)) AS home_win_probability FROM history h LEFT JOIN (SELECT team, arg_max(rating, (season, week, game_id)) AS rating FROM (SELECT home_team AS team, season, week, game_id, home_post AS rating FROM history UNION ALL SELECT away_team, season, week, game_id, away_post FROM history) GROUP BY team) a ON a.team = h.home_team LEFT JOIN (SELECT team, arg_max(rating, (season, week, game_id)) AS rating FROM (SELECT home_team AS team, season, week, game_id, home_post AS rating FROM history UNION ALL SELECT away_team, season, week, game_id, away_post FROM history) GROUP BY team) b ON b.team = h.away_team", "spread home_win_probability", "game_id")
def _j13(spark, d):
    g = Rounds("line-games").keep(line_games(spark, d))
    return ratings.elo_predictions(g, ratings.current_ratings(ratings.elo_history(g))).select("game_id", "spread", "home_win_probability")


@query("m6_ridge_strength")
def _m6(spark, d):
    return ratings.ridge_strength(games(spark, d))


@query("m6_strength_predictions")
def _m6_predictions(spark, d):
    g = games(spark, d)
    return ratings.strength_predictions(g, ratings.ridge_strength(g)).select("game_id", "home_team", "away_team", "strength_spread")


@query("m5_gbt_scores")
def _m5(spark, d):
    """Events are joined once for the games and once for the panel; what that shuffles goes before the next step. Both are small beside the events."""
    g = Rounds("gbt-games").keep(games(spark, d))
    cleared(spark)
    panel = Rounds("gbt-panel").keep(offense(spark, d).select("team", "season", "week", *FEATURES))
    cleared(spark)
    frame = matchups.training_frame(matchups.lagged_sides(g, panel, "team", "season", "week", FEATURES), SIDES.split(), "spread")
    frame = folds.holdout(Rounds("gbt-rows").keep(frame.select("game_id", "season", "target", *SIDES.split())), "season")
    model = learn.boosted_trees(frame.filter("role = 'train'"), SIDES.split())
    return model.transform(frame.filter("role = 'test'")).select("game_id", "target", "prediction")


STACKED = """s AS (SELECT count(*) AS n, avg(prediction) AS m1, avg(other_prediction) AS m2, stddev_pop(prediction) AS d1, stddev_pop(other_prediction) AS d2, avg(actual) AS my FROM results),
z AS (SELECT game_id, actual - my AS y, (prediction - m1) / d1 AS z1, (other_prediction - m2) / d2 AS z2, my FROM results, s),
g AS (SELECT sum(z1 * z1) + 1 AS a, sum(z1 * z2) AS b, sum(z2 * z2) + 1 AS c, sum(z1 * y) AS u, sum(z2 * y) AS v FROM z)"""


@query("m8_stacked_scores", "SELECT game_id, my + z1 * (c * u - b * v) / (a * c - b * b) + z2 * (a * v - b * u) / (a * c - b * b) AS stacked FROM z, g", "stacked", "game_id", f"{GAMES_SQL}, {STACKED}")
def _m8(spark, d):
    return learn.stacked(results(spark, d).select("game_id", "actual", "prediction", "other_prediction"), ["prediction", "other_prediction"], "actual")[0].select("game_id", "stacked")


def walk_ridge_sql(name: str, source: str, models: dict[str, list[str]], least: int) -> str:
    """CTEs ending in `name`: rows of `source` whose season has `least` seasons before, and predictions of ridges on one or two columns, in closed form."""
    x = sorted({c for used in models.values() for c in used})
    one, two = x if len(x) == 2 else (x[0], x[0])
    parts = []
    for model, used in models.items():
        if len(used) == 1:
            c, d, u = ("z1", "d1", "u") if used[0] == one else ("z2", "d2", "v")
            parts.append(f"my + {c} * {u} / (n + 1) AS {model}_prediction")
        else:
            parts.append(f"my + (z1 * ((n + 1) * u - b * v) + z2 * ((n + 1) * v - b * u)) / ((n + 1) * (n + 1) - b * b) AS {model}_prediction")
    return f"""{name}_f AS (SELECT season AS fold FROM (SELECT season, row_number() OVER (ORDER BY season) AS i FROM (SELECT DISTINCT season FROM {source})) WHERE i > {least}),
{name}_m AS (SELECT fold, count(*) AS n, avg({one}) AS m1, avg({two}) AS m2, CASE WHEN stddev_pop({one}) < 1e-8 THEN 1 ELSE stddev_pop({one}) END AS d1, CASE WHEN stddev_pop({two}) < 1e-8 THEN 1 ELSE stddev_pop({two}) END AS d2, avg(actual) AS my FROM {name}_f JOIN {source} ON season < fold GROUP BY fold),
{name}_s AS (SELECT m.fold, any_value(n) AS n, any_value(m1) AS m1, any_value(m2) AS m2, any_value(d1) AS d1, any_value(d2) AS d2, any_value(my) AS my, sum(({one} - m1) / d1 * ({two} - m2) / d2) AS b, sum(({one} - m1) / d1 * (actual - my)) AS u, sum(({two} - m2) / d2 * (actual - my)) AS v FROM {name}_m m JOIN {source} ON season < m.fold GROUP BY m.fold),
{name} AS (SELECT * EXCLUDE (fold, n, m1, m2, d1, d2, my, b, u, v, z1, z2), {', '.join(parts)} FROM (SELECT r.*, s.*, ({one} - m1) / d1 AS z1, ({two} - m2) / d2 AS z2 FROM {source} r JOIN {name}_s s ON r.season = s.fold))"""


BASE_MODELS = {"both": ["other_prediction", "prediction"], "one": ["prediction"]}
STACK = {"stacked": ["both_prediction", "one_prediction"]}
OOF_SQL = f"{GAMES_SQL}, {walk_ridge_sql('oof', 'results', BASE_MODELS, 3)}"
STACK_SQL = f"{OOF_SQL}, {walk_ridge_sql('stacks', 'oof', STACK, 1)}"
TOLD_SQL = "told AS (SELECT model, season, count(*) AS n, avg(abs(p - actual)) AS mae, sqrt(avg((p - actual) * (p - actual))) AS rmse, avg(p - actual) AS bias, avg(power(1 / (1 + exp(-p / 5.5)) - CASE WHEN actual > 0 THEN 1.0 ELSE 0.0 END, 2)) AS brier, avg(CASE WHEN (p > 0) = (actual > 0) THEN 1.0 ELSE 0.0 END) AS hit_rate FROM (SELECT season, actual, unnest(['both_prediction', 'one_prediction', 'stacked_prediction']) AS model, unnest([both_prediction, one_prediction, stacked_prediction]) AS p FROM stacks) GROUP BY GROUPING SETS ((model, season), (model)))"


def _out_of_fold(spark, d):
    r = results(spark, d)
    return training.out_of_fold(r, "season", BASE_MODELS, training.fold_coefficients(r, "season", BASE_MODELS, "actual"))


@query("m8_out_of_fold", "SELECT game_id, season, both_prediction, one_prediction FROM oof", "both_prediction one_prediction", "game_id season", OOF_SQL)
def _m8_oof(spark, d):
    return _out_of_fold(spark, d).select("game_id", "season", "both_prediction", "one_prediction")


@query("m8_walk_forward_stack", "SELECT game_id, season, stacked_prediction FROM stacks", "stacked_prediction", "game_id season", STACK_SQL)
def _m8_stack(spark, d):
    return training.stacked_walk_forward(_out_of_fold(spark, d), "season", STACK["stacked"], "actual")[0].select("game_id", "season", "stacked_prediction")


@query("m8_diagnostics", "SELECT * FROM told", "mae rmse bias brier hit_rate", "model season n", f"{STACK_SQL}, {TOLD_SQL}")
def _m8_told(spark, d):
    rows = training.stacked_walk_forward(_out_of_fold(spark, d), "season", STACK["stacked"], "actual")[0]
    return training.diagnostics(rows, "season", ["both_prediction", "one_prediction", "stacked_prediction"], "actual")


@query("m17_training_run", "SELECT 'r1' AS run, (SELECT count(*) FROM oof_f) AS folds, (SELECT max(n) FROM oof_m) AS most_training_rows, (SELECT arg_min(model, mae) FROM told WHERE season IS NULL) AS best_model, (SELECT min(mae) FROM told WHERE season IS NULL) AS best_mae, mae AS stacked_mae, brier AS stacked_brier FROM told WHERE season IS NULL AND model = 'stacked_prediction'", "best_mae stacked_mae stacked_brier", "run folds most_training_rows best_model", f"{STACK_SQL}, {TOLD_SQL}")
def _m17(spark, d):
    return training.training_run(results(spark, d), "season", BASE_MODELS, "actual", scratch_path(spark, "training"), "r1", "2024-01-01 00:00:00").drop("trained_at", "parameters")


def logged(spark, d) -> registry.PredictionRegistry:
    """Predictions in two versions, actuals late and corrected, batches out of order and one of them twice; two seasons compacted."""
    r = results(spark, d).select("game_id", F.col("season").cast("long").alias("season"), "week", "prediction", "other_prediction", "actual").persist()
    at = lambda day: F.to_timestamp(F.lit(f"2024-01-{day:02d} 00:00:00")).alias("logged_at")
    log = registry.PredictionRegistry(spark, scratch_path(spark, "registry"))
    first = r.select("game_id", "season", F.lit("m").alias("model"), "prediction", F.lit("v1").alias("model_version"), at(1))
    second = r.filter("week % 2 = 0").select("game_id", "season", F.lit("m").alias("model"), F.col("other_prediction").alias("prediction"), F.lit("v2").alias("model_version"), at(2))
    log.log_actuals(r.filter("week = 1").select("game_id", "season", (F.col("actual") + 1).alias("actual"), at(9)), "corrected")
    log.log_predictions(second, "second")
    log.log_predictions(first, "first")
    log.log_actuals(r.filter("week <= 6").select("game_id", "season", "actual", at(8)), "actuals")
    log.compact([1993, 1994], "compacted")
    log.log_predictions(first, "first")
    r.unpersist()
    return log


LOG_SQL = f"""{GAMES_SQL}, log AS (SELECT game_id, 'm' AS model, season, CASE WHEN week % 2 = 0 THEN 'v2' ELSE 'v1' END AS model_version, CASE WHEN week % 2 = 0 THEN other_prediction ELSE prediction END AS prediction, CASE WHEN week = 1 THEN actual + 1 WHEN week <= 6 THEN actual END AS actual_value FROM results)"""


@query("s19_prediction_registry", "SELECT *, prediction - actual_value AS prediction_error, CAST((prediction > 0) = (actual_value > 0) AS INTEGER) AS right_side FROM log", "prediction actual_value prediction_error", "game_id model season model_version right_side", LOG_SQL)
def _s19(spark, d):
    return logged(spark, d).read().select("game_id", "model", "season", "model_version", "prediction", "actual_value", "prediction_error", F.col("right_side").cast("int").alias("right_side"))


@query("s19_model_performance", "SELECT model, model_version, count(*) AS n, count(actual_value) AS graded, avg(abs(prediction - actual_value)) AS mae, avg(CAST(CAST((prediction > 0) = (actual_value > 0) AS INTEGER) AS DOUBLE)) AS hit_rate FROM log GROUP BY model, model_version", "mae hit_rate", "model model_version n graded", LOG_SQL)
def _s19_performance(spark, d):
    return registry.performance(logged(spark, d).read())


@query("s16_slice_switch", "SELECT season, count(*) AS games, sum(CASE WHEN season IN (1993, 1994) THEN home_score + 100 ELSE home_score END) AS points FROM games WHERE season <> 1995 GROUP BY season", "", "season games points", GAMES_SQL)
def _s16(spark, d):
    """Seasons written, two of them replaced and one ended in one step, old versions deleted."""
    g = games(spark, d).select("game_id", F.col("season").cast("long").alias("season"), "home_score")
    kept = registry.SliceTable(spark, scratch_path(spark, "slices"), ["season"])
    kept.write(g)
    kept.replace(g.filter("season in (1993, 1994)").withColumn("home_score", F.col("home_score") + 100), [(1993,), (1994,), (1995,)])
    kept.vacuum(1)
    return kept.read().groupBy("season").agg(F.count("*").alias("games"), F.sum("home_score").alias("points"))


DISCOVERED = {"orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"], "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]}


def _discovery_sql() -> str:
    one = []
    for t, columns in DISCOVERED.items():
        for i, c in enumerate(columns):
            v = f"CAST({c} AS VARCHAR)"
            kinds = " ".join(f"WHEN regexp_matches({v}, '{p.removeprefix('(?i)').removeprefix('(?s)')}'{', ' + chr(39) + 'i' + chr(39) if p.startswith('(?i)') else ''}) THEN '{k}'" for k, p in discovery.KINDS.items() if k != "string")
            sample = " || '|' || ".join(f"coalesce(min(md5({v}) || {v}) FILTER (substr(md5({v}), 1, 1) IN ({', '.join(chr(39) + x + chr(39) for x in part)}))[33:], '')" for part in discovery.THIRDS)
            one.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, {i + 1} AS position, CASE string_agg(DISTINCT CASE {kinds} ELSE 'string' END, '+' ORDER BY CASE {kinds} ELSE 'string' END) WHEN 'bigint' THEN 'bigint' WHEN 'boolean' THEN 'boolean' WHEN 'double' THEN 'double' WHEN 'bigint+double' THEN 'double' WHEN 'date' THEN 'date' WHEN 'timestamp' THEN 'timestamp' WHEN 'date+timestamp' THEN 'timestamp' ELSE 'string' END AS type, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS null_count, max(length({v})) AS longest, {sample} AS samples FROM {t}")
    return " UNION ALL ".join(one)


def discovered(spark, d):
    found = [discovery.discover(tables.as_text(tables.read_table(spark, d, t).select(*columns)), t) for t, columns in DISCOVERED.items()]
    return found[0].unionByName(found[1])


@query("s18_discovery", _discovery_sql(), "", "table_name column_name position type row_count null_count longest samples")
def _s18d(spark, d):
    return discovered(spark, d).withColumn("samples", F.array_join("samples", "|"))


@query("s18_ddl", f"SELECT table_name, 'CREATE TABLE ' || table_name || ' (' || string_agg('`' || column_name || '` ' || type || CASE WHEN null_count = 0 THEN ' NOT NULL' ELSE '' END, ', ' ORDER BY position) || ')' AS statement FROM ({_discovery_sql()}) GROUP BY table_name", "", "table_name statement")
def _s18ddl(spark, d):
    return discovery.ddl(discovered(spark, d))


@query("s8_corrupt_rows", "SELECT count(*) AS row_count, count(*) FILTER (o_orderkey % 97 = 7) AS bad_rows, CAST(sum(o_custkey) FILTER (o_orderkey % 97 <> 7) AS BIGINT) AS custkeys FROM orders", "", "row_count bad_rows custkeys")
def _s8c(spark, d):
    """Orders as JSON lines, some of them cut short; read with their lines kept where they don't parse."""
    path = scratch_path(spark, "lines")
    line = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus"))
    spark.read.parquet(f"{d}/orders.parquet").select(F.when(F.col("o_orderkey") % 97 == 7, F.substring(line, 1, 20)).otherwise(line).alias("value")).write.text(path)
    checked = discovery.read_checked(spark, path, "o_orderkey long, o_custkey long, o_orderstatus string", "json")
    sums = checked.filter("corrupt_record is null").agg(F.sum("o_custkey").alias("custkeys"))
    report = discovery.bad_row_report(checked).agg(F.sum("row_count").alias("row_count"), F.sum("bad_rows").alias("bad_rows"))
    return report.withColumn("_k", F.lit(1)).join(F.broadcast(sums.withColumn("_k", F.lit(1))), "_k").drop("_k")  # one row each


from panelforge.plans import marts as _marts  # noqa: E402, F401  registers its queries
