"""Event and matchup tables over the order tables, so that the operators run on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.panels import EventSpec, classified, rolling, weekly_panel
from panelforge.sources.tables import read_table

SPEC = EventSpec(order=("drive", "part", "supp", "price"))
TASK_ROWS = 500_000  # events that a task of the joins holds

PLAYS_SQL = """
p AS (
  SELECT l_orderkey AS game_id, l_linenumber AS drive, l_partkey AS part, l_suppkey AS supp, l_extendedprice AS price, sn.n_name AS team, cn.n_name AS opp,
    CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS week,
    CASE WHEN l_quantity = 13 THEN NULL ELSE (l_extendedprice * (1 - l_discount) - 40000) / 39989 END AS epa, l_quantity AS yards,
    CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 0 END AS is_pass, CASE WHEN l_linenumber IN (2, 4) THEN 1 ELSE 0 END AS is_rush,
    CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS touchdown, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS turnover,
    CASE WHEN l_linestatus = 'F' AND l_quantity > 45 THEN 1 ELSE 0 END AS field_goal,
    CASE WHEN l_quantity = 17 THEN NULL ELSE CAST(l_quantity * 2 AS INTEGER) END AS yardline, CAST(l_linenumber AS INTEGER) AS down,
    CAST(round(l_tax * 200) AS INTEGER) + 1 AS togo, CAST(p_size - 25 AS INTEGER) AS margin, CAST(l_partkey % 900 AS INTEGER) AS half_seconds, 75 AS start_yardline,
    CASE WHEN l_linenumber = 3 AND l_quantity > 25 THEN 1 ELSE 0 END AS third_conv, CASE WHEN l_linenumber % 2 = 1 AND l_quantity <= 3 THEN 1 ELSE 0 END AS sack,
    CASE WHEN l_quantity = 50 THEN NULL WHEN l_quantity = 49 THEN 'qb_kneel' WHEN l_quantity = 48 THEN 'no_play' WHEN l_linenumber % 2 = 1 THEN 'pass' ELSE 'run' END AS kind,
    CAST(p_size % 25 AS INTEGER) AS wind, CAST((p_size * 2) % 100 AS INTEGER) AS temp, CASE WHEN l_linestatus = 'O' THEN 'dome' ELSE 'outdoors' END AS roof
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN part ON l_partkey = p_partkey
), plays AS (
  SELECT *, CASE WHEN epa > 0 THEN 1 ELSE 0 END AS is_success, CASE WHEN (is_pass = 1 AND yards >= 15) OR (is_rush = 1 AND yards >= 10) THEN 1 ELSE 0 END AS is_explosive FROM p
)"""

GAMES_SQL = """
games AS (
  SELECT team AS home_team, opp AS away_team, season, week, concat_ws('_', CAST(season AS VARCHAR), CAST(week AS VARCHAR), opp, team) AS game_id,
    CAST(CAST(sum(yards) AS BIGINT) % 45 AS BIGINT) AS home_score, CAST(sum(part) % 40 AS BIGINT) AS away_score,
    14 * avg(epa) AS prediction, CAST(sum(supp) % 29 AS DOUBLE) / 2 - 7 AS other_prediction, CASE WHEN sum(part) % 11 = 0 THEN NULL ELSE CAST(sum(part) % 31 AS DOUBLE) / 2 - 7.5 END AS line,
    max(wind) AS wind, max(temp) AS temp, max(roof) AS roof
  FROM plays WHERE team <> opp GROUP BY team, opp, season, week
), results AS (
  SELECT *, CAST(home_score - away_score AS DOUBLE) AS actual FROM games WHERE prediction IS NOT NULL
)"""


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as events: the supplier's nation plays the customer's, season and week by order date.

    The number of partitions follows the rows, so that a task's memory doesn't. The last join is by game, so what
    groups by game needs no other shuffle.
    """
    t = lambda n: read_table(spark, sf_dir, n)
    tasks = max(1, -(-t("lineitem").count() // TASK_ROWS))
    nation = t("nation").select("n_nationkey", "n_name")
    customers = t("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("opp"))
    suppliers = t("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("team"))
    orders = t("orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week"))
    orders = orders.repartition(tasks, "o_custkey").join(customers.repartition(tasks, "c_custkey"), F.col("o_custkey") == F.col("c_custkey")).repartition(tasks, "o_orderkey")
    parts = t("part").select("p_partkey", "p_size").repartition(tasks, "p_partkey")
    rows = t("lineitem").repartition(tasks, "l_partkey").join(parts, F.col("l_partkey") == F.col("p_partkey")).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.repartition(tasks, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    flag = lambda e: F.expr(f"case when {e} then 1 else 0 end")
    return classified(rows.select(
        F.col("l_orderkey").alias("game_id"), F.col("l_linenumber").alias("drive"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_extendedprice").alias("price"), "team", "opp", "season", "week",
        F.expr("case when l_quantity = 13 then null else (l_extendedprice * (1 - l_discount) - 40000) / 39989 end").alias("epa"), F.col("l_quantity").alias("yards"),
        flag("l_linenumber % 2 = 1").alias("is_pass"), flag("l_linenumber in (2, 4)").alias("is_rush"), flag("l_returnflag = 'A'").alias("touchdown"), flag("l_returnflag = 'R'").alias("turnover"), flag("l_linestatus = 'F' and l_quantity > 45").alias("field_goal"),
        F.expr("case when l_quantity = 17 then null else cast(l_quantity * 2 as int) end").alias("yardline"), F.col("l_linenumber").cast("int").alias("down"), F.expr("cast(round(l_tax * 200) as int) + 1").alias("togo"),
        F.expr("cast(p_size - 25 as int)").alias("margin"), F.expr("cast(l_partkey % 900 as int)").alias("half_seconds"), F.lit(75).alias("start_yardline"),
        flag("l_linenumber = 3 and l_quantity > 25").alias("third_conv"), flag("l_linenumber % 2 = 1 and l_quantity <= 3").alias("sack"),
        F.expr("case when l_quantity = 50 then null when l_quantity = 49 then 'qb_kneel' when l_quantity = 48 then 'no_play' when l_linenumber % 2 = 1 then 'pass' else 'run' end").alias("kind"),
        F.expr("cast(p_size % 25 as int)").alias("wind"), F.expr("cast((p_size * 2) % 100 as int)").alias("temp"), F.expr("case when l_linestatus = 'O' then 'dome' else 'outdoors' end").alias("roof"),
    ), SPEC)


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A matchup per pair of nations and week, with scores, two predictions and a line."""
    p = plays(spark, sf_dir).filter("team <> opp")
    return p.groupBy(F.col("team").alias("home_team"), F.col("opp").alias("away_team"), "season", "week").agg(
        F.expr("cast(sum(yards) as bigint) % 45").alias("home_score"), F.expr("sum(part) % 40").alias("away_score"), (14 * F.avg("epa")).alias("prediction"),
        F.expr("cast(sum(supp) % 29 as double) / 2 - 7").alias("other_prediction"), F.expr("case when sum(part) % 11 = 0 then null else cast(sum(part) % 31 as double) / 2 - 7.5D end").alias("line"),
        F.max("wind").alias("wind"), F.max("temp").alias("temp"), F.max("roof").alias("roof"),
    ).withColumn("game_id", F.concat_ws("_", F.col("season").cast("string"), F.col("week").cast("string"), "away_team", "home_team"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games(spark, sf_dir).filter("prediction is not null").withColumn("actual", (F.col("home_score") - F.col("away_score")).cast("double"))


#: Rolling columns of both panels: name, and the aggregate over the entity's last four periods.
OFFENSE = {
    "value_l4": "avg(value_per_play)", "pass_value_l4": "avg(pass_value)", "rush_value_l4": "avg(rush_value)", "success_l4": "avg(success_rate)", "pass_success_l4": "avg(pass_success_rate)",
    "rush_success_l4": "avg(rush_success_rate)", "explosive_l4": "avg(explosive_rate)", "third_l4": "avg(third_rate)", "near_td_l4": "avg(near_td_rate)", "turnover_l4": "avg(turnover_rate)",
    "gain_l4": "avg(gain_per_play)", "points_l4": "avg(approx_points_per_drive)", "plays_l4": "sum(plays)", "turnovers_l4": "sum(turnovers)",
}
DEFENSE = OFFENSE | {"sack_l4": "avg(sack_rate)"}


def offense(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = weekly_panel(plays(spark, sf_dir), SPEC)
    return rolling(panel, OFFENSE, "team", "season", "week").withColumn("trend", F.col("value_per_play") - F.col("value_l4"))


def defense(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = weekly_panel(plays(spark, sf_dir), SPEC, by="opp")
    return rolling(panel, DEFENSE, "team", "season", "week")
