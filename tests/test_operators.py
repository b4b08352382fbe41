import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from panelforge.operators import backtest, conditions, folds, learn, matchups, panels, quality, ratings
from panelforge.sources import tables
from panelforge.streaming.refresh import refresh


def test_rolling_frames_and_reset(spark):
    df = spark.createDataFrame([("a", s, w, float(10 * s + w)) for s in (1, 2) for w in (1, 2, 3)], "team string, season int, week int, v double")
    run = lambda **k: [r["m"] for r in panels.rolling(df, {"m": "avg(v)"}, "team", "season", "week", periods=2, **k).orderBy("season", "week").collect()]
    assert run() == [11.0, 11.5, 12.5, 17.0, 21.5, 22.5]
    assert run(reset=True) == [11.0, 11.5, 12.5, 21.0, 21.5, 22.5]
    assert run(reset=True, prior_only=True) == [None, 11.0, 11.5, None, 21.0, 21.5]


def test_null_ranks_as_largest(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 2.0), ("d", 1.0)], "t string, v double").withColumns({"s": F.lit(1), "w": F.lit(1)})
    got = {r["t"]: (r["up"], r["down"]) for r in panels.period_ranks(df, {"up": ("v", True), "down": ("v", False)}, "s", "w").collect()}
    assert got == {"a": (1, 3), "b": (4, 1), "c": (3, 2), "d": (1, 3)}


def test_lag_never_sees_the_current_period_and_asof_bridges_a_bye(spark):
    panel = spark.createDataFrame([("a", 1, 1, 5.0), ("a", 1, 3, 7.0), ("b", 1, 1, 1.0), ("b", 1, 2, 2.0)], "team string, season int, week int, v double")
    games = spark.createDataFrame([("g", 1, 3, "a", "b")], "game_id string, season int, week int, home_team string, away_team string")
    row = matchups.lagged_sides(games, panel, "team", "season", "week", ["v"]).first()
    assert (row["home_v"], row["away_v"]) == (None, 2.0)
    row = matchups.lagged_sides(games, panel, "team", "season", "week", ["v"], asof=True).first()
    assert (row["home_v"], row["away_v"]) == (5.0, 2.0)


def test_betting_metrics_with_push_and_no_bets(spark):
    df = spark.createDataFrame([(5.0, 4.0, 0.0), (5.0, 0.0, 0.0), (-5.0, 3.0, 0.0), (1.0, 1.0, None)], "prediction double, actual double, line double")
    r = backtest.roi(df, edge=3.0).first()
    assert (r["bets"], r["wins"], r["pushes"], r["losses"]) == (3, 1, 1, 1)
    assert r["profit"] == pytest.approx(100 / 110 - 1)
    assert tuple(backtest.ats_accuracy(df, edge=50.0).first()) == (0.5, 0)
    assert backtest.by_confidence(df, cut=9.0).filter("side = 'high'").first()["n"] == 0


def test_walk_forward_refuses_too_few_seasons(spark):
    df = spark.createDataFrame([(s,) for s in range(2000, 2005)], "season int")
    got = {(r["fold"], r["role"]): r["n"] for r in folds.walk_forward(df, "season", 3, expanding=False).groupBy("fold", "role").agg(F.count("*").alias("n")).collect()}
    assert got == {(2003, "train"): 3, (2003, "test"): 1, (2004, "train"): 3, (2004, "test"): 1}
    with pytest.raises(ValueError, match="too few"):
        folds.walk_forward(df, "season", 5)


GAMES = "pool string, game_id long, season long, week long, home_team string, away_team string, home_score long, away_score long"


def test_elo_is_zero_sum_and_ties_move_nothing(spark):
    df = spark.createDataFrame([("p", 1, 1, 1, "a", "b", 20, 10), ("p", 2, 1, 2, "b", "a", 10, 10), ("p", 3, 2, 1, "a", "c", 0, 3)], GAMES)
    h = {r["game_id"]: r for r in ratings.elo_history(df).collect()}
    assert h[1]["home_post"] + h[1]["away_post"] == pytest.approx(3000)
    damp = 2.2 / (48 * 0.001 + 2.2)
    assert h[1]["home_post"] == pytest.approx(1500 + 20 * math.log(11) * damp * (1 - 1 / (1 + 10 ** (-48 / 400))))
    assert (h[2]["home_post"], h[2]["away_post"]) == (h[2]["home_pre"], h[2]["away_pre"])
    assert h[3]["home_pre"] == pytest.approx(h[2]["away_post"] * 0.67 + 1505 * 0.33)
    assert h[3]["away_pre"] == 1500
    assert ratings.current_ratings(ratings.elo_history(df)).count() == 3


def test_ridge_strength_solves_its_normal_equations(spark):
    rows = [("p", i, 1, i, a, b, x, y) for i, (a, b, x, y) in enumerate([("a", "b", 10, 0), ("b", "c", 8, 0), ("a", "c", 15, 0), ("c", "a", 0, 0), ("b", "a", 1, 0)])]
    got = {r["team"]: (r["strength"], r["home_advantage"]) for r in ratings.ridge_strength(spark.createDataFrame(rows, GAMES)).collect()}
    theta, h = {t: v[0] for t, v in got.items()}, got["a"][1]
    left = [r[6] - r[7] - theta[r[4]] + theta[r[5]] - h for r in rows]
    variance = sum(x * x for x in left) / len(rows)
    for t in theta:
        assert sum(x * ((r[4] == t) - (r[5] == t)) for x, r in zip(left, rows)) == pytest.approx(variance / 25 * theta[t], rel=1e-3)
    assert sum(left) == pytest.approx(variance * (h - 2.5), rel=1e-3)
    assert ratings.ridge_strength(spark.createDataFrame([], GAMES)).count() == 0


def test_learned_predictors(spark):
    r = random.Random(2)
    rows = [(i, x := r.uniform(-2, 2), y := r.uniform(-2, 2), 3 * x - y, 3 * x + r.gauss(0, 0.1), 5.0) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, x double, y double, target double, p double, flat double")
    model = learn.boosted_trees(df, ["x", "y"], rounds=20)
    error = model.transform(df).agg(F.avg(F.abs(F.col("prediction") - F.col("target")))).first()[0]
    assert error < 0.8
    assert [x["feature"] for x in learn.importances(model, ["x", "y"], spark).collect()] == ["x", "y"]
    both, weights = learn.stacked(df, ["p", "y", "flat"], "target")
    assert {w["model"] for w in weights.collect()} == {"p", "y"}
    assert sum(w["weight"] for w in weights.collect()) == pytest.approx(1)
    assert both.agg(F.avg(F.abs(F.col("stacked") - F.col("target")))).first()[0] < 0.2
    one = learn.contributions(df, {"p": 0.25}).first()
    assert one["p_part"] == pytest.approx(one["p"] * 0.25)


def test_elo_predictions_fall_back_to_the_initial_rating(spark):
    games = spark.createDataFrame([("p", "a", "b"), ("p", "b", "zz")], "pool string, home_team string, away_team string")
    known = spark.createDataFrame([("p", "a", 1600.0), ("p", "b", 1500.0)], "pool string, team string, rating double")
    got = {x["home_team"]: x for x in ratings.elo_predictions(games, known).collect()}
    assert got["a"]["spread"] == pytest.approx(148 / 25)
    assert got["b"]["home_win_probability"] == pytest.approx(1 / (1 + 10 ** (-48 / 400)))


def test_staging_projections(spark, tmp_path):
    raw = spark.createDataFrame([("1.0", "2.5", "1.0", "2024-09-05", "KC"), ("x", None, None, "bad", None)], "GAME_ID string, Spread string, flag string, Day string, team string")
    got = tables.projected(raw, {"game_id": "int", "spread": "double", "flag": "flag", "day": "date"})
    assert [tuple(r) for r in got.collect()] == [(1, 2.5, 1, dt.date(2024, 9, 5), "KC"), (None, None, 0, None, None)]
    with pytest.raises(ValueError, match="missing"):
        tables.projected(raw, {"none": "int"})
    (tmp_path / "a.json").write_text('{"a": 1, "b": "x"}\nnot json\n{"a": 2}\n')
    rows = tables.read_json(spark, str(tmp_path / "a.json"), "a int, b string").collect()
    assert sorted((r["a"] or 0, r["b"] or "") for r in rows) == [(0, ""), (1, "x"), (2, "")]


def test_tables_grow_columns_and_broken_years_are_passed_over(spark, tmp_path):
    a = spark.createDataFrame([(1,)], "id int")
    assert tables.ensure_table(spark, a.withColumn("s", F.lit("x")), f"{tmp_path}/new").columns == ["id", "s"]
    a.write.parquet(f"{tmp_path}/old")
    assert tables.ensure_table(spark, a.withColumn("s", F.lit("x")), f"{tmp_path}/old").first().asDict() == {"id": 1, "s": None}
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no parquet")
    log = tables.load(spark, {"t": {"2020": f"{tmp_path}/old"}, "u": {"2020": f"{tmp_path}/bad"}}, f"{tmp_path}/out")
    assert {(r["dataset"], r["success"], r["rows"]) for r in log.collect()} == {("t", True, 1), ("u", False, 0)}
    assert tables.load_totals(log).first().asDict() | {"seconds": 0} == {"datasets": 2, "loaded": 1, "rows": 1, "seconds": 0}


def test_named_slices_are_replaced_or_emptied(spark, tmp_path):
    df = spark.createDataFrame([(2020, 1, "a"), (2020, 2, "b"), (2021, 1, "c")], "season int, week int, v string")
    tables.write_slices(df, f"{tmp_path}/t", ["season", "week"])
    new = spark.createDataFrame([(2020, 1, "z"), (2021, 1, "not named")], "season int, week int, v string")
    tables.replace_slices(new, f"{tmp_path}/t", ["season", "week"], [(2020, 1), (2020, 2)])
    assert sorted(r["v"] for r in spark.read.parquet(f"{tmp_path}/t").collect()) == ["c", "z"]


def test_mart_reads(spark):
    g = spark.createDataFrame([("b", 2020, 2, 1, 2), ("a", 2020, 1, 3, 4), ("c", 2020, 1, None, None), ("d", 2019, 1, 1, 1)], "game_id string, season int, week int, home_score int, away_score int")
    assert [r["game_id"] for r in tables.training_read(g, 2020, ["week", "game_id"]).collect()] == ["a", "b"]
    assert [r["game_id"] for r in tables.training_read(g, 2019, ["season", "week"], limit=1).collect()] == ["d"]
    assert [r["game_id"] for r in tables.inference_read(g, 2020, 1, ["game_id"]).collect()] == ["a", "c"]
    assert [r["game_id"] for r in matchups.upcoming(g).collect()] == ["c"]


def test_new_files_replace_their_slices_once(spark, tmp_path):
    a = spark.createDataFrame([(2020, 1), (2021, 2)], "season int, v int")
    run = lambda: refresh(spark, f"{tmp_path}/in", "season int, v int", lambda df: df, f"{tmp_path}/out", ["season"], f"{tmp_path}/cp").awaitTermination()
    a.write.parquet(f"{tmp_path}/in")
    run()
    a.filter("season = 2021").withColumn("v", F.lit(9)).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select("season", "v").collect())) == [(2020, 1), (2021, 9)]


def test_condition_impact_falls_back_to_the_season(spark):
    rows = [("a", 1, 0, "Normal", 3, 9, 0.1, 0.5, 0), ("a", 1, 1, "Severe", 2, 9, 0.0, 0.5, 0), ("b", 1, 0, "Normal", 3, 9, 0.2, 0.5, 0)]
    split = spark.createDataFrame(rows, "team string, season int, adverse int, severity string, games long, plays long, value double, success double, turnovers long")
    got = {r["team"]: r for r in conditions.condition_impact(split, ["team", "season"], "season").collect()}
    assert got["a"]["value_impact"] == pytest.approx(-0.1)
    assert got["b"]["resistance"] == "Insufficient Data"
    assert got["b"]["expected_impact"] == pytest.approx(-0.1)


def test_checks_report_failures(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("z", 9)], "k string, v int")
    got = {(r["check"], r["column"]): r["failures"] for r in quality.report(quality.not_null(df, ["k"], "t"), quality.unique(df, ["k", "v"], "t", concat=True), quality.accepted_values(df, {"k": ["a"]}, "t"), quality.in_range(df, {"v": (0, 5)}, "t")).collect()}
    assert got == {("not_null", "k"): 1, ("unique", "k+v"): 1, ("accepted_values", "k"): 1, ("range", "v"): 1}


def test_slices_are_replaced_and_years_joined(spark, tmp_path):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    a.write.parquet(f"{tmp_path}/2020")
    a.withColumn("more", F.lit(1)).write.parquet(f"{tmp_path}/2021")
    log = tables.load(spark, {"t": {"2020": f"{tmp_path}/2020", "2021": f"{tmp_path}/2021", "2022": f"{tmp_path}/none"}, "lost": {"2020": f"{tmp_path}/none"}}, f"{tmp_path}/out")
    assert {(r["dataset"], r["success"], r["rows"]) for r in log.collect()} == {("t", True, 2), ("lost", False, 0)}
    tables.write_slices(tables.with_lineage(tables.as_text(a.unionByName(a)), "2021"), f"{tmp_path}/out/t", ["source_year"])
    assert spark.read.parquet(f"{tmp_path}/out/t").groupBy("source_year").count().orderBy("source_year").collect()[0]["count"] == 1


def test_rejects_and_name_matching(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "b")], "N string, s string")
    good, bad = tables.split_rejects(df, {"N": "int"})
    assert (good.count(), bad.count()) == (1, 1)
    target = spark.createDataFrame([], "n int, extra string")
    assert tables.matched_by_name(good, target).first().asDict() == {"n": 1, "extra": None}
