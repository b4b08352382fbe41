"""Ratings, training runs, versioned tables and quantiles against plain versions."""

import math
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import backtest, matchups, ratings, training
from panelforge.sources.registry import PredictionRegistry, SliceTable
from panelforge.sources.scratch import scratch_path

GAMES = "pool string, game_id long, season long, week long, home_team string, away_team string, home_score long, away_score long"


def plain_elo(rows, k=20, home=48, initial=1500, regress=0.33, mean=1505):
    """One game after the other; game_id -> ratings before and after."""
    out, state, season = {}, {}, {}
    for pool, gid, s, w, a, b, x, y in sorted(rows, key=lambda r: (r[0], r[2], r[3], r[1])):
        r = state.setdefault(pool, {})
        if season.get(pool) not in (None, s):
            for t in r:
                r[t] = r[t] * (1 - regress) + mean * regress
        season[pool] = s
        p, q = r.get(a, initial), r.get(b, initial)
        gap, margin = p - q + home, x - y
        expected = 1 / (1 + 10 ** (-gap / 400))
        won = 0.5 if margin == 0 else float(margin > 0)
        move = k * math.log(abs(margin) + 1) * (2.2 / (gap * 0.001 + 2.2) if gap > 0 and margin > 0 else 1) * (won - expected)
        r[a], r[b] = p + move, q - move
        out[pool, gid] = (p, q, p + move, q - move)
    return out


def test_elo_equals_the_ordered_fold(spark):
    r = random.Random(3)
    rows, n = [], 0
    for pool in ("x", "y", "alone"):
        for season in (2001, 2002, 2005):  # a team may miss a season, and a week may hold several of its games
            for week in range(1, 9):
                for _ in range(3 if pool != "alone" else 0):
                    a, b = r.sample("ABCDEFG" if season != 2002 else "ABCD", 2)
                    n += 1
                    rows.append((pool, n, season, week, a, b, r.randint(0, 40), r.randint(0, 40)))
    want = plain_elo(rows)
    odd = [("x", 900, 2001, 1, "A", "B", None, 3), ("x", 901, 2001, 1, "A", "A", 1, 3), ("x", 902, 2001, 1, None, "A", 1, 3)]
    got = {(h["pool"], h["game_id"]): (h["home_pre"], h["away_pre"], h["home_post"], h["away_post"]) for h in ratings.elo_history(spark.createDataFrame(rows + odd, GAMES)).collect()}
    assert got.keys() == want.keys()
    assert max(abs(x - y) for g in want for x, y in zip(got[g], want[g])) < 1e-8
    assert ratings.elo_history(spark.createDataFrame([], GAMES)).count() == 0
    with pytest.raises(ValueError):
        ratings.elo_history(spark.createDataFrame(rows[:1] * 2, GAMES))


def test_out_of_fold_ridge_equals_numpy_and_never_sees_its_season(spark):
    r = np.random.default_rng(1)
    rows = [(int(s), *map(float, r.normal(size=3)), float(r.normal())) for s in range(2000, 2007) for _ in range(40)]
    df = spark.createDataFrame(rows + [(2003, None, 1.0, 1.0, 1.0), (2006, 1.0, 2.0, 3.0, None)], "season long, a double, b double, c double, y double")
    models = {"all": ["a", "b", "c"], "flat": ["a"]}
    found = training.fold_coefficients(df, "season", models, "y", alpha=2.0, least=3)
    assert sorted({x["fold"] for x in found.collect()}) == [2003, 2004, 2005, 2006]
    got = training.out_of_fold(df, "season", models, found).filter("season = 2005").orderBy("a", "b").collect()
    train = np.array([x for x in rows if x[0] < 2005])
    x, y = train[:, 1:4], train[:, 4]
    z = (x - x.mean(0)) / x.std(0)
    beta = np.linalg.solve(z.T @ z + 2.0 * np.eye(3), z.T @ (y - y.mean()))
    test = np.array(sorted(t for t in rows if t[0] == 2005))[:, 1:4]
    want = y.mean() + (test - x.mean(0)) / x.std(0) @ beta
    assert np.allclose([g["all_prediction"] for g in got], want)
    moved = training.fold_coefficients(df.withColumn("y", F.when(F.col("season") >= 2005, 100.0).otherwise(F.col("y"))), "season", models, "y", 2.0, 3).filter("fold = 2005 and model = 'all'").first()
    assert np.allclose(moved["beta"], found.filter("fold = 2005 and model = 'all'").first()["beta"])


def test_training_run_keeps_its_tables_and_is_repeatable(spark):
    r = np.random.default_rng(2)
    df = spark.createDataFrame([(i, int(2000 + i % 8), float(x), float(2 * x + r.normal())) for i, x in enumerate(r.normal(size=400))], "game_id long, season long, a double, y double")
    out = scratch_path(spark, "run")
    first = training.training_run(df, "season", {"line": ["a"]}, "y", out, "one", "2024-01-01 00:00:00").first()
    assert first == training.training_run(df, "season", {"line": ["a"]}, "y", out, "one", "2024-01-01 00:00:00").first()
    assert first["folds"] == 5 and first["best_mae"] < 1.2 and first["stacked_brier"] < 0.25
    assert spark.read.parquet(f"{out}/weights").filter("weight = 1").count() == 4
    told = spark.read.parquet(f"{out}/diagnostics").filter("season is null and model = 'line_prediction'").first()
    rows = spark.read.parquet(f"{out}/predictions").collect()
    assert told["n"] == len(rows) == 200 and abs(told["mae"] - np.mean([abs(x["line_prediction"] - x["y"]) for x in rows])) < 1e-9


def test_readers_see_a_table_before_or_after_a_switch_and_never_between(spark):
    rows = lambda *xs: spark.createDataFrame(list(xs), "season long, kind string, v long")
    t = SliceTable(spark, scratch_path(spark, "slices"), ["season", "kind"])
    seen = lambda v=None: sorted((tuple(r) for r in t.read(v).select("season", "kind", "v").collect()), key=repr)
    t.write(rows((1, "a/b=c", 1), (1, None, 2), (2, "a", 3)))
    before = seen()
    held = t.read()
    staged = t.stage(rows((1, None, 20)))
    assert seen() == before  # written, not switched
    t.switch(staged, [(2, "a")])
    assert seen() == [(1, "a/b=c", 1), (1, None, 20)]
    assert sorted((tuple(r) for r in held.select("season", "kind", "v").collect()), key=repr) == before == seen(1)  # who began before goes on with the old files
    with pytest.raises(ValueError):
        t.replace(rows((9, "z", 1)), [(1, "a/b=c")])
    t.stage(rows((7, "lost", 1)))  # a writer that failed
    t.replace(rows(), [(1, "a/b=c")])
    t.vacuum(1)
    assert seen() == [(1, None, 20)] and len(t.versions()) == 1
    assert t.replace(rows(), [(1, None)]) and seen() == []


def test_registry_gives_the_same_table_for_replayed_and_late_batches(spark):
    p = "game_id string, season long, model string, prediction double, model_version string, logged_at string"
    stamped = lambda rows, schema: spark.createDataFrame(rows, schema).withColumn("logged_at", F.col("logged_at").cast("timestamp"))
    batches = {
        "p1": stamped([("g1", 1, "m", 3.0, "v1", "2024-01-01"), ("g2", 2, "m", -1.0, "v1", "2024-01-01")], p), "p2": stamped([("g1", 1, "m", -4.0, "v2", "2024-01-02")], p),
        "a1": stamped([("g1", 1, 5.0, "2024-01-03")], "game_id string, season long, actual double, logged_at string"), "a2": stamped([("g1", 1, 6.0, "2024-01-04")], "game_id string, season long, actual double, logged_at string"),
    }

    def table(order, compact=False):
        log = PredictionRegistry(spark, scratch_path(spark, f"registry-{uuid.uuid4().hex[:4]}"))
        for i, b in enumerate(order):
            (log.log_predictions if b[0] == "p" else log.log_actuals)(batches[b], b)
            if compact and i == 2:
                log.compact([1, 2], "compacted")
        return sorted((r["game_id"], r["model"], r["prediction"], r["model_version"], r["actual_value"], r["prediction_error"], r["right_side"]) for r in log.read().collect())

    want = [("g1", "m", -4.0, "v2", 6.0, -10.0, False), ("g2", "m", -1.0, "v1", None, None, None)]
    assert table(["p1", "p2", "a1", "a2"]) == table(["a2", "p2", "a1", "p1", "p2", "a2"]) == table(["p2", "a2", "p1", "a1", "p1"], compact=True) == want


def test_quantiles_are_exact_on_skewed_and_tied_values(spark):
    r = np.random.default_rng(5)
    levels = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    for v in (np.concatenate((r.normal(size=3000), np.full(2000, 0.25), 10 ** r.uniform(0, 12, 500))), np.array([2.0]), np.array([1.0, 2.0])):
        df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),)], "x double")
        got = {row["level"]: row["value"] for row in backtest.exact_quantiles(df, "x", levels).collect()}
        assert np.allclose([got[p] for p in levels], np.quantile(v, levels), rtol=1e-12)
    assert backtest.exact_quantiles(spark.createDataFrame([], "x double"), "x", levels).count() == 0


def test_consistency_finds_planted_mismatches(spark):
    panel = spark.createDataFrame([("A", 1, 1, 0.5), ("B", 1, 1, 0.25)], "team string, season int, week int, v double")
    mart = spark.createDataFrame([("A", "B", 1, 2, 0.5, 0.25), ("B", "A", 1, 2, 0.3, 0.5), ("A", "C", 1, 2, 0.5, 9.0), ("A", "C", 1, 2, 0.5, None)], "home_team string, away_team string, season int, week int, home_v double, away_v double")
    assert [tuple(r) for r in matchups.consistency(mart, panel, "team", "season", "week", "v").collect()] == [(1, 4, 2)]


def test_strengths_equal_the_dense_solution_and_predict(spark):
    r = np.random.default_rng(5)
    teams = [f"t{i}" for i in range(30)]
    rows = []
    for i in range(200):  # one team plays a third of all games, one never scores
        a, b = ("t0", teams[1 + i % 29]) if i % 3 == 0 else tuple(r.choice(teams[:29], 2, replace=False))
        rows.append(("p", i, 2001, 1, str(a), str(b), int(r.integers(0, 40)), int(r.integers(0, 30))))
    odd = [("p", 900, 2001, 1, "t1", "unseen", None, 3), ("p", 901, 2001, 1, "t1", "t1", 30, 3), ("p", 902, 2001, 1, None, "t1", 1, 3)]
    df = spark.createDataFrame(rows + odd, GAMES)
    found = ratings.ridge_strength(df).persist()
    got = {x["team"]: x["strength"] for x in found.collect()}
    names = sorted(got)
    assert got["unseen"] == 0 and "t1" in got and None not in got
    x = np.zeros((len(rows), len(names) + 1))
    for i, g in enumerate(rows):
        x[i, names.index(g[4])], x[i, names.index(g[5])], x[i, -1] = 1, -1, 1
    y = np.array([g[6] - g[7] - 2.5 for g in rows], float)
    sigma2 = (y @ y) / len(y)
    for _ in range(100):
        beta = np.linalg.solve(x.T @ x + sigma2 * np.diag([1 / 25] * len(names) + [1.0]), x.T @ y)
        sigma2 = np.sum((y - x @ beta) ** 2) / len(y)
    assert max(abs(got[t] - beta[i]) for i, t in enumerate(names)) < 1e-4
    assert found.first()["home_advantage"] == pytest.approx(2.5 + beta[-1], abs=1e-4)
    games = spark.createDataFrame([("t0", "t1"), ("t0", "new"), (None, "t1")], "home_team string, away_team string")
    spread = {(p["home_team"], p["away_team"]): p["strength_spread"] for p in ratings.strength_predictions(games, found).collect()}
    home = 2.5 + beta[-1]
    want = {("t0", "t1"): got["t0"] - got["t1"] + home, ("t0", "new"): got["t0"] + home, (None, "t1"): home - got["t1"]}
    assert spread.keys() == want.keys() and all(spread[k] == pytest.approx(want[k], abs=1e-4) for k in want)
