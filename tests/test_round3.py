"""Findings of round 3 on the event engine."""

import random

import pytest

from panelforge.operators import matchups, ratings

GAMES = "pool string, game_id int, season int, week int, home_team string, away_team string, home_score int, away_score int"


def test_consistency_passes_over_the_order_of_sums(spark):
    panel = spark.createDataFrame([("a", 1, 1, 0.1 + 0.2), ("b", 1, 1, 0.3), ("c", 1, 1, None), ("d", 1, 1, float("inf"))], "team string, season int, week int, v double")
    rows = [("a", "b", 1, 2, 0.3, 0.1 + 0.2), ("a", "c", 1, 2, 0.3, None), ("b", "a", 1, 2, 0.3 + 1e-6, 0.3), ("a", "c", 1, 2, 0.3, 1.0), ("d", "a", 1, 2, 1.0, 0.3), ("d", "a", 1, 2, float("inf"), 0.3)]
    mart = spark.createDataFrame(rows, "home_team string, away_team string, season int, week int, home_v double, away_v double")
    assert [tuple(r) for r in matchups.consistency(mart, panel, "team", "season", "week", "v").collect()] == [(1, 6, 3)]


def test_elo_settles_block_by_block(spark):
    r = random.Random(3)
    rows = [("p" if i % 3 else None, i, 1 + i // 40, i % 40 // 5 or None, *r.sample("abcdef", 2), r.randrange(30), r.randrange(30)) for i in range(120)]
    df = spark.createDataFrame(rows, GAMES)
    at_once, in_blocks = ({x["game_id"]: x for x in ratings.elo_history(df, block_games=n).collect()} for n in (1000, 40))
    assert len(at_once) == len(in_blocks) == 120
    for i, x in at_once.items():
        for c in ("home_pre", "away_pre", "home_post", "away_post"):
            assert in_blocks[i][c] == pytest.approx(x[c], abs=1e-7)
    assert ratings.elo_history(df.filter("game_id < 0")).count() == 0
    with pytest.raises(ValueError, match="repeats"):
        ratings.elo_history(df.union(df.limit(1)))
