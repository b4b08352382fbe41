"""Findings of round 4 on the event engine."""

import os
import random

import pytest

from panelforge.operators import folds, matchups, ratings
from panelforge.plans import queries

DATA = "/root/testdata/sf0.001"

GAMES = "pool string, game_id int, season int, week int, home_team string, away_team string, home_score int, away_score int"


def test_elo_settles_across_parts_and_blocks(spark):
    r = random.Random(4)
    rows = [("p" if i % 3 else None, i, 1 + i // 130, i % 130 // 9 or None, *r.sample("abcdefghij", 2), r.randrange(30), r.randrange(30)) for i in range(390)]
    df = spark.createDataFrame(rows, GAMES)
    want, in_blocks = ({x["game_id"]: x for x in ratings.elo_history(df, block_games=n, part_games=m).collect()} for n, m in ((1000, 1000), (150, 20)))
    assert len(want) == len(in_blocks) == 390
    for i, x in want.items():
        for c in ("home_pre", "away_pre", "home_post", "away_post"):
            assert in_blocks[i][c] == pytest.approx(x[c], abs=1e-8)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_trees_learn_and_score_from_staged_rows(spark):
    """Events were joined anew for every pass over the rows, and their shuffles held to the end."""
    scores = queries.QUERIES["m5_gbt_scores"](spark, DATA)
    assert not [f for f in scores.inputFiles() if "lineitem" in f or "orders" in f]
    sides = matchups.lagged_sides(queries.games(spark, DATA), queries.offense(spark, DATA), "team", "season", "week", queries.FEATURES)
    frame = folds.holdout(matchups.training_frame(sides, queries.SIDES.split(), "spread"), "season").filter("role = 'test'")
    assert sorted((x["game_id"], x["target"]) for x in scores.collect()) == sorted((x["game_id"], x["target"]) for x in frame.select("game_id", "target").collect())
