"""Panels whose tasks hold a bounded number of rows and no sums of every subgroup."""

import random

from pyspark.sql import functions as F

from panelforge.operators.panels import EventSpec, situational_panel
from panelforge.plans import adapter

SF = "/root/testdata/sf0.001"


def aggregates(df):
    return df._jdf.queryExecution().executedPlan().toString().count("HashAggregate(")


def test_partitions_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(adapter, "TASK_ROWS", 500)
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert adapter.plays(spark, SF).rdd.getNumPartitions() >= rows / 500 > 4


def test_panels_sum_by_period_at_once(spark):
    # one partial and one final aggregate: none by subgroup, whose sums would be as many as the events
    s = adapter.SPEC
    for panel in (adapter.weekly_panel(adapter.plays(spark, SF), s), situational_panel(adapter.plays(spark, SF), s, {"late": F.col("half_seconds") <= 300})):
        assert aggregates(panel) == 2


def test_subgroups_count_once_in_each_situation(spark):
    r = random.Random(4)
    pick = lambda *x: r.choice(x)
    rows = [(pick("A", "B", None), 2020, pick(1, 2), pick("g1", "g2", None), pick(1, 2, 3, None), pick(0.5, -0.5, None), pick(0, 1), pick(0, 1), pick(1, 2, 3)) for _ in range(400)]
    events = spark.createDataFrame(rows, "team string, season int, week int, game_id string, drive int, epa double, is_success int, touchdown int, down int")
    tests = {"third": (F.col("down") == 3, lambda d: d == 3), "early": (F.col("down") <= 2, lambda d: d <= 2)}
    got = {(x["team"], x["week"]): x for x in situational_panel(events, EventSpec(), {n: t for n, (t, _) in tests.items()}).collect()}
    for team in "AB":
        for week in (1, 2):
            for name, (_, holds) in tests.items():
                mine = [x for x in rows if x[0] == team and x[2] == week and x[5] is not None and holds(x[8])]
                drives = {(x[3], x[4]) for x in mine if x[3] is not None and x[4] is not None}
                g = got[team, week]
                assert g[f"{name}_plays"] == len(mine) and abs(g[f"{name}_td_rate"] - sum(x[7] for x in mine) / len(drives)) < 1e-12
                assert abs(g[f"{name}_value"] - sum(x[5] for x in mine) / len(mine)) < 1e-12
