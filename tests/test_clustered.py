"""Clustered panels: what is joined or windowed by their entity isn't shuffled again."""

import uuid

from pyspark.sql import functions as F

from panelforge.operators import panels
from panelforge.sources import clustered
from panelforge.sources.scratch import scratch_path

PANEL = [(t, s, w, float(ord(t) + w + 10 * s)) for t in "ABCD" for s in (1, 2) for w in range(1, 9)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_and_lag_joins_leave_the_clustered_panel_where_it_is(spark):
    name = f"panel_{uuid.uuid4().hex}"
    df = spark.createDataFrame(PANEL, "team string, season int, week int, v double")
    clustered.write_clustered(df, name, ["team"], ["season", "week"], 4, scratch_path(spark, "panel"))
    panel = clustered.read_clustered(spark, name)
    rolled = panels.rolling(panel, {"v_l4": "avg(v)"}, "team", "season", "week")
    assert "Exchange" not in plan(rolled)
    want = {(r["team"], r["season"], r["week"]): r["v_l4"] for r in panels.rolling(df, {"v_l4": "avg(v)"}, "team", "season", "week").collect()}
    assert {(r["team"], r["season"], r["week"]): r["v_l4"] for r in rolled.collect()} == want
    before = panel.select(F.col("team").alias("t"), "season", (F.col("week") + 1).alias("week"), "v").hint("merge")
    games = spark.createDataFrame([("A", 1, 2), ("B", 2, 5)], "team string, season int, week int").repartition(4, "team")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")  # the bucket's key is one of the join's
    try:
        joined = games.join(before, (games["team"] == before["t"]) & (games["season"] == before["season"]) & (games["week"] == before["week"]))
        assert plan(joined).count("Exchange hashpartitioning") <= 1  # the games' own
        assert sorted(r["v"] for r in joined.select("v").collect()) == [76.0, 90.0]
    finally:
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    spark.sql(f"drop table {name}")


def test_top_audit_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", None), ("e", 0.5)], "k string, v double")
    got = [(r["side"], r["place"], r["k"]) for r in clustered.top_audit(df, ["v"], ["k"], 2).collect()]
    assert sorted(got) == [("bottom", 1, "e"), ("bottom", 2, "a"), ("top", 1, "b"), ("top", 2, "c")]
    assert clustered.top_audit(df.limit(0), ["v"], ["k"]).count() == 0
    assert [r["k"] for r in clustered.ordered_report(df.filter("v > 0"), [F.desc("v"), "k"]).collect()] == ["b", "c", "a", "e"]
