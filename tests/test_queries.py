"""Every query of the event engine against DuckDB on the small tables."""

import math
import os

import duckdb
import pytest

from panelforge.plans.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(float(v), 5) if isinstance(v, int | float) and not isinstance(v, bool) else v


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f[:-8]} as select * from read_parquet('{DATA}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    cols = sorted(got.columns)
    cur = duck.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]
    have = [tuple(plain(r[c]) for c in cols) for r in got.collect()]
    assert sorted(have, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", ["m1_elo_history", "m3_current_ratings"])
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_ties_of_means_round_alike(spark):
    """At sf0.01 a mean is exactly half a unit of the last digit shown."""
    larger = DATA.replace("0.001", "0.01")
    con = duckdb.connect()
    for f in os.listdir(larger):
        con.execute(f"create view {f[:-8]} as select * from read_parquet('{larger}/{f}')")
    got = QUERIES["w5_rolling_defense"](spark, larger)
    cols = sorted(got.columns)
    want = con.execute(f"select {', '.join(cols)} from ({ORACLES['w5_rolling_defense']})").fetchall()
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == sorted(want, key=repr)
