"""Ratings: Elo by relaxation over whole histories, and a ridge paired comparison."""

from __future__ import annotations

from functools import partial

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from panelforge.operators import elo
from panelforge.sources.scratch import Rounds, cleared, delete, scratch_path

#: Elo sweeps of one job, between two tables on disk.
SWEEPS = 5


def elo_history(games: DataFrame, k: float = 20, home: float = 48, initial: float = 1500, regress: float = 0.33, mean: float = 1505, tolerance: float = 1e-10, block_games: int = 2_000_000, part_games: int = 100_000) -> DataFrame:
    """Ratings before and after every game of (pool, game_id, season, week, teams, scores).

    A team's rating before a game is the first one and all its gains since, each season's end drawing them to the
    mean: a running sum over the team's own games, given the gains. Gains follow from the ratings. Both take turns
    over all games at once until no rating changes by more than `tolerance`. A sweep makes those games exact
    whose teams' earlier games are, so it ends at the latest when the longest chain of games is through; as
    a gain hardly depends on far gains, a few sweeps do.

    Teams are dealt by hash to parts of some `part_games` games. A part keeps its teams' games as arrays and tells each other part
    the ratings that its teams bring to their games: one shuffle a sweep, of 8 bytes a team and game beside the arrays.
    Sweeps grow with a team's games, so games settle in blocks of `block_games`, in order, one after the other;
    each block starts from the ratings that the one before left.

    game_id is unique within a pool and orders the games of a week. Games without both scores, a team or a
    season, and a team's games against itself, are left out. A pool's seasons are those with games; a team's first
    game finds it at the initial rating. A tie moves the ratings like half a win. 0 <= regress < 1.
    """
    if not 0 <= regress < 1:
        raise ValueError("regress must be in [0, 1)")
    spark = games.sparkSession
    margin = (F.col("home_score") - F.col("away_score")).cast("double")
    g = games.select("pool", "game_id", "season", "week", "home_team", "away_team", margin.alias("margin")).filter("margin is not null and season is not null and home_team <> away_team")
    order = ["season", "week", "game_id"]
    whole = Rounds("elo-games").keep(g.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_g", F.monotonically_increasing_id()))
    repeats = lambda *by: whole.groupBy(*by).count().filter("count > 1").limit(1).count() > 0
    if repeats(F.xxhash64("pool", "game_id")) and repeats("pool", "game_id"):
        raise ValueError("game_id repeats within a pool")

    # numbers in the order of the games: a row for each of the sorted partitions
    slot = F.shiftright("_g", 33)
    counts = {r[0]: r[1] for r in whole.groupBy(slot).count().collect()}
    total, begins = 0, []
    for p in sorted(counts):
        begins.append((p, total))
        total += counts[p]
    begins = F.broadcast(spark.createDataFrame(begins, "_slot long, _begin long"))
    whole = whole.join(begins, slot == F.col("_slot")).withColumn("n", F.col("_begin") + F.col("_g").bitwiseAND((1 << 33) - 1)).drop("_slot", "_begin", "_g")
    block_games, cores = min(block_games, max(total, 1)), spark.sparkContext.defaultParallelism
    parts = -(-block_games // part_games)
    parts = -(-parts // cores) * cores if parts > 1 else 1
    rules = elo.Rules(k, home, float(initial), regress, mean, tolerance, parts)

    seasons = whole.select("pool", "season").distinct().select(F.col("pool").alias("_pool"), F.col("season").alias("_season"), F.dense_rank().over(Window.partitionBy("pool").orderBy("season")).alias("_s"))
    same = F.col("pool").eqNullSafe(F.col("_pool")) & (F.col("season") == F.col("_season"))
    name = lambda team: [F.xxhash64(F.lit(i), "pool", team) for i in (1, 2)]  # noqa: E731  128 bits
    part = lambda team: F.pmod(name(team)[0], F.lit(parts)).cast("int")
    seat = lambda team, other: F.struct(*[h.alias(c) for h, c in zip(name(team), "ab")], part(team).alias("part"), part(other).alias("partner"), F.lit(team == "home_team").alias("home"))
    sides = whole.join(F.broadcast(seasons), same).select(F.floor(F.col("n") / block_games).cast("int").alias("block"), "n", "_s", "margin", F.inline(F.array(seat("home_team", "away_team"), seat("away_team", "home_team"))))
    path = scratch_path(spark, "elo-sides")
    sides.groupBy("block", "part").applyInArrow(elo.packed, "block int, part int, data binary").write.partitionBy("block").parquet(path)
    static = spark.read.schema("part int, data binary, block int").parquet(path)

    shown = lambda df, kind: df.select("part", F.lit(kind).alias("kind"), F.lit(None).cast("int").alias("source"), "data", F.lit(None).cast("double").alias("most"))
    by_part = lambda df, step, schema=elo.ROWS: df.repartitionById(parts, "part").mapInArrow(partial(step, rules=rules), schema)
    ratings, settled = shown(spark.createDataFrame([], "part int, data binary"), "ratings"), []
    for block in range(-(-total // block_games)):
        mine, rounds, done = shown(static.filter(F.col("block") == block), "static"), Rounds("elo"), Rounds("elo-moves")
        state, most = by_part(mine.unionByName(ratings), elo.begun), None
        while most is None or most > tolerance:
            for _ in range(SWEEPS if parts > 1 else 1):
                state = by_part(state, elo.swept)
            facts = Observation()
            state = rounds.keep(state.observe(facts, F.max("most").alias("most")))
            most = facts.get["most"] or 0.0
            cleared(spark)
        moves = done.keep(by_part(state.unionByName(mine).unionByName(ratings), elo.ended, elo.RESULTS))
        delete(spark, rounds.path)
        settled.append(done.path)
        ratings = shown(moves.filter("data is not null"), "ratings")
    moves = spark.read.schema(elo.RESULTS).parquet(*settled).filter("n is not null") if settled else spark.createDataFrame([], elo.RESULTS)
    done = whole.join(moves.select("n", "move", "home_pre", "away_pre"), "n")
    return done.select("pool", "game_id", "season", "week", "home_team", "away_team", "home_pre", "away_pre", (F.col("home_pre") + F.col("move")).alias("home_post"), (F.col("away_pre") - F.col("move")).alias("away_post"))


def current_ratings(history: DataFrame) -> DataFrame:
    """Each team's rating after its last game."""
    side = lambda p: history.select("pool", F.col(f"{p}_team").alias("team"), F.struct("season", "week", "game_id").alias("at"), F.col(f"{p}_post").alias("rating"))
    return side("home").unionByName(side("away")).groupBy("pool", "team").agg(F.max_by("rating", "at").alias("rating"))


def elo_predictions(games: DataFrame, ratings: DataFrame, initial: float = 1500, home: float = 48) -> DataFrame:
    """Spread and win probability of each game; teams without a rating have the initial one."""
    out = games
    for p in ("home", "away"):
        out = out.join(ratings.select("pool", F.col("team").alias(f"{p}_team"), F.col("rating").alias(f"_{p}")), ["pool", f"{p}_team"], "left")
    gap = F.coalesce("_home", F.lit(float(initial))) - F.coalesce("_away", F.lit(float(initial))) + home
    return out.withColumns({"spread": gap / 25, "home_win_probability": 1 / (1 + F.pow(F.lit(10.0), -gap / 400))}).drop("_home", "_away")


def entity_universe(games: DataFrame) -> DataFrame:
    return games.select(F.col("home_team").alias("team")).union(games.select("away_team")).distinct()


def ridge_strength(games: DataFrame, prior_sd: float = 5.0, home_mean: float = 2.5, home_sd: float = 1.0, rounds: int = 50, tolerance: float = 1e-6) -> DataFrame:
    """team, strength, home_advantage: the posterior mean of margin = strength gap + home advantage.

    Given the residual deviation this is a ridge regression on the teams' indicators, which Spark
    solves by its normal equations (one pass over the games; at most 4,096 teams). The home column
    is scaled so that one penalty serves both priors, and every game also counts as seen from the
    other side, as Spark gives constant columns no weight. Deviation and solution take turns until they settle.

    Games without a team, and of a team with itself, are left out; teams without a score have strength 0.
    """
    spark, games = games.sparkSession, games.filter("home_team <> away_team")
    teams = [r["team"] for r in entity_universe(games).orderBy("team").limit(4096).collect()]  # bounded: the normal equations are too
    if len(teams) > 4095:
        raise ValueError("more teams than the normal equations hold")
    if not teams:
        return spark.createDataFrame([], "team string, strength double, home_advantage double")
    places = F.create_map(*[F.lit(x) for t, i in zip(teams, range(len(teams))) for x in (t, i)])
    scale, n = home_sd / prior_sd, len(teams)
    unit = lambda c, v: F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.when(i == c, v).otherwise(0.0))
    home, away = places[F.col("home_team")], places[F.col("away_team")]
    row = F.zip_with(unit(home, 1.0), unit(away, -1.0), lambda x, y: x + y)
    row = F.transform(row, lambda x, i: F.when(i == n, F.lit(scale)).otherwise(x))
    margin = (F.col("home_score") - F.col("away_score")).cast("double")
    both = games.filter(margin.isNotNull()).select(row.alias("x"), (margin - home_mean).alias("y"), F.explode(F.array(F.lit(1.0), F.lit(-1.0))).alias("side"))
    frame = both.select(array_to_vector(F.transform("x", lambda x: x * F.col("side"))).alias("x"), (F.col("y") * F.col("side")).alias("y")).persist()
    count, deviation, sigma2 = frame.agg(F.count("*") / 2, F.stddev_pop("y"), F.greatest(F.var_pop("y"), F.lit(1e-6))).first()
    beta = [0.0] * (n + 1)
    for _ in range(rounds if count and deviation else 0):
        # Spark's penalty is per row, and in units of the label's deviation
        fit = LinearRegression(featuresCol="x", labelCol="y", regParam=sigma2 / prior_sd**2 / count * deviation, fitIntercept=False, standardization=False, solver="normal").fit(frame)
        beta, before = fit.coefficients.toArray().tolist(), sigma2
        sigma2 = max(1e-6, fit.summary.meanSquaredError)
        if abs(sigma2 - before) <= tolerance * before:
            break
    frame.unpersist()
    h = home_mean + beta[n] * scale
    return spark.createDataFrame([(t, float(b), float(h)) for t, b in zip(teams, beta)], "team string, strength double, home_advantage double")


def strength_predictions(games: DataFrame, strengths: DataFrame, home_mean: float = 2.5) -> DataFrame:
    """Each game's predicted margin; a team without a strength has 0, and without any strengths the home advantage is its prior mean."""
    out = games
    for p in ("home", "away"):
        out = out.join(strengths.select(F.col("team").alias(f"{p}_team"), F.col("strength").alias(f"_{p}")), f"{p}_team", "left")
    advantage = F.broadcast(strengths.agg(F.coalesce(F.first("home_advantage"), F.lit(home_mean)).alias("_advantage")).withColumn("_one", F.lit(1)))  # one row
    out = out.withColumn("_one", F.lit(1)).join(advantage, "_one")
    return out.withColumn("strength_spread", F.coalesce("_home", F.lit(0.0)) - F.coalesce("_away", F.lit(0.0)) + F.col("_advantage")).drop("_home", "_away", "_advantage", "_one")
