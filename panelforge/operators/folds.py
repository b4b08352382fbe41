"""Time-ordered splits: every fold is a label on rows, so all folds run in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def walk_forward(df: DataFrame, season: str, train: int = 5, expanding: bool = True) -> DataFrame:
    """Rows times folds: fold (its test season) and role. Seasons are few: their table is joined by range."""
    seasons = df.select(F.col(season).alias("_s")).distinct().withColumn("_i", F.dense_rank().over(Window.orderBy("_s")))
    n = seasons.count()
    if n <= train:
        raise ValueError(f"{n} seasons are too few to train on {train}")
    first = F.lit(1) if expanding else F.col("fold_index") - train
    tests = seasons.filter(F.col("_i") > train).select(F.col("_s").alias("fold"), F.col("_i").alias("fold_index"))
    plan = tests.select("fold", F.explode(F.sequence(first.cast("int"), F.col("fold_index"))).alias("_i"), "fold_index")
    plan = plan.join(seasons, "_i").select("fold", "_s", F.when(F.col("_i") == F.col("fold_index"), "test").otherwise("train").alias("role"))
    return df.join(F.broadcast(plan), F.col(season) == F.col("_s")).drop("_s")  # seasons squared rows


def holdout(df: DataFrame, season: str, test_seasons: int = 1) -> DataFrame:
    """role: test for the last seasons, train before."""
    last = df.select(F.col(season).alias("_s")).distinct().orderBy(F.desc("_s")).limit(test_seasons).agg(F.min("_s").alias("_from")).withColumn("_k", F.lit(1))
    return df.withColumn("_k", F.lit(1)).join(F.broadcast(last), "_k").withColumn("role", F.when(F.col(season) >= F.col("_from"), "test").otherwise("train")).drop("_k", "_from")


def chronological_tail(df: DataFrame, season: str, week: str, key: str, share: float = 0.2) -> DataFrame:
    """role: valid for the last share of rows in time. Counts per period decide where it begins; the period it falls in is ordered by key."""
    per = df.groupBy(season, week).agg(F.count("*").alias("_n"))
    w = Window.orderBy(season, week)
    per = per.withColumns({"_before": F.sum("_n").over(w) - F.col("_n"), "_all": F.sum("_n").over(Window.partitionBy(F.lit(0)))})
    place = F.row_number().over(Window.partitionBy(season, week).orderBy(key)) + F.col("_before")
    out = df.join(per, [season, week]).withColumn("role", F.when(place > F.floor(F.col("_all") * (1 - share)), "valid").otherwise("train"))
    return out.drop("_n", "_before", "_all")


def standardised(df: DataFrame, columns: list[str], floor: float = 1e-8) -> DataFrame:
    """(x - mean) / deviation over known values; a deviation below `floor` counts as 1."""
    facts = df.agg(*[F.avg(x).alias(f"_m_{x}") for x in columns], *[F.stddev_pop(x).alias(f"_s_{x}") for x in columns]).withColumn("_k", F.lit(1))
    out = df.withColumn("_k", F.lit(1)).join(F.broadcast(facts), "_k")
    scale = lambda x: F.when(F.col(f"_s_{x}") < floor, 1.0).otherwise(F.col(f"_s_{x}"))
    return out.select(*[((F.col(x) - F.col(f"_m_{x}")) / scale(x)).alias(x) if x in columns else F.col(x) for x in df.columns])
