"""A training run in walk-forward order: linear base models, their out-of-fold predictions, the stacker, diagnostics, a record.

A ridge regression needs sums of products only. Those of every season are summed in one pass over the rows; running
sums over the seasons, which are few, then hold what each fold trains on. So all folds and all base
models cost one pass for their sums and one for their predictions, however many seasons there are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.columns import logistic

COEFFICIENTS = "fold long, model string, n long, mean array<double>, scale array<double>, beta array<double>, intercept double"


def season_sums(df: DataFrame, season: str, columns: Sequence[str], label: str) -> DataFrame:
    """season, n, and the sums of all columns and products (`sums`: ones, columns and label by themselves, upper triangle). Rows with a null are left out."""
    z = [F.lit(1.0), *[F.col(c).cast("double") for c in columns], F.col(label).cast("double")]
    whole = df.filter(" and ".join(f"`{c}` is not null" for c in [season, *columns, label]))
    products = [F.sum(z[i] * z[j]) for i in range(len(z)) for j in range(i, len(z))]
    return whole.groupBy(F.col(season).cast("long").alias("season")).agg(F.count("*").alias("n"), F.array(*products).alias("sums"))


def trained_on(sums: DataFrame, least: int = 3, window: int | None = None) -> DataFrame:
    """fold (its test season), n and sums over the seasons before: all of them, or the last `window`. The first `least` seasons have no fold. A row a season."""
    before = Window.partitionBy(F.lit(0)).orderBy("season").rowsBetween(-window if window else Window.unboundedPreceding, -1)  # a row a season
    size = F.size("sums")
    out = sums.withColumns({"_at": F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("season")), "_n": F.sum("n").over(before), "_all": F.collect_list("sums").over(before)})
    zero = F.array_repeat(F.lit(0.0), size)
    total = F.aggregate("_all", zero, lambda a, x: F.zip_with(a, x, lambda p, q: p + q))
    return out.filter(F.col("_at") > least).select(F.col("season").alias("fold"), F.col("_n").alias("n"), total.alias("sums"))


def solved(products: np.ndarray, places: Sequence[int], alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Mean, deviation and coefficients of standardised columns, and the intercept. products: the symmetric matrix with ones first and the label last."""
    n, at = products[0, 0], np.array(places)
    mean, y = products[0, at] / n, products[0, -1] / n
    cov = products[np.ix_(at, at)] / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(cov), 0))
    scale = np.where(scale < 1e-8, 1.0, scale)
    target = (products[at, -1] / n - mean * y) / scale
    beta = np.linalg.solve(cov / np.outer(scale, scale) * n + alpha * np.eye(len(at)), target * n)
    return mean, scale, beta, float(y)


def _solve(frames: Iterator[pd.DataFrame], columns: Sequence[str], models: Mapping[str, Sequence[str]], alpha: float) -> Iterator[pd.DataFrame]:
    size = len(columns) + 2
    for frame in frames:
        rows = []
        for fold, n, sums in frame.itertuples(index=False):
            m = np.zeros((size, size))
            m[np.triu_indices(size)] = sums
            m = m + np.triu(m, 1).T
            for model, used in models.items():
                rows.append((fold, model, n, *[x.tolist() for x in solved(m, [1 + columns.index(c) for c in used], alpha)[:3]], float(m[0, -1] / m[0, 0])))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in COEFFICIENTS.split(", ")])


def fold_coefficients(df: DataFrame, season: str, models: Mapping[str, Sequence[str]], label: str, alpha: float = 1.0, least: int = 3, window: int | None = None) -> DataFrame:
    """A row per fold and base model (name: its columns)."""
    columns = sorted({c for used in models.values() for c in used})
    sums = trained_on(season_sums(df, season, columns, label), least, window)
    return sums.select("fold", "n", "sums").mapInPandas(partial(_solve, columns=columns, models=dict(models), alpha=alpha), COEFFICIENTS)


def out_of_fold(df: DataFrame, season: str, models: Mapping[str, Sequence[str]], coefficients: DataFrame) -> DataFrame:
    """The rows of seasons that have a fold, with `<model>_prediction` of a model that never saw the season. Null where a column is."""
    wide = coefficients.groupBy("fold").agg(*[F.max(F.when(F.col("model") == m, F.struct("mean", "scale", "beta", "intercept"))).alias(f"_{m}") for m in models])

    def predicted(model: str, used: Sequence[str]) -> Column:
        c = F.col(f"_{model}")
        terms = [(F.col(x).cast("double") - c["mean"][i]) / c["scale"][i] * c["beta"][i] for i, x in enumerate(used)]
        return sum(terms, c["intercept"])

    out = df.join(F.broadcast(wide), F.col(season) == F.col("fold"))  # a row a season
    return out.withColumns({f"{m}_prediction": predicted(m, used) for m, used in models.items()}).drop("fold", *[f"_{m}" for m in models])


def stacked_walk_forward(oof: DataFrame, season: str, predictions: Sequence[str], label: str, alpha: float = 1.0, least: int = 1) -> tuple[DataFrame, DataFrame]:
    """(rows with `stacked_prediction`, coefficients): ridge over the base models' out-of-fold predictions, itself trained on earlier seasons only."""
    models = {"stacked": list(predictions)}
    found = fold_coefficients(oof, season, models, label, alpha, least)
    return out_of_fold(oof, season, models, found), found


def stack_weights(coefficients: DataFrame, predictions: Sequence[str]) -> DataFrame:
    """fold, model, weight: the share of each base model in the stacker's standardised coefficients, by size."""
    parts = F.transform("beta", F.abs)
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    names = F.array(*[F.lit(p) for p in predictions])
    return coefficients.select("fold", F.explode(F.arrays_zip(names.alias("model"), F.transform(parts, lambda x: x / F.when(total == 0, 1.0).otherwise(total)).alias("weight"))).alias("_x")).select("fold", "_x.model", "_x.weight")


def diagnostics(df: DataFrame, season: str, predictions: Sequence[str], label: str) -> DataFrame:
    """A row per model and season, and per model over all (season null): n, mae, rmse, bias, brier (of the win that the prediction implies), hit rate of the sign."""
    won = (F.col(label) > 0).cast("double")
    one = lambda p: F.struct(F.lit(p).alias("model"), F.col(p).cast("double").alias("p"))
    long = df.select(F.col(season).cast("long").alias("season"), F.col(label).cast("double").alias("y"), won.alias("won"), F.inline(F.array(*[one(p) for p in predictions]))).filter("p is not null and y is not null")
    miss = F.col("p") - F.col("y")
    out = long.rollup("model", "season").agg(
        F.grouping_id().alias("_g"), F.count("*").alias("n"), F.avg(F.abs(miss)).alias("mae"), F.sqrt(F.avg(miss * miss)).alias("rmse"), F.avg(miss).alias("bias"),
        F.avg((logistic("p") - F.col("won")) ** 2).alias("brier"), F.avg(((F.col("p") > 0) == (F.col("y") > 0)).cast("double")).alias("hit_rate"))
    return out.filter("_g < 3").drop("_g")


def training_run(df: DataFrame, season: str, models: Mapping[str, Sequence[str]], label: str, out: str, run_id: str, trained_at: str, alpha: float = 1.0, least: int = 3) -> DataFrame:
    """Trains, predicts, stacks and scores; writes the tables under `out`/<table>/run_id=<run_id>, and gives the run's record.

    Tables: predictions (out of fold, stacked), coefficients (base models and stacker), weights, diagnostics, summary. A run
    that is repeated under the same id replaces its own tables only.
    """
    spark = df.sparkSession
    names = [f"{m}_prediction" for m in models]
    at = lambda t: f"{out}/{t}/run_id={run_id}"
    keep = lambda t, rows: rows.write.mode("overwrite").parquet(at(t)) or spark.read.parquet(at(t))
    base = keep("coefficients/stage=base", fold_coefficients(df, season, models, label, alpha, least))
    rows = keep("out_of_fold", out_of_fold(df, season, models, base))
    scored, stack = stacked_walk_forward(rows, season, names, label, alpha)
    stack = keep("coefficients/stage=stack", stack)
    keep("weights", stack_weights(stack, names))
    scored = keep("predictions", scored)
    told = keep("diagnostics", diagnostics(scored, season, [*names, "stacked_prediction"], label))
    best = told.filter("season is null").agg(F.min_by("model", F.struct("mae", "model")).alias("best_model"), F.min("mae").alias("best_mae"), F.max(F.when(F.col("model") == "stacked_prediction", F.col("mae"))).alias("stacked_mae"), F.max(F.when(F.col("model") == "stacked_prediction", F.col("brier"))).alias("stacked_brier"))
    facts = base.agg(F.count_distinct("fold").cast("long").alias("folds"), F.max("n").alias("most_training_rows"))
    parameters = json.dumps({"models": {m: list(x) for m, x in models.items()}, "label": label, "alpha": alpha, "least": least}, sort_keys=True)
    summary = facts.withColumn("_k", F.lit(1)).join(F.broadcast(best.withColumn("_k", F.lit(1))), "_k").drop("_k")  # one row each
    return keep("summary", summary.select(F.lit(run_id).alias("run"), F.lit(trained_at).cast("timestamp").alias("trained_at"), F.lit(parameters).alias("parameters"), "*"))
