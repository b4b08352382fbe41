"""Learned predictors through pyspark.ml: boosted trees, stacking, scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators.folds import standardised
from panelforge.sources.scratch import Rounds


def boosted_trees(train: DataFrame, features: Sequence[str], label: str = "target", valid: str | None = None, rounds: int = 30, depth: int = 4, step: float = 0.1, seed: int = 42) -> PipelineModel:
    """Gradient-boosted regression; `valid`: a boolean column of rows for early stopping."""
    trees = GBTRegressor(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=0.8, seed=seed)
    trees = trees.setValidationIndicatorCol(valid) if valid else trees
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), trees]).fit(train)


def importances(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    found = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(f, float(x)) for f, x in zip(features, found)], "feature string, importance double").orderBy(F.desc("importance"))


def disagreement(columns: Sequence[str], default: float = 13.5) -> Column:
    """Population deviation of a row's predictions."""
    xs = F.array(*[F.col(x).cast("double") for x in columns])
    n = float(len(columns))
    mean = F.aggregate(xs, F.lit(0.0), lambda a, x: a + x) / n
    return F.coalesce(F.sqrt(F.aggregate(xs, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n), F.lit(default))


def stacked(df: DataFrame, predictions: Sequence[str], label: str, alpha: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """df with `stacked`, and (model, weight): ridge over standardised out-of-fold predictions.

    Spark scales the penalty by the label's deviation, so alpha / n times that deviation is the plain ridge.
    The rows are gone through some five times; they are made once and written to the shared folder.
    """
    df = Rounds("stack-rows").keep(df)
    spread = df.agg(*[F.stddev_pop(p).alias(p) for p in predictions], F.stddev_pop(label).alias("_y"), F.count("*").alias("_n")).first()
    live = [p for p in predictions if (spread[p] or 0) > 1e-12]  # constant columns say nothing
    ready = standardised(df.withColumns({f"_z_{p}": F.col(p) for p in live}), [f"_z_{p}" for p in live])
    ridge = LinearRegression(featuresCol="_v", labelCol=label, predictionCol="stacked", regParam=alpha / spread["_n"] * spread["_y"], elasticNetParam=0.0, standardization=False, solver="normal")
    model = Pipeline(stages=[VectorAssembler(inputCols=[f"_z_{p}" for p in live], outputCol="_v"), ridge]).fit(ready)
    size = [abs(float(x)) for x in model.stages[-1].coefficients]
    weights = df.sparkSession.createDataFrame([(p, x / (sum(size) or 1.0)) for p, x in zip(live, size)], "model string, weight double")
    return model.transform(ready).drop("_v", *[f"_z_{p}" for p in live]), weights


def contributions(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    return df.withColumns({f"{m}_weight": F.lit(w) for m, w in weights.items()} | {f"{m}_part": F.col(m) * w for m, w in weights.items()})
