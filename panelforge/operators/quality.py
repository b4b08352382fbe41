"""Declared data checks; each gives rows of (check, table, column, severity, failures, passed)."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _rows(counts: DataFrame, check: str, name: str, severity: str) -> DataFrame:
    """counts: column_name, failures."""
    return counts.select(F.lit(check).alias("check"), F.lit(name).alias("table"), F.col("column_name").alias("column"), F.lit(severity).alias("severity"), F.coalesce("failures", F.lit(0)).cast("long").alias("failures")).withColumn("passed", (F.col("failures") == 0).cast("int"))


def not_null(df: DataFrame, columns: Sequence[str], name: str, severity: str = "error") -> DataFrame:
    one = df.agg(*[F.sum(F.col(x).isNull().cast("long")).alias(x) for x in columns])
    return _rows(one.unpivot([], list(columns), "column_name", "failures"), "not_null", name, severity)


def accepted_values(df: DataFrame, values: Mapping[str, Sequence], name: str, severity: str = "error") -> DataFrame:
    """Null passes."""
    one = df.agg(*[F.sum((~F.col(x).isin(*v)).cast("long")).alias(x) for x, v in values.items()])
    return _rows(one.unpivot([], list(values), "column_name", "failures"), "accepted_values", name, severity)


def in_range(df: DataFrame, ranges: Mapping[str, tuple[float, float]], name: str, severity: str = "warn") -> DataFrame:
    one = df.agg(*[F.sum((~F.col(x).between(*r)).cast("long")).alias(x) for x, r in ranges.items()])
    return _rows(one.unpivot([], list(ranges), "column_name", "failures"), "range", name, severity)


def unique(df: DataFrame, columns: Sequence[str], name: str, severity: str = "error", concat: bool = False) -> DataFrame:
    """Values that occur more than once; `concat`: of the columns' texts joined, where a null part makes no key."""
    key = df.select(F.concat(*[F.col(x).cast("string") for x in columns]).alias("k")).filter("k is not null") if concat else df.select(F.struct(*columns).alias("k"))
    many = key.groupBy("k").count().filter("count > 1").agg(F.count("*").alias("failures"))
    return _rows(many.select(F.lit("+".join(columns)).alias("column_name"), "failures"), "unique", name, severity)


def report(*parts: DataFrame) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)
