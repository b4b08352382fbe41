"""Panels kept in buckets by entity and sorted in time, so that windows over them need no shuffle.

Nor do joins by the entity; those by entity and period only with spark.sql.requireAllClusterKeysForCoPartition off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, table: str, by: Sequence[str], order: Sequence[str], buckets: int, path: str) -> None:
    """Replaces `table`: rows hashed by `by` into `buckets`, each file sorted by `by` and `order`. One file a bucket: rows are dealt by the same hash before."""
    dealt = df.repartition(buckets, *by)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *by).sortBy(*by, *order).format("parquet").saveAsTable(table)


def read_clustered(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def ordered_report(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """All rows in one order, for a report that people read: small results only."""
    return df.orderBy(*order)


def top_audit(df: DataFrame, columns: Sequence[str], key: Sequence[str], k: int = 10) -> DataFrame:
    """For each column the k rows with its greatest and its least values: column_name, side, place, key and value.

    Ties go by key. Tasks hold k rows a column and side, and so does the driver's sort.
    """
    parts = []
    for c in columns:
        for side, order in (("top", F.desc(c)), ("bottom", F.asc(c))):
            best = df.filter(F.col(c).isNotNull()).orderBy(order, *key).limit(k)
            rows = best.agg(F.collect_list(F.struct(F.col(c).cast("double").alias("value"), *key)).alias("r"))  # k rows
            ranked = F.array_sort("r", lambda x, y: _before(x, y, key, side))
            parts.append(rows.select(F.lit(c).alias("column_name"), F.lit(side).alias("side"), F.posexplode(ranked).alias("place", "x")).select("column_name", "side", (F.col("place") + 1).alias("place"), "x.value", *[f"x.{x}" for x in key]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _before(x: Column, y: Column, key: Sequence[str], side: str) -> Column:
    out = F.lit(0)
    for c in reversed(list(key)):
        out = F.when(x[c] < y[c], -1).when(x[c] > y[c], 1).otherwise(out)
    first, second = (1, -1) if side == "top" else (-1, 1)
    return F.when(x["value"] < y["value"], first).when(x["value"] > y["value"], second).otherwise(out)
