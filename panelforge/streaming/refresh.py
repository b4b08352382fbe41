"""Incremental refresh: new files of a folder go through a batch operator and replace their slices."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from panelforge.sources.tables import write_slices


def refresh(spark: SparkSession, folder: str, schema: str, transform: Callable[[DataFrame], DataFrame], out: str, keys: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Takes what has arrived since the last run and stops; a repeated batch writes the same slices again."""
    rows = spark.readStream.schema(schema).parquet(folder)
    return rows.writeStream.foreachBatch(lambda df, _: write_slices(transform(df), out, keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
