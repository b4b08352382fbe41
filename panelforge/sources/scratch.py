"""Tables between the rounds of an iterative operator, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under spark.checkpoint.dir; a local master without that setting gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/checkpoints"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cleared(spark: SparkSession) -> None:
    """Lets go of finished jobs: Spark deletes their shuffle files only when the driver's heap is collected."""
    spark._jvm.System.gc()


class Rounds:
    """Keeps the newest table of a loop: each is written and read again, the one before is deleted."""

    def __init__(self, label: str):
        self.label, self.path = label, ""

    def keep(self, df: DataFrame) -> DataFrame:
        spark, before = df.sparkSession, self.path
        self.path = scratch_path(spark, self.label)
        df.write.parquet(self.path)
        if before:
            delete(spark, before)
        return spark.read.schema(df.schema).parquet(self.path)
