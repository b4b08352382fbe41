"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: a word is a run of characters other than ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where the setting is missing, a local master gets a folder of its own (tests); on a cluster a
    machine-local folder would lose rows, so that is an error.
    """
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"file://{tempfile.gettempdir()}/checkpoints"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes `df` as a table in the shared folder and reads it back.

    Cuts the lineage at files that outlive any executor. The folder is scratch space of the
    cluster: what isn't `dropped` its owner clears after the application.
    """
    path = scratch_path(df.sparkSession, f"staged-{label}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more, and what is left of the jobs that made them."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    for spark in {df.sparkSession for df in tables}:
        cleared(spark)


def cleared(spark: SparkSession) -> None:
    """Lets go of finished jobs: Spark deletes their shuffle files only when the driver's heap is collected.

    An operator of many jobs would else hold the files of all, and the driver their plans and generated code.
    """
    spark._jvm.System.gc()


def bounded_batches(spark: SparkSession) -> None:
    """Lets Arrow batches hold 4 MB rather than Spark's 64 MB, so that a Python worker's memory follows a row's size."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carried(docs: DataFrame, keep: list[str]) -> DataFrame:
    """row (a struct of the `keep` columns, so that no name clashes) and text (as a string)."""
    columns = [F.col(f"`{c}`").alias(c) for c in keep]
    return docs.select((F.struct(*columns) if keep else F.struct(F.lit(None).alias("_"))).alias("row"), F.col("text").cast("string").alias("text"))


def unpacked(rows: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    """The columns of the struct `row`, and `more`."""
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in columns], *more)


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once a row (a lambda variable is bound to it)."""
    return F.transform(F.array(value), body)[0]


def blocks(items: Column) -> Column:
    """An array cut into slices of about the root of its length; none of an empty one."""
    width = lambda x: F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(x))).cast("int"))
    return let(items, lambda x: F.when(F.size(x) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / width(x)).cast("int")), lambda b: F.slice(x, b * width(x) + 1, width(x)))).otherwise(F.slice(F.array(x), 1, 0)))


def running(numbers: Column, join) -> Column:
    """Running results of `join` (a sum, a maximum) over an array of longs from 0 on, each number's own included.

    Slices first and then their last results, so that n numbers cost some n ** 1.5 copies and not n ** 2.
    """
    none, zero = F.array().cast("array<bigint>"), F.lit(0).cast("bigint")
    last = lambda a: F.coalesce(F.get(a, F.size(a) - 1), zero)
    within = F.transform(blocks(numbers), lambda b: F.aggregate(b, none, lambda a, x: F.concat(a, F.array(join(last(a), x)))))
    heads = lambda ws: F.aggregate(ws, none, lambda a, w: F.concat(a, F.array(join(last(a), last(w)))))
    return let(within, lambda ws: let(heads(ws), lambda hs: F.flatten(F.transform(ws, lambda w, i: F.transform(w, lambda x: join(F.coalesce(F.get(hs, i - 1), zero), x))))))


def words(text: Column) -> Column:
    """Words of a text as an array; null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def n_words(text: Column) -> Column:
    """The number of words; `split` leaves an empty item before or after outer white space."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    return let(parts, lambda p: F.size(p) - (p[0] == "").cast("int") - ((F.size(p) > 1) & (F.element_at(p, -1) == "")).cast("int")).cast("long")


def without(text: Column, characters: str) -> Column:
    """The text with each of the given characters removed."""
    return F.translate(text, characters, "")


def unit(*parts) -> Column:
    """A pseudorandom number in [0, 1) of the values."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def numbered(df: DataFrame, groups: list[str], order: list[Column], total: int, per_bucket: int, name: str, weight: Column | None = None) -> DataFrame:
    """Adds `name`: the sum of `weight` (1) over the rows before this one in its group.

    Rows go to buckets by hash, so a hot group is spread: each task sorts one bucket, and the
    buckets' totals give the offsets. Rows equal in `order` are interchangeable.
    """
    from pyspark.sql import Window

    weight = F.lit(1).cast("long") if weight is None else weight
    n = max(16, -(-total // per_bucket))
    df = df.withColumns({"_bucket": F.floor(unit(F.lit(7), *order) * n).cast("int"), "_weight": weight})
    sums = df.groupBy(*groups, "_bucket").agg(F.sum("_weight").alias("_sum"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    keys = [f"_g{i}" for i in range(len(groups))]
    offsets = sums.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col("_bucket").alias("_at"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    on = F.col("_bucket") == F.col("_at")
    for g, k in zip(groups, keys):
        on = on & F.col(g).eqNullSafe(F.col(k))
    inner = Window.partitionBy(*groups, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.join(offsets, on).withColumn(name, (F.col("_offset") + F.coalesce(F.sum("_weight").over(inner), F.lit(0))).cast("long"))
    return out.drop("_bucket", "_weight", "_at", "_offset", *keys)
