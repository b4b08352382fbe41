"""Bronze tables: scans by year, text casts, lineage, sinks by slice, audits, profiles."""

from __future__ import annotations

import functools
import time
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.columns import flag, null_tokens, to_date, to_double, to_int, to_line


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def with_lineage(df: DataFrame, year: str, load_type: str = "BULK") -> DataFrame:
    return df.withColumns({"source_year": F.lit(str(year)), "load_type": F.lit(load_type), "loaded_at": F.current_timestamp().cast("string")})


def _readable(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_years(spark: SparkSession, paths: Mapping[str, str], text: bool = True) -> DataFrame:
    """One table of yearly files; years without a file are passed over, missing columns are null."""
    parts = []
    for year, path in paths.items():
        if _readable(spark, path):
            df = spark.read.option("mergeSchema", True).parquet(path)
            parts.append(with_lineage(as_text(df) if text else df, year))
    if not parts:
        raise FileNotFoundError(f"none of {len(paths)} paths can be read")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_single(spark: SparkSession, path: str, text: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    return with_lineage(as_text(df) if text else df, "ALL")


def read_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A typed projection over files with the file's name and the row's number in it."""
    return spark.read.schema(schema).parquet(path).select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_number"))


def read_csv(spark: SparkSession, path: str, schema: str, delimiter: str = ",") -> DataFrame:
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").csv(path, header=True, sep=delimiter, quote='"')
    return df.select([null_tokens(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; lines that don't parse give nulls."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def json_fields(df: DataFrame, column: str, paths: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Adds columns from a text column of JSON; paths: new name -> (path, type). What isn't there or of the type is null."""
    return df.withColumns({n: F.get_json_object(F.col(column), p).try_cast(t) for n, (p, t) in paths.items()})


def projected(raw: DataFrame, types: Mapping[str, str] = {}) -> DataFrame:
    """A staging projection: columns in lower case; those in `types` cast by kind (int, double, line, flag, date), the rest as they are.

    What a cast loses becomes null; a flag that is null is 0.
    """
    kinds = {"int": to_int, "double": to_double, "line": to_line, "flag": flag, "date": to_date}
    wanted = {n.lower(): k for n, k in types.items()}
    if lost := set(wanted) - {c.lower() for c in raw.columns}:
        raise ValueError(f"columns are missing: {', '.join(sorted(lost))}")
    return raw.select([(kinds[wanted[c.lower()]](F.col(f"`{c}`")) if c.lower() in wanted else F.col(f"`{c}`")).alias(c.lower()) for c in raw.columns])


def with_columns_of(df: DataFrame, target: DataFrame) -> DataFrame:
    """df with typed nulls for the columns that only `target` has; what a table gains when its source grows."""
    own = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in target.dtypes if c.lower() not in own])


def ensure_table(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """The table at `path` with df's columns added where it lacks them; made, empty, where there is none. Nothing is rewritten."""
    if not _readable(spark, path):
        df.limit(0).write.parquet(path)
    return with_columns_of(spark.read.option("mergeSchema", True).parquet(path), df)


def matched_by_name(df: DataFrame, target: DataFrame) -> DataFrame:
    """Columns of `target` in its order, taken by name whatever their case; absent ones are null."""
    own = {c.lower(): c for c in df.columns}
    return df.select([(F.col(f"`{own[c.lower()]}`").cast(t) if c.lower() in own else F.lit(None).cast(t)).alias(c) for c, t in target.dtypes])


def split_rejects(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the rows in which a value is lost by the cast."""
    lost = functools.reduce(lambda a, b: a | b, [F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in types.items()])
    good = df.filter(~lost).select([(F.col(c).try_cast(types[c]) if c in types else F.col(c)).alias(c) for c in df.columns])
    return good, df.filter(lost)


def conversion_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    counts = [F.sum((F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).cast("long")).alias(c) for c, t in types.items()]
    return df.agg(*counts).unpivot([], list(types), "column_name", "failures")


def reject_report(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """A row per column: values that its cast loses, and the least of them as a sample; one pass."""
    lost = {c: F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.col(c).cast("string")) for c, t in types.items()}
    facts = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("type"), F.count(x).alias("failures"), F.min(x).alias("sample")) for c, x in lost.items()])
    return df.agg(facts.alias("f")).select(F.inline("f"))


def replace_slices(df: DataFrame, path: str, keys: Sequence[str], slices: Sequence[Sequence]) -> None:
    """Replaces the named slices, each a value per key: with df's rows, or with nothing where it has none."""
    wanted = functools.reduce(lambda a, b: a | b, [functools.reduce(lambda a, b: a & b, [F.col(k) == v for k, v in zip(keys, s)]) for s in slices])
    rows = df.filter(wanted)
    write_slices(rows, path, keys)
    held = {tuple(r) for r in rows.select(*keys).distinct().collect()}  # the named slices at most
    for s in slices:
        if tuple(s) not in held:
            p = df.sparkSession._jvm.org.apache.hadoop.fs.Path("/".join([path, *[f"{k}={v}" for k, v in zip(keys, s)]]))
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def write_slices(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replaces the slices (partitions) that df has rows for and leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    df.write.mode({"REPLACE": "overwrite"}.get(mode, mode.lower())).format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)


def load(spark: SparkSession, datasets: Mapping[str, Mapping[str, str]], out: str) -> DataFrame:
    """Loads each dataset's years into its own table; a record of each: success, rows, error, seconds."""
    records = []
    for name, paths in datasets.items():
        began = time.time()
        try:
            df = read_years(spark, paths)
            write_slices(df, f"{out}/{name}", ["source_year"])
            rows, error = df.count(), None
        except (OSError, PySparkException, Py4JJavaError) as e:  # one that fails doesn't end the load
            rows, error = 0, str(e).splitlines()[0][:500]
        records.append((name, error is None, rows, error, time.time() - began))
    return spark.createDataFrame(records, "dataset string, success boolean, rows long, error string, seconds double")


def load_totals(records: DataFrame) -> DataFrame:
    """One row over the records of `load`."""
    return records.agg(F.count("*").alias("datasets"), F.count_if("success").alias("loaded"), F.sum("rows").alias("rows"), F.sum("seconds").alias("seconds"))


def training_read(mart: DataFrame, first_season: int, order: Sequence[str], limit: int | None = None) -> DataFrame:
    """Finished games from a season on, in order; `limit` for sampling runs."""
    rows = mart.filter((F.col("season") >= first_season) & F.col("home_score").isNotNull() & F.col("away_score").isNotNull()).orderBy(*order)
    return rows.limit(limit) if limit else rows


def inference_read(mart: DataFrame, season: int, week: int, order: Sequence[str]) -> DataFrame:
    return mart.filter((F.col("season") == season) & (F.col("week") == week)).orderBy(*order)


def training_profile(df: DataFrame, teams: Sequence[str] = ("home_team", "away_team")) -> DataFrame:
    """A row per season: games, weeks, teams, and the first and last season of all."""
    sides = df.select("season", "week", F.explode(F.array(*teams)).alias("team"), F.lit(1.0 / len(teams)).alias("_game"))
    one = sides.groupBy("season").agg(F.round(F.sum("_game")).cast("long").alias("games"), F.count_distinct("week").alias("weeks"), F.count_distinct("team").alias("teams"))
    ends = one.agg(F.min("season").alias("first_season"), F.max("season").alias("last_season"))
    return one.withColumn("_k", F.lit(1)).join(F.broadcast(ends.withColumn("_k", F.lit(1))), "_k").drop("_k")  # one row


def null_audit(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """A row per table and column: rows and nulls; one pass a table."""
    parts = []
    for name, (df, columns) in tables.items():
        facts = F.array(*[F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.count("*").alias("row_count"), F.count_if(F.col(c).isNull()).alias("null_count")) for c in columns])
        parts.append(df.agg(facts.alias("f")).select(F.inline("f")))
    return functools.reduce(DataFrame.unionByName, parts)


def with_actuals(predictions: DataFrame, actuals: DataFrame, key: str) -> DataFrame:
    """Predictions with what came true and the error, where it is known."""
    known = actuals.select(F.col(key), F.col("actual").alias("actual_value"))
    return predictions.join(known, key, "left").withColumn("prediction_error", F.col("prediction") - F.col("actual_value"))


def table_audit(df: DataFrame, name: str, year: str, loaded: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("row_count"), F.sum(F.col(year).isNull().cast("long")).alias("missing_year"), F.min(year).cast("long").alias("min_year"),
        F.max(year).cast("long").alias("max_year"), F.count_distinct(year).alias("distinct_years"), F.max(loaded).cast("string").alias("last_load"),
    ).select(F.lit(name).alias("table_name"), "*")


def freshness(df: DataFrame, name: str, loaded: str, season: str, week: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"), F.max(loaded).cast("string").alias("last_load"), F.count_distinct(season).alias("seasons"), F.max(F.struct(season, week)).alias("_top")).select(
        F.lit(name).alias("table_name"), "row_count", "last_load", "seasons", F.col(f"_top.{season}").cast("long").alias("latest_season"), F.col(f"_top.{week}").cast("long").alias("latest_week"))


def profile(df: DataFrame) -> DataFrame:
    """A row per column: type, rows, nulls, least and largest value as text; one pass."""
    kinds = dict(df.dtypes)
    facts = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type"), F.count("*").alias("row_count"), F.sum(F.col(c).isNull().cast("long")).alias("null_count"), F.min(F.col(c).cast("string")).alias("least"), F.max(F.col(c).cast("string")).alias("largest")) for c, t in kinds.items()])
    return df.agg(facts.alias("f")).select(F.inline("f"))
