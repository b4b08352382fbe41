"""What a table read as text holds: types that fit its columns, samples, a suggested definition; and rows that don't parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Kinds of text, each with the pattern that every value of the kind matches; the first that matches a value is its kind.
KINDS = {
    "boolean": r"(?i)^(true|false)$",
    "bigint": r"^[+-]?[0-9]{1,18}$",
    "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?$",
    "string": r"(?s)^.*$",
}
BIT = {k: 1 << i for i, k in enumerate(KINDS)}
#: The type that holds all values of these kinds; other mixtures are strings.
JOINS = {frozenset(["bigint", "double"]): "double", frozenset(["date", "timestamp"]): "timestamp"}
#: Samples are the values with the least digest in each third of the digests' first digits.
THIRDS = ("01234", "56789", "abcdef")


def _kind(value: Column) -> Column:
    out = F.lit(BIT["string"])
    for kind, pattern in reversed(KINDS.items()):
        out = F.when(value.rlike(pattern), BIT[kind]).otherwise(out)
    return out


def _type(bits: Column) -> Column:
    """The least type above all kinds seen; without any, string."""
    out = F.lit("string")
    for kinds, name in [*JOINS.items(), *((frozenset([k]), k) for k in KINDS)]:
        out = F.when(bits == sum(BIT[k] for k in kinds), name).otherwise(out)
    return out


def discover(df: DataFrame, name: str, blank: tuple[str, ...] = ("",)) -> DataFrame:
    """A row per column of a table of text: position, type that fits, rows, nulls (and blanks), longest text, up to three samples.

    Kinds of values are bits that tasks or together, and samples are least digests, so one pass and a constant
    state a column do for tables of any size. Values are trimmed for their kind.
    """
    facts = []
    for i, c in enumerate(df.columns):
        text = F.col(f"`{c}`").cast("string")
        held = F.when(~F.trim(text).isin(*blank), text)
        digest = F.md5(held)
        samples = [F.min(F.when(F.substring(digest, 1, 1).isin(*part), F.struct(digest.alias("d"), held.alias("v"))))["v"] for part in THIRDS]
        facts.append(F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.lit(i + 1).alias("position"), _type(F.bit_or(F.when(held.isNotNull(), _kind(F.trim(held))))).alias("type"),
                              F.count("*").alias("row_count"), F.count_if(held.isNull()).alias("null_count"), F.max(F.length(held)).alias("longest"), F.filter(F.array(*samples), lambda x: x.isNotNull()).alias("samples")))
    return df.agg(F.array(*facts).alias("f")).select(F.inline("f"))


def ddl(discovered: DataFrame) -> DataFrame:
    """table_name and the statement that makes a table of the types found."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("position", "column_name", "type", "null_count"))), lambda x: F.concat(F.lit("`"), x["column_name"], F.lit("` "), x["type"], F.when(x["null_count"] == 0, " NOT NULL").otherwise("")))
    return discovered.groupBy("table_name").agg(parts.alias("_p")).select("table_name", F.concat(F.lit("CREATE TABLE "), "table_name", F.lit(" ("), F.array_join("_p", ", "), F.lit(")")).alias("statement"))


def read_checked(spark: SparkSession, path: str, schema: str, fmt: str = "csv", **options) -> DataFrame:
    """Rows of delimited text or JSON lines, with `corrupt_record` (the line, where it doesn't fit the schema) and `file_name`."""
    reader = spark.read.schema(f"{schema}, corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt_record")
    options = {"header": True, "enforceSchema": False} | options if fmt == "csv" else options
    df = reader.options(**options).format(fmt).load(path)
    whole = F.xxhash64(*[c for c in df.columns if c != "corrupt_record"]) % 2 > -2  # holds for every row: a line is judged by all columns, whichever are used
    return df.filter(whole).select("*", F.col("_metadata.file_name").alias("file_name"))


def bad_row_report(checked: DataFrame, samples: int = 10) -> DataFrame:
    """A row per file: rows, bad rows, and the least bad lines in order of their digests as samples."""
    key = F.struct(F.md5("corrupt_record"), "corrupt_record")
    rows = checked.groupBy("file_name").agg(F.count("*").alias("row_count"), F.count("corrupt_record").alias("bad_rows"))
    some = checked.filter("corrupt_record is not null").select("file_name", "corrupt_record").distinct()
    some = some.withColumn("_at", F.row_number().over(Window.partitionBy("file_name").orderBy(key))).filter(F.col("_at") <= samples)
    some = some.groupBy("file_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "corrupt_record"))), lambda x: x["corrupt_record"]).alias("samples"))
    return rows.join(some, "file_name", "left")
