"""From documents to token ids: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import scratch_path, table, unpacked
from panelforge.llm.mixing import mix_sources, mixed_documents
from panelforge.llm.ngram_join import one_per_component
from panelforge.llm.secrets import redacted
from panelforge.llm.sentencepiece import encoded
from panelforge.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on `labels`, rejects go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return one_per_component(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets within texts give way to a mark; all documents stay."""
    return redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row per document and pass over its source."""
    return mixed_documents(mix_sources(docs, keep=docs.columns), docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    keep = ["doc_id", "lang", "source"]
    return unpacked(encoded(docs, keep), keep, F.size("ids").cast("long").alias("n_tokens"), F.col("ids"), F.col("same").alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("mix_sources", mix),
    ("sentencepiece", tokenize),
]

#: The classifier, the permutations and the encoder have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
