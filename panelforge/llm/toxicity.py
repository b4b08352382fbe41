"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams of the lower-cased text (code points, white space as
one blank). Each gets the log ratio of its smoothed shares among documents of either label; the
n-grams with the strongest ratios become the model's features, their ratios its scales, and
logistic regression (Spark's, distributed) weighs them. The model is a table of at most
`max_features` n-grams, so that it can be sent to every task; scoring reads whole texts.

Labels: a document's label is its largest non-null `toxic`; rows that are held out are never read
for training. At most `max_rows` labelled documents, the smallest by hash of doc_id, are fitted.

Defined results: a null text is empty; an empty text gets the model's score without any feature;
without training rows of both labels every score is 0; where no n-gram is in `min_texts` sample
texts every score is the share of label 1; a null doc_id is not held out and has no label; labels of
absent documents and null labels are ignored, repeated ones count once; repeated rows get one score;
very long texts are scored whole, at some 100 bytes a character while they are; an empty table gives
no rows; other columns are carried or ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from panelforge.llm.common import bounded_batches, carried, staged, unpacked
from panelforge.llm.textvec import mixed

ORDERS = (3, 4, 5)
FILTER_BITS = 22


@dataclass(frozen=True)
class Model:
    """keys: sorted hashes of the features; weights: scale times coefficient; bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' code points, each text within blanks, runs of white space as one; and each one's text."""
    whole = [f" {' '.join(t.lower().split())} " for t in texts]
    sizes = np.array([len(t) for t in whole], np.int64)
    return np.frombuffer("".join(whole).encode("utf-32-le", "surrogatepass"), np.uint32), np.repeat(np.arange(len(whole)), sizes)


def ngram_hashes(points: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the hashes of all n-grams within texts, and their texts."""
    p = points.astype(np.uint64)
    h = np.zeros(len(p), np.uint64)
    for k in range(max(ORDERS)):
        if len(p) <= k:
            return
        h = (h[: len(p) - k] if k else h) * np.uint64(0x100000001B3) + p[k:] + np.uint64(1)
        if k + 1 in ORDERS:
            inside = doc[: len(p) - k] == doc[k:]
            yield mixed(h[inside] + np.uint64(k)), doc[: len(p) - k][inside]


def _slices(texts: list[str], limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield at, i
            at, size = i, 0
        size += len(t) + 2
    if at < len(texts):
        yield at, len(texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """gram, in how many texts of label 1 and of label 0; texts are columns 0, labels 1."""
    for batch in batches:
        texts, labels = [t or "" for t in batch.column(0).to_pylist()], np.array(batch.column(1).to_pylist(), np.int64)
        for i, j in _slices(texts):
            grams, docs = [], []
            for h, d in ngram_hashes(*_code_points(texts[i:j])):
                # a bijection of the n-gram for each text: equal keys are the same n-gram of the same text
                _, once = np.unique(mixed(h + mixed(d.astype(np.uint64) + np.uint64(1))), return_index=True)
                grams.append(h[once])
                docs.append(d[once])
            if grams:
                g, d = np.concatenate(grams), np.concatenate(docs)
                keys, at = np.unique(g, return_inverse=True)
                ones = np.bincount(at, labels[i:j][d], len(keys))
                both = np.bincount(at, minlength=len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ones.astype(np.int64)), pa.array((both - ones).astype(np.int64))], names=["gram", "ones", "zeros"])


def _filter_of(keys: np.ndarray) -> np.ndarray:
    flags = np.zeros(1 << FILTER_BITS, bool)
    flags[(keys & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
    return flags


def _found(texts: list[str], keys: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, index of a feature that it has)."""
    out = []
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    for h, d in ngram_hashes(*_code_points(texts)):
        near = flags[(h & np.uint64(len(flags) - 1)).astype(np.int64)]
        h, d = h[near], d[near]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        hit = keys[at] == h
        out.append(d[hit] * len(keys) + at[hit])
    pairs = np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)
    return pairs // len(keys), pairs % len(keys)


def _features(batches: Iterator[pa.RecordBatch], keys: np.ndarray, ratios: np.ndarray) -> Iterator[pa.RecordBatch]:
    """label and the sparse vector of ratios at the features that the text has; texts are columns 0, labels 1."""
    flags = _filter_of(keys)
    for batch in batches:
        texts, labels = [t or "" for t in batch.column(0).to_pylist()], batch.column(1)
        for i, j in _slices(texts):
            doc, at = _found(texts[i:j], keys, flags)
            offsets = pa.array(np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (at.astype(np.int32), ratios[at])]
            sparse = [pa.array(np.zeros(j - i, np.int8)), pa.array(np.full(j - i, len(keys), np.int32)), *lists]  # the layout of VectorUDT
            yield pa.RecordBatch.from_arrays([labels.slice(i, j - i).cast(pa.float64()), pa.StructArray.from_arrays(sparse, ["type", "size", "indices", "values"])], names=["label", "features"])


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """text and label of the bounded training sample: ids are chosen first, texts come by them."""
    ids = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).cast("int").alias("label"))
    ids = ids.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    some = F.broadcast(ids)  # max_rows rows of two numbers at most
    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(some, "doc_id").select("text", "label"), "toxic-sample")


def ranked_ngrams(sample: DataFrame, ones: int, zeros: int, alpha: float, min_texts: int) -> DataFrame:
    """gram, ratio (log of its smoothed shares among texts of label 1 and 0), strength (ratio times their difference)."""
    counts = sample.mapInArrow(_count, "gram long, ones long, zeros long").groupBy("gram").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    p, q = (F.col("ones") + alpha) / (ones + 2 * alpha), (F.col("zeros") + alpha) / (zeros + 2 * alpha)
    return counts.filter(F.col("ones") + F.col("zeros") >= min_texts).select("gram", F.log(p / q).alias("ratio"), F.abs(F.log(p / q) * (p - q)).alias("strength"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 16000, max_features: int = 8192, min_texts: int = 3, alpha: float = 1.0, l2: float = 1e-3) -> Model | None:
    bounded_batches(docs.sparkSession)
    sample = labelled(docs, labels, max_rows)
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    spread = sample.repartition(max(8, sample.rdd.getNumPartitions()))
    ranked = ranked_ngrams(spread, n[1], n[0], alpha, min_texts)
    best = ranked.orderBy(F.desc("strength"), "gram").limit(max_features).toPandas()  # the model: bounded by max_features
    keys = best["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, ratios = keys[order], best["ratio"].to_numpy(np.float64)[order]
    if not len(keys):
        return Model(keys, ratios, float(np.log(n[1] / n[0])))

    vectors = StructType().add("label", DoubleType()).add("features", VectorUDT())
    rows = spread.mapInArrow(partial(_features, keys=keys, ratios=ratios), vectors).persist()
    fitted = LogisticRegression(maxIter=40, regParam=l2, standardization=False).fit(rows)
    rows.unpersist()
    return Model(keys, fitted.coefficients.toArray() * ratios, float(fitted.intercept))


def scores_of(texts: list[str], model: Model | None, flags: np.ndarray | None = None) -> np.ndarray:
    out = np.zeros(len(texts))
    if model is None:
        return out
    flags = _filter_of(model.keys) if flags is None else flags
    for i, j in _slices(texts):
        doc, at = _found(texts[i:j], model.keys, flags)
        z = np.bincount(doc, model.weights[at], j - i) + model.bias
        out[i:j] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    return out


def _score(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """Columns: the row and its text. Gives the row and its score."""
    model = sent.value
    flags = _filter_of(model.keys) if model else None
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores_of(texts, model, flags))], names=["row", "score"])


def scored(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """row (a struct of the `keep` columns of docs) and score."""
    bounded_batches(docs.sparkSession)
    rows = carried(docs, keep)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(partial(_score, sent=sent), StructType().add(rows.schema["row"]).add("score", DoubleType()))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    s = scored(docs, train(docs, labels, **options), ["doc_id"])
    doc_id = F.col("row.doc_id")
    return s.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """`docs` less the rows that the classifier rejects; all columns stay as they are."""
    s = scored(docs, train(docs, labels, **options), docs.columns)
    return unpacked(s.filter(F.col("score") < threshold), docs.columns)
