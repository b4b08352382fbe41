"""Phrase collocations from count streams kept in prefix and in suffix order.

Counting. Phrases of 1 to 5 words are counted per language in three passes over the texts: words, pairs,
then three to five words. Tasks count within buffers of some megabytes, Spark sums the buffers' rows by
language and phrase and keeps counts of `min_count` and more. A phrase can't be frequent where one
of its words or pairs isn't, so the later passes leave out what the frequent words and pairs (in Bloom
filters of 16 MB at most) rule out. A filter that is too full lets more phrases through, which costs
shuffle and loses nothing.

Streams. The counts form one stream of (language, words, count), whose order is first that of the words
(prefix order), then that of the reversed words (suffix order). In prefix order a phrase stands behind
all its first parts and before all its extensions to the right; windows over that one sort go through the
stream in lockstep and give each phrase the counts of its first parts and its most frequent extension.
Suffix order gives the last parts and the extensions to the left. Single words, which hot words' phrases
share by the million, are merge-joined to the pairs and longer phrases in the same two orders. A phrase
lies within a longer one of the same count only if it has a one-word extension of that count.

Scores are whole numbers: decimals of 38 digits, divided without rounding.

Defined results: a null text is empty and gives nothing; a null language is `und`; equal texts count as
often as they occur; a language without candidates has no rows; ties rank by phrase in UTF-8 byte order;
a very long text is hashed in parts, cut where words end; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import bounded_batches, dropped, staged
from panelforge.llm.ngram_join import bloom_of
from panelforge.llm.textvec import _ODD, Words, bytes_in, mixed

LONGEST = 5
BUFFER_BYTES = 1 << 24
SALTS = 64
BROADCAST_LANGS = 100_000
BREAKS = bytes_in(b".,;:!?\n\x0b\x0c\r")
GAPS = BREAKS | bytes_in(b" \t")
COUNTS = "lang string, phrase string, size int, f long"


def _words(texts: list[bytes], lang: str) -> Words:
    return Words(texts, GAPS, BREAKS, zlib.crc32(lang.encode()))


def _counts(w: Words, places: np.ndarray, keys: np.ndarray, size: int) -> tuple[pa.Array, int, np.ndarray]:
    _, first, times = np.unique(keys, return_index=True, return_counts=True)
    return w.phrases(places[first], size), size, times


def _pairs(w: Words, words_filter) -> tuple[np.ndarray, np.ndarray]:
    """Where a pair within a piece begins whose words may both be frequent, and its hash."""
    fit = words_filter.has(w.hashes)
    at = np.flatnonzero(fit[:-1] & fit[1:] & (w.pieces[:-1] == w.pieces[1:])) if len(fit) else np.zeros(0, np.int64)
    return at, _longer(w.hashes[at], w.hashes[at + 1])


def _longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(h * _ODD + word)


def _of_words(w: Words):
    yield pa.array([None], pa.string()), 0, np.array([len(w.hashes)])
    yield _counts(w, np.arange(len(w.hashes)), w.hashes, 1)


def _of_pairs(w: Words, sent):
    yield _counts(w, *_pairs(w, sent.value[0]), 2)


def _of_longer(w: Words, sent):
    words_filter, pairs_filter = sent.value
    at, h = _pairs(w, words_filter)
    fit = pairs_filter.has(h)
    at, h = at[fit], h[fit]
    pair = np.zeros(len(w.hashes) + LONGEST, bool)
    pair[at] = True
    for size in range(3, LONGEST + 1):
        more = pair[at + size - 2]  # the next pair is frequent, too, and in the same piece
        at, h = at[more], h[more]
        h = _longer(h, w.hashes[at + size - 1])
        yield _counts(w, at, h, size)


def _count(batches: Iterator[pa.RecordBatch], what) -> Iterator[pa.RecordBatch]:
    """Rows of COUNTS for every buffer of texts (column 1, bytes) of one language (column 0)."""

    def rows(held):
        for lang, texts in held.items():
            for phrases, size, times in what(_words(texts, lang)):
                for i in range(0, len(times), 1 << 16):
                    k = min(len(times) - i, 1 << 16)
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, k), phrases.slice(i, k), pa.array(np.full(k, size, np.int32)), pa.array(times[i : i + k].astype(np.int64))], names=["lang", "phrase", "size", "f"])

    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                held.setdefault(lang, []).append(text)
                size += len(text)
        if size > BUFFER_BYTES:
            yield from rows(held)
            held, size = {}, 0
    yield from rows(held)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of words and pairs (columns lang, phrase), as the passes over the texts make them."""
    for batch in batches:
        langs, phrases = batch.column(0), batch.column(1)
        for lang in langs.unique().to_pylist():
            w = _words([p.encode() for p in phrases.filter(pc.equal(langs, lang)).to_pylist()], lang)
            key, two = w.hashes[w.first[:-1]], np.diff(w.first) == 2
            key[two] = _longer(key[two], w.hashes[w.first[:-1][two] + 1])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])


def _filter(frequent: DataFrame):
    return bloom_of(frequent.select("lang", "phrase").mapInArrow(_hash, "key long"), "key", frequent.count())


def _counted(texts: DataFrame, what, min_count: int, label: str) -> DataFrame:
    """lang, phrase, size, f of the frequent phrases. The row without a phrase counts all words."""
    counts = texts.mapInArrow(partial(_count, what=what), COUNTS).groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    return staged(counts.filter((F.col("f") >= min_count) | (F.col("size") == 0)), label)


def _ancestors(stream: DataFrame, w: str, singles: DataFrame, part: str, longest: str) -> DataFrame:
    """Adds `part` (counts of the first 1, 2, ... words in this order) and `longest` (of extensions by one word).

    `w`: the array of words in the order wanted. The stream is dealt by ranges and sorted once; all windows
    go along that order.
    """
    columns = [f"_w{i}" for i in range(LONGEST)]
    alone = singles.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_word"), F.col("f").alias("_f1"))
    out = stream.withColumns({c: F.get(w, F.lit(i)) for i, c in enumerate(columns)})
    out = out.join(alone.hint("merge"), (F.col("lang") == F.col("_lang")) & (F.col("_w0") == F.col("_word"))).drop("_lang", "_word")
    out = out.repartitionByRange("lang", "_w0", "_w1")
    found, longer = [F.col("_f1")], F.lit(None).cast("long")
    for k in range(2, LONGEST):
        group = Window.partitionBy("lang", *columns[:k])
        within = group.orderBy(*[F.col(c).asc_nulls_first() for c in columns[k:]])
        out = out.withColumn(f"_f{k}", F.first("a").over(within))  # the phrase of k words stands first among those that begin with it
        out = out.withColumn(f"_x{k}", F.max(F.when(F.col("size") == k + 1, F.col("a"))).over(group))
        found.append(F.col(f"_f{k}"))
        longer = F.when(F.col("size") == k, F.col(f"_x{k}")).otherwise(longer)
    out = out.withColumns({part: F.slice(F.array(*found), F.lit(1), F.col("size") - 1), longest: longer})
    return out.drop(*columns, *[f"_f{k}" for k in range(1, LONGEST)], *[f"_x{k}" for k in range(2, LONGEST)])


def _lowest_cut() -> Column:
    """score, k, l, r of the cut that scores lowest. Of the first parts' counts, the k-th; of the last parts', that of the other words."""
    exact = lambda c: c.cast("decimal(19,0)")
    over = F.lit(1000).cast("decimal(4,0)") * exact(F.col("a")) * F.col("n").cast("decimal(15,0)")

    def cut(left: Column, i: Column) -> Column:
        right = F.element_at("lasts", F.col("size") - 1 - i)
        product = exact(left) * exact(right)
        whole = (over - F.try_mod(over, product)) / product
        return F.struct(whole.cast("decimal(38,0)").cast("long").alias("score"), (i + 1).alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform("firsts", cut))


def collocations(docs: DataFrame, min_count: int = 100, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's phrases of two to five words that score highest."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))

    words = _counted(texts, _of_words, min_count, "phrase-words")
    singles, totals = words.filter("size = 1"), words.filter("size = 0").select(F.col("lang").alias("_lang"), F.col("f").alias("n"))
    filters = [_filter(singles)]
    pairs = _counted(texts, partial(_of_pairs, sent=spark.sparkContext.broadcast(filters)), min_count, "phrase-pairs")
    filters = [*filters, _filter(pairs)]
    longer = _counted(texts, partial(_of_longer, sent=spark.sparkContext.broadcast(filters)), min_count, "phrase-longer")

    stream = pairs.unionByName(longer).select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    stream = _ancestors(stream, "w", singles, "firsts", "to_right")
    stream = _ancestors(stream.withColumn("w", F.reverse("w")), "w", singles, "lasts", "to_left")
    alone = (F.coalesce("to_right", F.lit(0)) < F.col("a")) & (F.coalesce("to_left", F.lit(0)) < F.col("a"))
    small = totals.count() <= BROADCAST_LANGS  # a row a language
    stream = stream.filter(alone).join(F.broadcast(totals) if small else totals, F.col("lang") == F.col("_lang"))
    scored = stream.select("lang", "phrase", "a", "n", _lowest_cut().alias("cut")).select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = scored.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))  # a language's leaders are among its salts' leaders
    best = best.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("_at") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    out = staged(best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases")
    dropped(words, pairs, longer)
    return out
