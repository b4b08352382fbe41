"""Quality rules whose thresholds come from the corpus.

Each signal of a document is compared with fences of its own language and source. The fences come
from quantile sketches: counts of values in logarithmic buckets, 1 % apart, one sketch per language,
source and signal, merged to one per language for groups with few rows. Such counts add up in any
order, so the same rows always give the same fences. A fence lies `reach` times the distance between median and outer quartile beyond
that quartile, and at least `slack` beyond it, so that a group of alike documents loses none of
them. DataFrame functions only.

Defined results: a null text has no words and fails the base rule; null languages and sources form
groups of their own; very long texts are taken whole, in arrays of their words within one row;
repeated rows count as often as they occur and get equal verdicts; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import BLANKS, let, staged, without, words

#: Fixed value.
SYMBOLS = "#*$%&|<>"
#: Signal: lower fence, upper fence, least distance of a fence from its quartile.
BASE, NONE = 1.01, -(1 << 30)
RULES = {"word_len": (True, True, 1.5), "symbol_rate": (False, True, 0.1), "dup_line_rate": (False, True, 0.25), "repeat_rate": (False, True, 0.25)}


def repeated_words(word_list: Column) -> Column:
    """Words in 3-word windows that occur at least twice in the text.

    Windows are told apart by 64-bit hashes, sorted with their positions; windows with an equal
    neighbour are repeats.
    """

    def count(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
        hit = let(F.array_sort(windows), lambda s: F.filter(s, lambda x, i: F.coalesce((i > 0) & (F.get(s, i - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))))
        return F.size(F.array_distinct(F.flatten(F.transform(hit, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    return F.when(F.size(word_list) < 4, 0).otherwise(let(word_list, count)).cast("long")


def text_signals(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text.alias("_text"))
    d = d.withColumn("_words", words(F.col("_text")))
    lines = F.filter(F.split("_text", "\n"), lambda x: without(x, BLANKS) != "")
    return d.select(
        "doc_id", "lang", "source",
        F.size("_words").cast("long").alias("n_words"),
        F.length(without(F.col("_text"), BLANKS)).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(without(F.col("_text"), SYMBOLS))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
    )


def with_rates(signals: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return signals.withColumns({"word_len": F.col("word_chars") / n, "symbol_rate": F.col("n_symbols") / n, "dup_line_rate": F.col("n_dup_lines") / n * 10, "repeat_rate": F.col("n_repeat_words") / n})


def bucket_counts(rated: DataFrame) -> DataFrame:
    """lang, source, signal, bucket, n: the sketches. Bucket k holds values from BASE ** k up to the next; NONE holds 0."""
    bucket = lambda v: F.when(v > 0, F.floor(F.log(v) / math.log(BASE)).cast("int")).otherwise(NONE)
    items = F.array(*[F.struct(F.lit(s).alias("signal"), bucket(F.col(s)).alias("bucket")) for s in RULES])
    return rated.select("lang", "source", F.inline(items)).groupBy("lang", "source", "signal", "bucket").agg(F.count("*").alias("n"))


def quartiles(counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, signal, rows, q1, q2, q3 of sketches: the middles of the buckets that hold the quartiles."""
    whole = Window.partitionBy(*keys, "signal")
    upto, total = F.sum("n").over(whole.orderBy("bucket")), F.sum("n").over(whole)
    value = F.when(F.col("bucket") == NONE, 0.0).otherwise(F.pow(F.lit(BASE), F.col("bucket") + 0.5))
    placed = counts.select(*keys, "signal", upto.alias("_upto"), total.alias("_total"), value.alias("_value"))
    return placed.groupBy(*keys, "signal").agg(F.max("_total").alias("rows"), *[F.min(F.when(4 * F.col("_upto") >= k * F.col("_total"), F.col("_value"))).alias(f"q{k}") for k in (1, 2, 3)])


def fences(rated: DataFrame, reach: float, least_rows: int) -> DataFrame:
    """A row per language and source: <signal>_lo, <signal>_hi of its own sketch, or of its language's."""
    counts = staged(bucket_counts(rated), "quality-sketches")
    own = quartiles(counts, ["lang", "source"])
    wider = quartiles(counts.groupBy("lang", "signal", "bucket").agg(F.sum("n").alias("n")), ["lang"])
    wider = wider.select(F.col("lang").alias("_lang"), F.col("signal").alias("_signal"), *[F.col(f"q{k}").alias(f"_q{k}") for k in (1, 2, 3)])
    both = own.join(wider, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("signal") == F.col("_signal")))
    q1, q2, q3 = (F.when(F.col("rows") >= least_rows, F.col(f"q{k}")).otherwise(F.col(f"_q{k}")) for k in (1, 2, 3))
    out = []
    for s, (low, high, slack) in RULES.items():
        mine = F.col("signal") == s
        lo, hi = q1 - F.greatest(F.lit(slack), reach * (q2 - q1)), q3 + F.greatest(F.lit(slack), reach * (q3 - q2))
        out += [F.max(F.when(mine, lo if low else F.lit(float("-inf")))).alias(f"{s}_lo"), F.max(F.when(mine, hi if high else F.lit(float("inf")))).alias(f"{s}_hi")]
    return both.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(*out)


def quality_verdicts(docs: DataFrame, reach: float = 6.0, least_rows: int = 50, least_words: int = 50) -> DataFrame:
    """Base signals and verdict of every document.

    base_failed: fewer than `least_words` words, or more than half of them in repeated windows.
    Thresholds are taken over documents that pass the base rule; a group without any takes its
    language's, and a language without any sets no further limits.
    """
    rated = staged(with_rates(text_signals(docs)), "quality-signals")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    limits = fences(rated.filter(~failed), reach, least_rows)
    on = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    judged = rated.withColumn("base_failed", failed).join(limits, on, "left")
    ok = F.lit(True)
    for s in RULES:
        ok = ok & F.coalesce(F.col(s).between(F.col(f"{s}_lo"), F.col(f"{s}_hi")), F.lit(True))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ok).alias("kept"))
