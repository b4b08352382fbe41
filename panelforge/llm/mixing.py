"""Mixing sources to target weights.

The words of each source form one stream, cut into blocks of a fixed length. The mix has as many
slots as its targets have blocks, dealt to output shards; each slot of a shard draws its source, so
a shard's source counts are multinomial. Draws beyond a source's quota pass to sources below
theirs, so that the totals meet the targets. The slots of a source are then mapped through a
pseudorandom permutation of its block indexes, a new one each time the source has been used up,
and blocks are joined by index. A source's last slot takes only as many of its block's words as the target still
lacks, so every source is met to the word; a pass over part of a source takes its short last block last.
DataFrame functions only.

Defined results: a null text has no words; a source of null is a source of its own, last in order;
documents of size 0 are never taken; rows that are equal in doc_id and size are interchangeable;
a very long text is cut into blocks like any other; an empty table gives an empty mix. Other columns are
ignored, whatever their names.

Rows that `explode` makes don't count in Spark's size estimates, so joins with them say that they
are to be merged; otherwise a side that grows with the data would be broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from panelforge.llm.common import n_words, numbered, staged, words

def _all() -> WindowSpec:
    """All rows of a table with one row a source or shard."""
    return Window.partitionBy(F.lit(0))


@dataclass(frozen=True)
class Mix:
    """documents: _uid, doc_id, source, size (and the kept columns). sources: _sid, source,
    source_size, target, _blocks, _slots. counts: _shard, _sid, n. slots: _shard, _sid, _epoch, _block, _take
    (words of the block, from its first). pieces: _sid, _block, _uid, _first (word of the document), _from (word of the block), _words."""

    documents: DataFrame
    sources: DataFrame
    counts: DataFrame
    slots: DataFrame
    pieces: DataFrame


def source_targets(documents: DataFrame, weights: tuple[float, ...], cap: float, block_words: int) -> DataFrame:
    """One row a source: targets share the total by weight, none above `cap` times its source.

    With sources in order of cap / weight, the first whose cap covers what the rest leave by weight
    sets the level; targets are then the lesser of cap and level * weight.
    """
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    by_name = _all().orderBy(F.col("source").asc_nulls_last())
    s = documents.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
    s = s.withColumn("_sid", F.row_number().over(by_name) - 1)
    s = s.withColumn("_w", F.element_at(wheel, (F.col("_sid") % len(weights) + 1).cast("int")))
    s = s.withColumn("_cap", F.col("source_size") * float(cap)).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    by_ratio = _all().orderBy("_ratio", "_sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(_all()) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    rest = F.sum("_w").over(_all()) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    s = s.withColumn("_level", F.when(left / rest <= F.col("_ratio"), left / rest)).withColumn("_rank", F.row_number().over(by_ratio))
    level = F.min(F.when(F.col("_level").isNotNull(), F.struct("_rank", "_level"))).over(_all())["_level"]
    s = s.withColumn("target", F.coalesce(F.least(F.col("_cap"), level * F.col("_w")), F.lit(0.0)))
    s = s.withColumn("_blocks", F.ceil(F.col("source_size") / block_words))
    words = F.round("target").cast("long")
    s = s.withColumn("_full", F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0))
    s = s.withColumn("_rest", words - F.col("_full") * F.col("source_size"))  # words of the last pass
    s = s.withColumn("_slots", (F.col("_full") * F.col("_blocks") + F.ceil(F.col("_rest") / block_words)).cast("long"))
    return s.select("_sid", "source", "source_size", "target", "_docs", "_blocks", "_full", "_rest", "_slots")


def shard_counts(sources: DataFrame, total: int, shard_slots: int, seed: int) -> DataFrame:
    """Multinomial source counts for each shard, settled to the sources' quotas."""
    spark = sources.sparkSession
    width = max(1, -(-total // 1024))
    hi = F.sum("_slots").over(_all().orderBy("_sid"))
    spans = sources.select("_sid", "_slots", (hi - F.col("_slots")).alias("_lo"), hi.alias("_hi")).filter("_slots > 0")
    bins = spans.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_lo") / width), F.floor((F.col("_hi") - 1) / width))))
    draws = spark.range(total).select(F.floor(F.col("id") / shard_slots).alias("_shard"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, total))).alias("_x"))
    draws = draws.withColumn("_bin", F.floor(F.col("_x") / width))
    drawn = draws.join(bins.select("_bin", "_lo", "_hi", "_sid"), "_bin").filter("_x >= _lo and _x < _hi").groupBy("_shard", "_sid").agg(F.count("*").alias("n"))
    drawn = drawn.join(sources.select("_sid", "_slots"), "_sid")
    upto = F.sum("n").over(Window.partitionBy("_sid").orderBy("_shard"))
    kept = F.greatest(F.lit(0), F.least(F.col("n"), F.col("_slots") - upto + F.col("n")))
    drawn = staged(drawn.select("_shard", "_sid", "n", kept.alias("kept")), "mix-draws")

    def units(df: DataFrame, key: str, amount: str) -> DataFrame:
        end = F.sum(amount).over(_all().orderBy(key))
        return df.select(key, amount, end.alias("_end")).filter(f"{amount} > 0").select(key, F.explode(F.sequence(F.col("_end") - F.col(amount), F.col("_end") - 1)).alias("_unit"))

    surplus = units(drawn.groupBy("_shard").agg(F.sum(F.col("n") - F.col("kept")).alias("_over")), "_shard", "_over")
    got = drawn.groupBy("_sid").agg(F.sum("kept").alias("_got"))
    short = units(sources.join(got, "_sid", "left").select("_sid", (F.col("_slots") - F.coalesce("_got", F.lit(0))).alias("_under")), "_sid", "_under")
    moved = surplus.join(short.hint("merge"), "_unit").select("_shard", "_sid", F.lit(1).cast("long").alias("kept"))
    return drawn.select("_shard", "_sid", "kept").unionByName(moved).groupBy("_shard", "_sid").agg(F.sum("kept").alias("n"))


def permuted(position: Column, size: Column, key: Column, rounds: int = 24) -> Column:
    """A pseudorandom permutation of 0 .. size-1, computed index by index.

    Each round pairs x with (k - x) mod size and swaps the pair or not by a hash of its larger
    member: a bijection for any size, with no table and no retry.
    """

    def one(x: Column, i: Column) -> Column:
        k = F.pmod(F.xxhash64(i, key), size)
        y = F.pmod(k - x, size)
        return F.when(F.xxhash64(i, F.greatest(x, y), key).bitwiseAND(1) == 1, y).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), position.cast("long"), one)


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0, block_words: int = 64, shard_slots: int = 65536, seed: int = 1, keep: list[str] | None = None) -> Mix:
    """Mixes the rows of `docs` (doc_id, source, text). keep: columns of `docs` to carry along."""
    extra = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")] if keep else []
    base = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), *extra)
    documents = staged(base.withColumn("_uid", F.monotonically_increasing_id()), "mix-documents")
    sources = staged(source_targets(documents, weights, cap, block_words), "mix-sources")
    sums = sources.agg(F.sum("_slots"), F.sum("_docs")).first()
    total, n_docs = int(sums[0] or 0), int(sums[1] or 0)

    counts = staged(shard_counts(sources, total, shard_slots, seed), "mix-counts")
    first = F.coalesce(F.sum("n").over(Window.partitionBy("_sid").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = counts.withColumn("_first", first).join(sources.select("_sid", "_blocks", "_full", "_rest", F.floor(F.col("source_size") / block_words).alias("_even")), "_sid").filter("n > 0")
    runs = runs.repartition(max(12, -(-total // 100_000)), "_sid", "_shard")
    slots = runs.withColumn("_slot", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("n") - 1)))
    slots = slots.withColumn("_epoch", F.floor(F.col("_slot") / F.col("_blocks")))
    slots = slots.withColumn("_at", F.col("_slot") - F.col("_epoch") * F.col("_blocks"))
    part = F.col("_epoch") == F.col("_full")
    among = F.greatest(F.when(part, F.col("_even")).otherwise(F.col("_blocks")), F.lit(1))
    block = F.when(part & (F.col("_at") >= F.col("_even")), F.col("_at")).otherwise(permuted(F.col("_at"), among, F.xxhash64(F.lit(seed), "_sid", "_epoch")))
    take = F.when(part, F.least(F.lit(block_words), F.col("_rest") - F.col("_at") * block_words)).otherwise(block_words)
    slots = slots.select("_shard", "_sid", "_epoch", block.alias("_block"), take.cast("long").alias("_take"))

    placed = documents.select("_uid", "doc_id", "source", "size").filter("size > 0")
    placed = numbered(placed, ["source"], [F.xxhash64(F.lit(seed), "doc_id", "size"), F.col("doc_id"), F.col("size"), F.col("_uid")], n_docs, 20_000, "_start", F.col("size"))
    placed = placed.join(sources.select(F.col("source").alias("_name"), "_sid"), F.col("source").eqNullSafe(F.col("_name")))
    b = F.explode(F.sequence(F.floor(F.col("_start") / block_words), F.floor((F.col("_start") + F.col("size") - 1) / block_words)))
    pieces = placed.select("_sid", "_uid", "_start", "size", b.alias("_block"))
    lo = F.greatest(F.col("_start"), F.col("_block") * block_words)
    hi = F.least(F.col("_start") + F.col("size"), (F.col("_block") + 1) * block_words)
    pieces = pieces.select("_sid", "_block", "_uid", (lo - F.col("_start")).alias("_first"), (lo - F.col("_block") * block_words).alias("_from"), (hi - lo).alias("_words"))
    return Mix(documents, sources, counts, slots, pieces)


def _taken() -> Column:
    """Words of a piece that a slot takes."""
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("_words"), F.col("_take") - F.col("_from")))


def taken_words(mix: Mix) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken, source."""
    times = mix.slots.groupBy("_sid", "_block", "_take").agg(F.count("*").alias("_times"))
    taken = mix.pieces.join(times.hint("merge"), ["_sid", "_block"]).groupBy("_uid").agg(F.sum(_taken() * F.col("_times")).alias("taken"))
    out = mix.documents.select("_uid", "doc_id", "source", "size").join(taken.hint("merge"), "_uid", "left")
    names = mix.sources.select(F.col("source").alias("_name"), "source_size", "target")
    out = out.join(names, F.col("source").eqNullSafe(F.col("_name")))
    return out.select("doc_id", F.col("size").cast("long"), F.col("source_size").cast("long"), "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")


def mixed_blocks(mix: Mix) -> DataFrame:
    """The mix itself: a row per slot and piece: _shard, source id, epoch, block, the piece's words.

    `mix` must have been made with keep=["text"].
    """
    rows = mix.slots.join(mix.pieces.hint("merge"), ["_sid", "_block"]).withColumn("_got", _taken()).filter("_got > 0").join(mix.documents.select("_uid", F.col("_row.text").alias("_text")).hint("merge"), "_uid")
    piece = F.slice(words(F.col("_text")), (F.col("_first") + 1).cast("int"), F.col("_got").cast("int"))
    return rows.select(F.col("_shard").alias("shard"), F.col("_sid").alias("source_id"), F.col("_epoch").alias("epoch"), F.col("_block").alias("block"), F.col("_first").alias("first_word"), piece.alias("words"))


def mixed_documents(mix: Mix, columns: list[str]) -> DataFrame:
    """The mix as documents: one row per document and pass over its source, with what that pass took.

    A document that a pass took whole keeps its text; of others the taken words are joined by
    blanks. Documents of which nothing was taken are out. `mix` must keep `columns`.
    """
    took = mix.slots.join(mix.pieces.hint("merge"), ["_sid", "_block"]).withColumn("_w", _taken()).filter("_w > 0").groupBy("_uid", "_epoch")
    took = took.agg(F.sum("_w").alias("_got"), F.sort_array(F.collect_list(F.struct("_first", F.col("_w").alias("_words")))).alias("_parts"))
    out = mix.documents.join(took.hint("merge"), "_uid")
    split = words(F.col("_row.text"))
    part = F.transform(F.array(split), lambda w: F.flatten(F.transform(F.col("_parts"), lambda p: F.slice(w, (p["_first"] + 1).cast("int"), p["_words"].cast("int")))))[0]
    text = F.when(F.col("_got") == F.col("size"), F.col("_row.text")).otherwise(F.array_join(part, " "))
    out = out.select("_row", text.alias("_text"))
    special = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return out.select(*[special.get(c, F.col(f"_row.`{c}`")).alias(c) for c in columns])
