"""Exact Jaccard self-join on word shingles, by prefixes under several global token orders.

A text's set holds its distinct 5-word shingles as 52-bit hashes. Texts with equal sets form one
class and are joined as one. For a threshold t, two sets that link share a token among the first
n - ceil(t n) + 1 of each, whatever global order of tokens is used, so a pair must share such a
prefix token under every one of several orders:

* tokens seen in many texts go last in every order, so a passage that many texts share is no
  prefix token of a text with enough words of its own. Any fixed set of tokens may go last without
  losing a link; this one is a Bloom filter over tokens that repeat within slices of the table, from
  a number of repeats on (HOT, more where the filter would fill up);
* of the others a fixed part, by hash, goes first in every order, rarer tokens before others. Only
  those need frequencies, and only tokens that two classes have can be shared at all: one shuffle
  of that part finds them, and everything else stays where it is;
* the orders differ in how they break ties: by exact frequency, by its magnitude, or not at all
  beyond "in one class only". A class whose unshared tokens fill its prefix has no candidates.

Links are looked for in two passes. The first verifies, for each class, the two partners with which it
shares most of its rarest prefix tokens (neighbours by size and each token's hub), and unions them. It
only proposes: what it leaves out is left to the second, which verifies every candidate pair that isn't
in one component yet, so no link between components is lost, while a group of thousands of alike
texts isn't expanded into all its pairs. There, tokens of one component only go before the others
in every order, and a pair is taken at its smallest common prefix token only, as far as the BEFORE smallest
of both tell: tokens are hashes, so two prefixes that share many tokens have one among those. Verification compares whole sets. Before that a pair must pass sketches: the parities of how many of a
set's tokens fall into each of some buckets. Parities differ in no more buckets than the two sets
differ in tokens, so no link fails, while texts that share no more than a common passage do. A narrow
sketch of 512 parities is looked at within the join, a wide one of about four a token after it.

Defined results: A-Z count as a-z; a text of 1 to 4 words has one shingle, all of them; a null text
or one without words has none and links with nothing; a null doc_id takes part, and its component
is the smallest doc_id reached (null if there is none); repeated rows are rows of their own; a very
long text is hashed in parts, and needs 8 bytes a word of it several times over; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import bounded_batches, dropped, staged
from panelforge.llm.components import connected_components, merged_components
from panelforge.llm.textvec import TOKEN_BITS, batches_of_bytes, distinct, mixed, prefix_sums, shingle_hashes, word_hashes

SETS = "doc_id long, row long, n int, cls long, often array<long>, times array<int>"
POSTS = "token long, cls long, n int, n_first int, n_hot int, kind tinyint"
FIRST = 5  # sixteenths of the hash space go first in every order
HOT = 64  # repeats from which a token goes last in every order
SALTS = 64  # parts of a frequent token's group in the first pass
LEAD, REST, COMMON = 0, 1, 2  # kinds of posted tokens: first part, other rare ones, frequent ones
SKETCH = 8  # words of 64 parities each in the narrow sketch
SKETCH_COLUMNS = [f"s{i}" for i in range(SKETCH)]
WIDEST = 1 << 17  # parities at most of a wide sketch
RAREST = 8  # prefix tokens of a class through which the first pass looks for partners
BEFORE = 8  # smallest prefix tokens of a class that are looked at for an earlier meeting
FILTER_BITS = (16, 27)  # a Bloom filter has 2 ** 16 bits at least and 2 ** 27 (16 MB) at most
BLOCK_WORDS = 1 << 14  # of a filter, that come to the driver as one row


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """n - ceil(t n) + 1, in whole numbers."""
    return n - (n * percent + 99) // 100 + 1


def slices_of(batches: Iterator[pa.RecordBatch], column: int, wanted=None) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as bytes; only rows that `wanted(batch)` marks, if given."""
    for batch in batches:
        if wanted is not None:
            batch = batch.filter(pa.array(wanted(batch)))
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        for i, j in batches_of_bytes(sizes.tolist()):
            rows = batch.slice(i, j - i)
            yield rows, [t or b"" for t in rows.column(column).to_pylist()]


def _class_keys(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """An order-free 64-bit key of each set: the mixed sum of its mixed members, and its size."""
    total = prefix_sums(mixed(h ^ np.uint64(0x5851F42D4C957F2D)))
    return mixed(total[begin[1:]] - total[begin[:-1]] + np.diff(begin).astype(np.uint64)).view(np.int64)


class Bloom:
    """A filter of 2 ** bits bits in which each key sets two: its lower bits, and those from bit 32 on."""

    def __init__(self, data: bytes, bits: int):
        self.data, self.bits = data, bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        flags, mask = np.frombuffer(self.data, np.uint8), np.uint64((1 << self.bits) - 1)
        hit = np.ones(len(keys), bool)
        for part in (keys & mask, (keys >> np.uint64(32)) & mask):
            hit &= (flags[(part >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (part & np.uint64(7)).astype(np.uint8))) & np.uint8(1) == 1
        return hit


def _bytes_of(words: pa.Table) -> pa.Table:
    """A block's words as bytes."""
    out = np.zeros(BLOCK_WORDS, ">u4")
    out[words.column("_word").to_numpy() % BLOCK_WORDS] = words.column("_bits").to_numpy().astype(np.uint32)
    return pa.table([words.column("_block").combine_chunks()[:1], pa.array([out.tobytes()])], names=["_block", "_bytes"])


def bloom_of(keys: DataFrame, column: str, count: int) -> Bloom:
    """A filter for `count` keys, of 16 bits a key up to the largest size. Beyond that it lets more through.

    Tasks make words of 32 bits, Spark or-s equal words, and tasks put them into blocks of bytes: the driver gets a row a block,
    as a row a word takes it some hundred bytes for four.
    """
    bits = min(max((16 * max(count, 1) - 1).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    mask = (1 << bits) - 1
    at = F.array(F.col(column).bitwiseAND(mask), F.shiftrightunsigned(column, 32).bitwiseAND(mask))
    words = keys.select(F.explode(at).alias("_at")).select(F.floor(F.col("_at") / 32).alias("_word"), F.expr("shiftleft(1L, cast(31 - _at % 32 as int))").alias("_bit"))
    words = words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits")).withColumn("_block", F.floor(F.col("_word") / BLOCK_WORDS))
    out = bytearray(1 << (bits - 3))
    for r in words.groupBy("_block").applyInArrow(_bytes_of, "_block long, _bytes binary").collect():
        at = 4 * BLOCK_WORDS * r["_block"]
        part = r["_bytes"][: len(out) - at]
        out[at : at + len(part)] = part
    return Bloom(bytes(out), bits)


def _often(h: np.ndarray, begin: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of tokens that two classes of a slice have, and in how many of its classes."""
    one = np.zeros(len(cls), bool)
    one[np.unique(cls, return_index=True)[1]] = True
    token = np.sort(h[np.repeat(one, np.diff(begin))])
    at = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, np.int64)
    times = np.diff(np.concatenate((at, [len(token)])))
    return mixed(token[at[times > 1]]).view(np.int64), times[times > 1].astype(np.int32)


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Set size and class of each text; with a slice's first row, the tokens that repeat in the slice."""
    for rows, texts in slices_of(batches, 2):
        h, begin = distinct(*shingle_hashes(*word_hashes(texts), size))
        cls, gaps = _class_keys(h, begin), [None] * (rows.num_rows - 1)
        key, times = _often(h, begin, cls)
        often, times = pa.array([key, *gaps], pa.list_(pa.int64())), pa.array([times, *gaps], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(np.diff(begin).astype(np.int32)), pa.array(cls), often, times], names=["doc_id", "row", "n", "cls", "often", "times"])


def frequent_tokens(signed: DataFrame, label: str = "shingle-frequent") -> tuple[DataFrame, int]:
    """token: keys of tokens that repeat within slices, HOT times or more in all; and how many they are.

    If they are more than the largest filter is made for, the least number of repeats goes up by powers of two.
    """
    rows = signed.filter("often is not null").select(F.explode(F.arrays_zip("often", "times")).alias("_o")).select(F.col("_o.often").alias("token"), F.col("_o.times").alias("_n"))
    rows = staged(rows.groupBy("token").agg(F.sum("_n").alias("_n")).filter(F.col("_n") >= HOT), label)
    levels = rows.groupBy(F.floor(F.log2("_n")).cast("int").alias("level")).count().orderBy(F.desc("level")).collect()  # 63 rows at most
    total, least = 0, 63
    for r in levels:
        if total and total + r["count"] > 1 << (FILTER_BITS[1] - 4):
            break
        total, least = total + r["count"], r["level"]
    return rows.filter(F.col("_n") >= F.lit(1 << min(least, 62)).cast("long")).select("token"), total


def _post(batches: Iterator[pa.RecordBatch], size: int, percent: int, frequent) -> Iterator[pa.RecordBatch]:
    """Postings of each text: all its tokens of the first part.

    If those don't fill the prefix, also the smallest of its other rare tokens, then the smallest of
    its frequent ones, which is how every order goes on.
    """
    bloom, limit = frequent.value, np.uint64(FIRST << (TOKEN_BITS - 4))
    for _, texts in slices_of(batches, 1):
        token, begin = distinct(*shingle_hashes(*word_hashes(texts), size))
        n, cls = np.diff(begin), _class_keys(token, begin)
        doc = np.repeat(np.arange(len(n)), n)
        kind = np.where(bloom.has(mixed(token)), COMMON, np.where(token < limit, LEAD, REST))
        order = np.argsort(doc * 3 + kind, kind="stable")
        token, kind = token[order], kind[order]
        n_first, n_hot = (np.bincount(doc[kind == k], minlength=len(n)) for k in (LEAD, COMMON))
        post = np.maximum(n_first, prefix_length(n, percent))
        keep = np.arange(len(doc)) - begin[doc] < post[doc]
        d = doc[keep]
        columns = [token[keep].view(np.int64), cls[d], *(x[d].astype(np.int32) for x in (n, n_first, n_hot)), kind[keep].astype(np.int8)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "cls", "n", "n_first", "n_hot", "kind"])


def sketches(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """A row of packed bits for each set: whether an odd number of its tokens is in each bucket."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = row * bits + (np.concatenate(sets) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=len(sets) * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(-1, bits), axis=1)


def wide_sketch(tokens: np.ndarray) -> bytes:
    """A sketch of about four parities a token, 512 at least."""
    bits = min(max(64 * SKETCH, 1 << (4 * len(tokens) - 1).bit_length()), WIDEST)
    return sketches([tokens], bits)[0].tobytes()


def _candidate_sets(batches: Iterator[pa.RecordBatch], size: int, documents, classes) -> Iterator[pa.RecordBatch]:
    """Class, set (as bytes) and sketches of texts whose document and class may be wanted, by Bloom filters."""

    def wanted(batch: pa.RecordBatch) -> np.ndarray:
        return documents.value.has(batch.column(0).to_numpy().view(np.uint64))

    for _, texts in slices_of(batches, 1, wanted):
        h, begin = distinct(*shingle_hashes(*word_hashes(texts), size))
        cls = _class_keys(h, begin)
        hit = np.flatnonzero(classes.value.has(cls.view(np.uint64)) & (np.diff(begin) > 0))
        first = hit[np.sort(np.unique(cls[hit], return_index=True)[1])]
        if len(first):
            sets = [h[begin[i] : begin[i + 1]] for i in first]
            narrow = sketches(sets, 64 * SKETCH).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cls[first]), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([wide_sketch(s) for s in sets], pa.binary()), *[pa.array(w) for w in narrow.T.copy()]], names=["cls", "n", "set", "wide", *SKETCH_COLUMNS])


def shared_tokens(posts: DataFrame) -> DataFrame:
    """The posted tokens that two classes have, with df; one shuffle of the rare postings.

    Copies of a class post the same rows: those are dropped after singletons have gone. Frequent
    tokens are taken as shared, and count as HOT, so that their postings aren't gathered by token.
    """
    w = Window.partitionBy("token")
    rare = posts.filter(F.col("kind") != COMMON)
    counted = rare.select("*", F.min("cls").over(w).alias("_lo"), F.max("cls").over(w).alias("_hi"), F.count("*").over(w).alias("df"))
    counted = counted.filter("_lo <> _hi").drop("_lo", "_hi").dropDuplicates(["token", "cls"])
    common = posts.filter(F.col("kind") == COMMON).dropDuplicates(["token", "cls"]).withColumn("df", F.lit(HOT).cast("long"))
    return counted.unionByName(common)


def _placed(rows: DataFrame, percent: int) -> DataFrame:
    """Marks in_1, in_2, in_3: whether a token is in its class's prefix under each order.

    Those of a class's n_first tokens that aren't in `rows` precede the others in every order; a class
    whose prefix they fill is out. Tokens of the rest are posted only as far as the prefix may
    reach, and come after all of the first part.
    """
    mine = Window.partitionBy("cls")
    rest = F.col("kind") != LEAD
    p = F.expr(f"n - cast(floor((n * {percent}L + 99) / 100) as int) + 1")
    df = F.when(rest, F.lit(0)).otherwise(F.col("df"))
    lone = F.col("n_first") - F.sum((~rest).cast("int")).over(mine)
    rows = rows.withColumns({"_p": p, "_lone": lone}).filter(rest | (F.col("_lone") < F.col("_p")))
    for k, key in enumerate((df, F.when(rest, 0).otherwise(F.floor(F.log2("df"))), F.lit(0)), 1):
        tie = F.col("token") if k == 1 else F.xxhash64(F.lit(k), "token")
        at = F.row_number().over(mine.orderBy("kind", key, F.when(rest, F.col("token")).otherwise(tie), "token"))
        rows = rows.withColumn(f"in_{k}", rest | (at <= F.col("_p") - F.col("_lone")))
        rows = rows.withColumn("at", at) if k == 1 else rows
    return rows


def prefixes(shared: DataFrame, percent: int) -> DataFrame:
    """Shared tokens of classes that may link: token, cls, n, n_first, kind, df, in_1, in_2, in_3, at, hub.

    hub: how common the class's tokens are for its size.
    """
    mine = Window.partitionBy("cls")
    rare = F.sum(F.when(F.col("kind") == COMMON, F.lit(0)).otherwise(F.col("df"))).over(mine)
    return _placed(shared.withColumn("hub", (rare + F.col("n_hot") * HOT) / F.col("n")), percent).select("token", "cls", "n", "n_first", "kind", "df", "in_1", "in_2", "in_3", "at", "hub")


def first_partners(marked: DataFrame, percent: int, keep: int) -> DataFrame:
    """a, b: for each class up to `keep` partners, those with which it shares most of its rarest prefix tokens.

    In a token's group a class meets its neighbour by size and the group's hub: the class whose
    tokens are common in the corpus for its size. Where texts are edits of one original, that is
    the original, which is nearer to each of them than they are to each other. The group of a
    frequent token is split by class for the neighbours; its hub joins the parts.
    """
    part = F.when(F.col("kind") == COMMON, F.pmod("cls", F.lit(SALTS))).otherwise(F.lit(0))
    w = Window.partitionBy("token", "_part").orderBy("n", "cls")
    rare = marked.filter(F.col("in_1") & (F.col("at") <= RAREST)).select("token", "cls", "n", "hub", part.alias("_part"))
    hubs = rare.groupBy("token").agg(F.max(F.struct("hub", "cls", "n")).alias("_h"), F.count("*").alias("_n")).filter("_n > 1")
    hubs = hubs.select("token", F.struct(F.col("_h.cls").alias("cls"), F.col("_h.n").alias("n")).alias("_o"))
    near = rare.select("cls", "n", F.lag(F.struct("cls", "n")).over(w).alias("_o"))
    pairs = near.unionByName(rare.join(hubs, "token").select("cls", "n", "_o"))
    pairs = pairs.filter(f"_o is not null and _o.cls <> cls and _o.n * 100L >= n * {percent}L and n * 100L >= _o.n * {percent}L")
    counted = pairs.groupBy("cls", F.col("_o.cls").alias("_b")).agg(F.count("*").alias("_n"))
    best = F.row_number().over(Window.partitionBy("cls").orderBy(F.desc("_n"), "_b"))
    return counted.withColumn("_rank", best).filter(F.col("_rank") <= keep).select(F.least("cls", "_b").alias("a"), F.greatest("cls", "_b").alias("b")).distinct()


def open_postings(marked: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """The prefix tokens that classes of different components share: token, cls, n, root, in_1..3, at, main.

    A class's tokens that no other component has precede the rest in every order, as unshared ones do.
    main: the token's component with most links.
    """
    sized = roots.groupBy("root").agg(F.count("*").alias("_size"))
    roots = roots.join(sized, "root")
    at = marked.join(roots, F.col("cls") == F.col("node"), "left").select("token", "cls", "n", "n_first", "kind", "df", F.coalesce("root", "cls").alias("root"), F.coalesce("_size", F.lit(1)).alias("_size"))
    main = at.groupBy("token").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"), F.max(F.struct("_size", "root")).alias("_m")).filter("_lo <> _hi")
    many = at.join(main.select(F.col("token").alias("_token"), F.col("_m.root").alias("main")), F.col("token") == F.col("_token")).drop("_token", "_size")
    return _placed(many, percent).filter("in_1 or in_2 or in_3").select("token", "cls", "n", "root", "in_1", "in_2", "in_3", "at", "main")


def meetings(at: DataFrame, narrow: DataFrame, percent: int) -> DataFrame:
    """a, b of open postings' classes of different components that share a prefix token under the first order.

    In a token's group only members outside its main component start pairs, so a group that is
    nearly one component is not expanded. The join is by token and size band: a pair's sizes are in the same band
    or in adjacent ones. Pairs that fail in size or by their sketches, and those that meet at a smaller
    token, are dropped within the join. A smaller token that both classes list is one at which they do
    meet, so no pair is lost; one whose lists have none in common comes once for each token that it shares.
    """
    differ = sum((F.bit_count(F.col(f"x.{s}").bitwiseXOR(F.col(f"y.{s}"))) for s in SKETCH_COLUMNS), F.lit(0))
    n, n2 = F.col("x.n").cast("long"), F.col("y.n").cast("long")
    near = (n * 100 >= n2 * percent) & (n2 * 100 >= n * percent) & (differ * (100 + percent) <= (n + n2) * (100 - percent)) & ~F.arrays_overlap("x.before", "y.before")
    band = F.floor(F.log("n") / float(np.log(100 / percent) * 1.001)) if percent < 100 else F.col("n").cast("long")

    mine = Window.partitionBy("cls")
    live = at.filter("in_1").withColumn("_nth", F.row_number().over(mine.orderBy("token")))
    live = live.withColumn("_least", F.collect_list(F.when(F.col("_nth") <= BEFORE, F.col("token"))).over(mine))
    live = live.withColumn("before", F.filter("_least", lambda t: t < F.col("token"))).drop("_least", "_nth", "in_1", "in_2", "in_3", "at")
    live = live.join(narrow, "cls").withColumn("_band", band)
    some = live.filter("root <> main").drop("main").withColumn("_band", F.explode(F.array(*(F.col("_band") + i for i in (-1, 0, 1)))))
    on = (F.col("x.token") == F.col("y.token")) & (F.col("x._band") == F.col("y._band")) & (F.col("x.root") != F.col("y.root"))
    once = (F.col("x.root") == F.col("x.main")) | (F.col("x.cls") < F.col("y.cls"))  # else the pair comes from both sides
    both = live.alias("x").join(some.alias("y").hint("merge"), on & once & near)
    return both.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"))


def open_pairs(marked: DataFrame, roots: DataFrame, narrow: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of classes of different components that share prefix tokens under every order.

    The meetings under the first order are intersected with the other orders' prefixes.
    """
    at = staged(open_postings(marked, roots, percent), "shingle-open")
    pairs = meetings(at, narrow, percent).distinct()
    held = at.groupBy("cls").agg(*[F.collect_list(F.when(F.col(f"in_{k}"), F.col("token"))).alias(f"p{k}") for k in (2, 3)])
    x, y = (held.select(F.col("cls").alias(s), F.col("p2").alias(f"_{s}2"), F.col("p3").alias(f"_{s}3")) for s in "ab")
    pairs = pairs.join(x, "a").join(y, "b").filter(F.arrays_overlap("_a2", "_b2") & F.arrays_overlap("_a3", "_b3"))
    return pairs.select("a", "b")


def _may_link(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """a, b of the pairs that pass their wide sketches; columns: a, b, na, nb, wa, wb. A larger sketch is folded."""
    for batch in batches:
        a, b, na, nb, wa, wb = (batch.column(i) for i in range(6))
        keep = []
        for n, m, u, v in zip(na.to_pylist(), nb.to_pylist(), wa, wb):
            u, v = (np.frombuffer(s.as_buffer(), np.uint8) for s in (u, v))
            size = min(len(u), len(v))
            u, v = (np.bitwise_xor.reduce(s.reshape(-1, size), 0) for s in (u, v))
            keep.append(int(np.bitwise_count(u ^ v).sum()) * (100 + percent) <= (n + m) * (100 - percent))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])


def _agree(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """a, b of the pairs whose sets link; the pairs of some megabytes of sets are counted by one sort."""
    for batch in batches:
        a, b, x, y = (batch.column(i) for i in range(4))
        sizes = (pc.add(pc.binary_length(x), pc.binary_length(y)).to_numpy()).tolist()
        for i, j in batches_of_bytes(sizes):
            s, t = (c.slice(i, j - i) for c in (x, y))
            n, m = (pc.binary_length(c).to_numpy() // 8 for c in (s, t))
            pair = np.arange(j - i, dtype=np.uint64) << np.uint64(TOKEN_BITS)
            keys = np.concatenate([np.frombuffer(b"".join(c.to_pylist()), np.uint64) | np.repeat(pair, k) for c, k in ((s, n), (t, m))])
            keys.sort()
            twice = keys[1:][keys[1:] == keys[:-1]] >> np.uint64(TOKEN_BITS)
            same = np.bincount(twice.astype(np.int64), minlength=j - i)
            mask = pa.array(100 * same >= percent * (n + m - same))
            yield pa.RecordBatch.from_arrays([a.slice(i, j - i).filter(mask), b.slice(i, j - i).filter(mask)], names=["a", "b"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int, label: str) -> DataFrame:
    """Those of the pairs whose whole sets link. Sets are shuffled only for pairs that pass their wide sketches."""
    side = lambda s: sets.select(F.col("cls").alias(s), F.col("n").alias(f"_n{s}"), F.col("wide").alias(f"_w{s}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "_na", "_nb", "_wa", "_wb")
    near = staged(near.mapInArrow(partial(_may_link, percent=percent), "a long, b long"), "shingle-near")
    names = near.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    some = sets.select("cls", "set").join(names, "cls", "left_semi")
    left, right = some.select(F.col("cls").alias("a"), F.col("set").alias("_x")), some.select(F.col("cls").alias("b"), F.col("set").alias("_y"))
    full = near.join(left, "a").join(right, "b").select("a", "b", "_x", "_y")
    out = staged(full.mapInArrow(partial(_agree, percent=percent), "a long, b long"), label)
    dropped(near)
    return out


def signed_rows(docs: DataFrame, size: int = 5, percent: int = 80, partners: int = 2) -> DataFrame:
    """A row per document: doc_id, row (a hash of doc_id and text), n, root (null without shingles), id (the component's)."""
    sc = docs.sparkSession.sparkContext
    bounded_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("row"), text.cast("binary").alias("text"))
    signed = staged(rows.mapInArrow(partial(_sign, size=size), SETS), "shingle-classes")
    frequent, count = frequent_tokens(signed)
    frequent = sc.broadcast(bloom_of(frequent, "token", count))
    posts = rows.select("doc_id", "text").mapInArrow(partial(_post, size=size, percent=percent, frequent=frequent), POSTS)
    marked = staged(prefixes(shared_tokens(posts), percent), "shingle-prefixes")

    candidates = marked.select(F.col("cls").alias("_cls")).distinct()
    named = signed.filter("n > 0").join(candidates, F.col("cls") == F.col("_cls")).groupBy("cls").agg(F.min("row").alias("row"))
    named = staged(named, "shingle-candidates")
    count = named.count()
    documents, classes = (sc.broadcast(bloom_of(named, c, count)) for c in ("row", "cls"))
    sets = rows.select("row", "text").mapInArrow(partial(_candidate_sets, size=size, documents=documents, classes=classes), f"cls long, n int, set binary, wide binary, {', '.join(f'{s} long' for s in SKETCH_COLUMNS)}")
    sets = staged(sets.join(named.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]), "shingle-sets")

    links = verified(first_partners(marked, percent, partners), sets, percent, "shingle-links")
    roots = connected_components(links, "a", "b")
    more = verified(open_pairs(marked, roots, sets.select("cls", *SKETCH_COLUMNS), percent), sets, percent, "shingle-links")
    dropped(marked), dropped(sets), dropped(named)
    roots = merged_components(roots, more)

    classes = signed.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("_doc")).join(roots, F.col("cls") == F.col("node"), "left")
    classes = classes.select(F.col("cls").alias("_cls"), "_doc", F.coalesce("root", "cls").alias("root"))
    best = classes.groupBy("root").agg(F.min("_doc").alias("id"))
    named = classes.join(best, "root").select("_cls", "root", "id")
    return signed.select("doc_id", "row", "n", "cls").join(named, (F.col("cls") == F.col("_cls")) & (F.col("n") > 0), "left").select("doc_id", "row", "n", "root", "id")


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id."""
    rows = signed_rows(docs, **options)
    return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_per_component(docs: DataFrame, **options) -> DataFrame:
    """`docs` less those that link to, or through others reach, one that comes before them.

    The first row of a component has its smallest doc_id (a null is last), and among equals the
    smallest hash of its text; of rows equal in both any one stays. Rows without shingles stay.
    """
    rows = signed_rows(docs, **options).filter("n > 0").select("doc_id", "row", "root")
    least = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("_first"))
    kept = least.select(F.col("_first.row").alias("_kept"))
    gone = rows.join(kept, F.col("row") == F.col("_kept"), "left_anti")
    verdict = staged(gone.select("row", F.lit(False).alias("_keep")).distinct().unionByName(kept.select(F.col("_kept").alias("row"), F.lit(True).alias("_keep")).distinct()), "shingle-verdicts")
    text = F.col("text").cast("string")
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("_at"))
    both = carried.join(verdict, F.col("_at") == F.col("row"), "left")
    rank = F.row_number().over(Window.partitionBy("_at").orderBy(F.lit(1)))
    both = both.withColumn("_rank", rank).filter("_keep is null or (_keep and _rank = 1)")
    return both.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
