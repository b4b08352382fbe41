"""Uniform sharding with exact shard sizes, by a hypergeometric communication matrix.

Rows lie in logical partitions (by hash, whatever the files). How many rows each partition sends to
each shard is drawn exactly: partitions are halved again and again, and each half's share of every
shard is a hypergeometric draw given the shares above it. Each partition then permutes its rows and
deals them out by its row of the matrix; after the exchange each shard permutes what it has got.
Shard sizes differ by one at most. DataFrame functions only. The matrix is drawn in levels of FAN parts
each, so that a task holds FAN sizes at a time, however many partitions there are.

Defined results: a null text has no bytes; rows that are equal in all key columns are
interchangeable, and every row is dealt on its own: equal texts may go to different shards, as the
sizes' law leaves no room for keeping a group of a third of all rows together; a very long text
counts by its bytes; an empty table gives no rows; other columns ride along, whatever their names,
and are ignored where only the shards are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import let, numbered, staged, unit


def _log_factorial(x: Column) -> Column:
    """ln x! by Stirling's series at x + 8, with the factors between divided out."""
    z = x + 8.0
    rise = F.lit(0.0)
    for i in range(1, 8):
        rise = rise + F.log(x + float(i))
    series = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return series - rise


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of `drawn` of `total` rows are among the `marked`, by inversion of u in [0, 1).

    The weights of all counts within 9 standard deviations (and 12) of the mean are summed; what
    lies beyond has less than 1e-18 of the mass.
    """
    t, m, n = (c.cast("double") for c in (total, marked, drawn))
    mean = F.when(t > 0, n * m / t).otherwise(0.0)
    sd = F.when(t > 1, F.sqrt(F.greatest(F.lit(0.0), mean * (t - m) / t * (t - n) / (t - 1)))).otherwise(0.0)
    reach = 9 * sd + 12
    lo = F.greatest(F.lit(0.0), n - (t - m), F.floor(mean - reach)).cast("long")
    hi = F.least(m, n, F.ceil(mean + reach)).cast("long")

    def weigh(k: Column) -> Column:
        k = k.cast("double")
        return -(_log_factorial(k) + _log_factorial(m - k) + _log_factorial(n - k) + _log_factorial(t - m - n + k))

    def pick(logs: Column) -> Column:
        weights = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
        return let(weights, lambda w: let(
            u * F.aggregate(w, F.lit(0.0), lambda a, x: a + x),
            lambda goal: F.aggregate(w, F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("at")), lambda a, x: F.struct((a["sum"] + x).alias("sum"), (a["at"] + (a["sum"] + x <= goal).cast("long")).alias("at")), lambda a: F.least(a["at"], F.size(w).cast("long") - 1)),
        ))

    return F.when(lo >= hi, lo).otherwise(lo + let(F.transform(F.sequence(lo, F.greatest(lo, hi)), weigh), pick))


def split_shares(shares: Column, drawn: Column, seed: Column) -> Column:
    """How many of each share go to `drawn` rows of their whole: a multivariate hypergeometric draw."""
    start = F.struct(F.aggregate(shares, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), drawn.cast("long").alias("left"), F.array().cast("array<bigint>").alias("out"))

    def step(a: Column, j: Column) -> Column:
        share = F.get(shares, j)
        return let(hypergeometric(a["total"], share, a["left"], unit(seed, j)), lambda x: F.struct((a["total"] - share).alias("total"), (a["left"] - x).alias("left"), F.concat(a["out"], F.array(x)).alias("out")))

    return F.aggregate(F.sequence(F.lit(0), F.size(shares) - 1), start, step, lambda a: a["out"])


FAN = 10  # bits of a node's number that one level of the matrix draws


def communication_matrix(sizes: DataFrame, n_partitions: int, n_shards: int, total: int, seed: int) -> DataFrame:
    """sizes: _part, _rows. Returns _part, _ends: the running sums of what it sends to shard 0, 1, ...

    n_partitions is a power of two. Each level splits every node into up to 2 ** FAN parts by
    halving; nodes of a level are drawn in as many tasks as they are hashed to.
    """
    spark, left = sizes.sparkSession, n_partitions.bit_length() - 1
    capacity = [total // n_shards + (j < total % n_shards) for j in range(n_shards)]
    nodes = spark.range(1).select(F.col("id").alias("_node"), F.array(*[F.lit(c).cast("long") for c in capacity]).alias("_shares"))
    while left:
        bits = min(FAN, left)
        left -= bits
        child = F.shiftright(F.col("_part").cast("long"), left)
        rows = sizes.groupBy(child.alias("_child")).agg(F.sum("_rows").alias("_rows"))
        inner = rows.groupBy(F.shiftright("_child", bits).alias("_parent")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("_child").bitwiseAND((1 << bits) - 1), "_rows"))).alias("_map"))
        nodes = nodes.join(inner, F.col("_node") == F.col("_parent"), "left").repartition("_node")
        zero = F.lit(0).cast("long")
        nodes = nodes.select("_node", "_shares", F.transform(F.sequence(zero, F.lit((1 << bits) - 1).cast("long")), lambda i: F.coalesce(F.element_at("_map", i), zero)).alias("_sizes"))
        for width in (1 << k for k in range(bits - 1, -1, -1)):
            first = F.aggregate(F.slice("_sizes", 1, width), zero, lambda a, x: a + x)
            nodes = nodes.withColumn("_left", split_shares(F.col("_shares"), first, F.xxhash64(F.lit(seed), F.lit(left), F.lit(width), "_node")))
            halves = F.array(
                F.struct((F.col("_node") * 2).alias("_node"), F.slice("_sizes", 1, width).alias("_sizes"), F.col("_left").alias("_shares")),
                F.struct((F.col("_node") * 2 + 1).alias("_node"), F.slice("_sizes", width + 1, width).alias("_sizes"), F.zip_with("_shares", "_left", lambda a, b: a - b).alias("_shares")),
            )
            nodes = nodes.select(F.inline(halves))
        nodes = nodes.select("_node", "_shares")
    ends = F.transform(F.sequence(F.lit(1), F.lit(n_shards)), lambda j: F.aggregate(F.slice("_shares", F.lit(1), j), F.lit(0).cast("long"), lambda a, x: a + x))
    return nodes.select(F.col("_node").cast("int").alias("_part"), ends.alias("_ends"))


def shuffle_to_shards(rows: DataFrame, key: list[str], n_shards: int = 8, partition_rows: int = 50_000, seed: int = 1) -> DataFrame:
    """row (a struct of all columns), shard (0 .. n_shards-1) and slot (0, 1, ... within the shard), uniformly shuffled.

    key: columns whose values tell rows apart; rows alike in them are interchangeable. `rows` is
    read three times: hand over a table, or a staged frame.
    """
    total = rows.count()
    n_partitions = 1 << max(5, (max(1, -(-total // partition_rows)) - 1).bit_length())
    rows = rows.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in rows.columns]).alias("row"))
    k = [F.col(f"row.`{c}`") for c in key]
    placed = rows.withColumn("_part", F.pmod(F.xxhash64(F.lit(seed), *k), F.lit(n_partitions)).cast("int"))
    matrix = communication_matrix(placed.groupBy("_part").agg(F.count("*").alias("_rows")), n_partitions, n_shards, total, seed)
    matrix = staged(matrix, "shard-matrix")
    local = F.row_number().over(Window.partitionBy("_part").orderBy(F.xxhash64(F.lit(seed + 1), *k), *k)) - 1
    dealt = placed.withColumn("_rank", local).join(matrix, "_part")
    dealt = dealt.select("row", F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))).alias("shard"))
    return numbered(dealt, ["shard"], [F.xxhash64(F.lit(seed + 2), *k), *k], -(-total // n_shards), partition_rows, "slot")


def shard_documents(docs: DataFrame, n_shards: int = 8, seed: int = 1) -> DataFrame:
    """The shard and slot of every document, with its size and checksum."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    narrow = staged(docs.select("doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).cast("long").alias("text_crc32")), "shard-rows")
    out = shuffle_to_shards(narrow, ["doc_id", "size", "text_crc32"], n_shards, seed=seed)
    return out.select("row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(rows: DataFrame, key: list[str], path: str, n_shards: int = 8, seed: int = 1) -> None:
    """Writes whole rows (the struct `row`, with `slot`), shuffled, to one folder a shard, in order of slot within each file."""
    out = shuffle_to_shards(rows, key, n_shards, seed=seed)
    files = 4 * n_shards
    out.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
