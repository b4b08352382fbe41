"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from panelforge.llm.common import dropped, staged


def connected_components(links: DataFrame, a: str, b: str, label: str = "components") -> DataFrame:
    """node, root: each linked node with the smallest node that links reach from it.

    Large-star and small-star steps in turn until the links are stars: every node points at its
    smallest neighbour's smallest. Each round is written to the shared folder, and the one before
    deleted. A node of many links is joined with one row of its minimum, which Spark can split;
    nothing is gathered per node. Nulls and loops are ignored.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    e = staged(e, label)
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        k = low.select(F.col("u").alias("k"), "m")
        small = large.join(k, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        facts = Observation()
        small = small.filter("u <> v").distinct().observe(facts, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"))
        before, e = e, staged(small, label)
        dropped(before)
        now = (facts.get["n"], facts.get["sum"])
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = now


def merged_components(roots: DataFrame, more: DataFrame, label: str = "components") -> DataFrame:
    """node, root after further links a, b: only the roots that these touch are gone through again."""
    of = lambda s: roots.select(F.col("node").alias(s), F.col("root").alias(f"_{s}"))
    lifted = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    above = connected_components(lifted, "a", "b", label).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    old = roots.join(above, F.col("root") == F.col("_node"), "left").select("node", F.coalesce("_root", "root").alias("root"))
    new = above.join(roots.select("node"), F.col("_node") == F.col("node"), "left_anti").select(F.col("_node").alias("node"), F.col("_root").alias("root"))
    return old.unionByName(new)
