"""Connected components of a table of links, for components of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connlens.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node, itself included) of every node that `links` (a, b: long) name.

    Large-star and small-star steps in turn: each step is a minimum by node, combined before the shuffle, joined back to the links.
    The table never has more rows than links, and every round is written, so that lineage stays short and lost executors cost
    one round at most. The rounds end when no link changes.
    """
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    pairs = written(pairs, "links")
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = written(moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        found = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if found == state:
            break
        state = found
    nodes = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
