"""Bag and set operations, and pairs of distinct values.

``subtract``/``exceptAll``/``intersect`` of Spark shuffle or emit all copies of a row in one task.
Here the copies are counted inside each task first, one shuffle carries the counts, and copies
that belong to the result are written out again by many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from connlens.sources.storage import cut_lineage

# Copies of one row that a single output row of the count table stands for.
COPIES_PER_CHUNK = 10_000
# Distinct values of a column in one list.
VALUES_PER_BLOCK = 4_096


def _copy_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    if len(left.columns) != len(right.columns):
        raise ValueError("both tables need the same number of columns")
    right = right.toDF(*left.columns)
    tagged = left.select("*", F.lit(1).alias("_in_left"), F.lit(0).alias("_in_right")).union(
        right.select("*", F.lit(0).alias("_in_left"), F.lit(1).alias("_in_right"))
    )
    return tagged.groupBy(*left.columns).agg(
        F.sum("_in_left").alias("_left"), F.sum("_in_right").alias("_right")
    )


def _repeat(counts: DataFrame, copies: Column, columns: list[str]) -> DataFrame:
    """Each row ``copies`` times. Large counts are cut to chunks that spread over all tasks."""
    full = F.floor((F.col("_copies") - 1) / COPIES_PER_CHUNK).cast("long")
    chunks = (
        counts.withColumn("_copies", copies)
        .filter("_copies > 0")
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), full)))
    )
    size = F.least(F.lit(COPIES_PER_CHUNK), F.col("_copies") - F.col("_chunk") * COPIES_PER_CHUNK)
    return (
        chunks.repartition(*columns, "_chunk")
        .select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("_copy"))
        .drop("_copy")
    )


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of left that are not in right, without duplicates."""
    return _copy_counts(left, right).filter("_left > 0 AND _right = 0").select(*left.columns)


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag difference: each row of right takes away one copy of the equal row of left."""
    counts = _copy_counts(left, right)
    return _repeat(counts, F.col("_left") - F.col("_right"), left.columns)


def intersect_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return _copy_counts(left, right).filter("_left > 0 AND _right > 0").select(*left.columns)


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag intersection: the smaller number of copies."""
    counts = _copy_counts(left, right)
    return _repeat(counts, F.least("_left", "_right"), left.columns)


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both tables with all copies; columns are matched by name."""
    return left.unionByName(right)


def _grid_side(spark: SparkSession) -> int:
    return max(1, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _place(column: str, side: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(side)).cast("int")


def _grid_pairs(values_a: DataFrame, values_b: DataFrame, a: str, b: str, side: int) -> DataFrame:
    """All pairs of two tables of distinct values, with the cell (``_row``, ``_col``) of each."""
    cells = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    rows = values_a.select(a, _place(a, side).alias("_row"), cells.alias("_col"))
    cols = values_b.select(b, _place(b, side).alias("_col"), cells.alias("_row"))
    return rows.join(cols.hint("merge"), ["_row", "_col"])


def cross_values(df: DataFrame, a: str, b: str) -> DataFrame:
    """All pairs of the distinct values of two columns; ``cross_count`` tells their number first.

    The values are made distinct first. Each value of ``a`` then goes to one row of a square grid
    and each value of ``b`` to one column of it, so every pair meets in exactly one cell by an
    ordinary equi-join: no side is broadcast and the cells have equal shares of the product.
    """
    side = _grid_side(df.sparkSession)
    return _grid_pairs(df.select(a).distinct(), df.select(b).distinct(), a, b, side).select(a, b)


def cross_count(df: DataFrame, a: str, b: str, name: str = "pairs") -> DataFrame:
    """Number of pairs of ``cross_values``, without building them (null is a value)."""
    def values(column: str) -> Column:
        has_null = F.max(F.col(column).isNull().cast("int"))
        return F.count_distinct(column) + F.coalesce(has_null, F.lit(0))

    return df.agg((values(a) * values(b)).cast("long").alias(name))


def cross_observed(df: DataFrame, a: str, b: str, name: str = "n") -> DataFrame:
    """Every possible pair with the number of rows that show it, 0 for pairs never seen.

    The rows are counted by pair once, and the counts written: they are the pairs that were seen.
    Values of ``b`` form blocks of about ``VALUES_PER_BLOCK``. Each value of ``a`` meets each block
    with the list of those seen with it, and what the block has beside them is written out there.
    So the product is made and labelled in one place, and is never shuffled, sorted or joined.
    """
    spark = df.sparkSession
    seen = cut_lineage(df.groupBy(a, b).agg(F.count(F.lit(1)).alias(name)))
    blocks = max(1, math.ceil(seen.select(b).distinct().count() / VALUES_PER_BLOCK))
    side = max(1, math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / blocks))
    block = _place(b, blocks).alias("_block")
    in_block = F.struct(F.col(b).alias("value"))  # keeps null in a list

    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block")
    whole = seen.select(a).distinct().select(a, each, F.lit(None).alias("_seen"))
    held = whole.union(seen.select(a, block, in_block)).groupBy(a, "_block").agg(
        F.collect_list("_seen").alias("_seen")
    )
    values = seen.select(b).distinct().groupBy(block).agg(F.collect_list(in_block).alias("_all"))
    rows = F.explode(F.sequence(F.lit(0), F.lit(side - 1))).alias("_row")
    cells = held.withColumn("_row", _place(a, side)).join(
        values.select("_block", "_all", rows), ["_block", "_row"]
    )
    unseen = cells.select(a, F.explode(F.array_except("_all", "_seen")).alias("_pair")).select(
        a, F.col("_pair.value").alias(b), F.lit(0).cast("long").alias(name), F.lit(False).alias("observed")
    )
    return seen.select(a, b, name, F.lit(True).alias("observed")).union(unseen)
