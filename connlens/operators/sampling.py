"""Samples without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from connlens.functions import in_hash_sample, key_hash
from connlens.sources.storage import cut_lineage

_PREFIX = 4  # hex digits per refinement step: at most 65,536 groups in a histogram
_KEY_DIGITS = 32
_ROW_DIGITS = 32


def sample_fraction(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample. The rows depend on the seed and on how the input is partitioned."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_fraction_hash(df: DataFrame, key: str | Column, fraction: float, seed: int) -> DataFrame:
    """Sample by a hash of the key: the same rows on every run and after any repartitioning."""
    return df.filter(in_hash_sample(key, fraction, seed))


def sample_ratio(
    df: DataFrame, key: str, hit: Column | str, fraction: float, seed: int, digits: int = 3
) -> DataFrame:
    """Share of the rows that meet a predicate: estimated from the sample, and exact beside it."""
    hit = F.expr(hit) if isinstance(hit, str) else hit
    value = F.when(hit, F.lit(1.0)).otherwise(F.lit(0.0))
    sampled = in_hash_sample(key, fraction, seed)
    return df.agg(
        F.count_if(sampled).alias("sample_rows"),
        F.count(F.lit(1)).alias("total_rows"),
        F.round(F.avg(F.when(sampled, value)), digits).alias("sample_ratio"),
        F.round(F.avg(value), digits).alias("exact_ratio"),
    )


def _of_equal_rows(rows: DataFrame, n: int) -> DataFrame:
    """n rows of a table whose rows are all alike: so many of each written partition."""
    placed = cut_lineage(rows).withColumns(
        {
            "_part": F.spark_partition_id(),
            "_place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1),
        }
    )
    quota = {}
    for part, size in sorted(map(tuple, placed.groupBy("_part").count().collect())):
        quota[part] = min(size, n - sum(quota.values()))
    pairs = [F.lit(x) for pair in quota.items() for x in pair]
    return placed.filter(F.col("_place") < F.element_at(F.create_map(*pairs), F.col("_part"))).drop(
        "_part", "_place"
    )


def sample_exact(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly n rows (all, if there are fewer), chosen by the order of the hashed key.

    Sorting the table or limiting it to a large n would pass the sample through one task. Instead
    the cut-off hash is found digit by digit from histograms of hash prefixes, each of at most
    65,536 groups, and the rows below it are a plain filter. Rows with equal keys are told apart by
    a hash of the whole row; of rows that are equal throughout, any will do. Rows without a key
    have a hash like any other.
    """
    if n <= 0:
        return df.limit(0)
    whole_row = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    hashed = df.withColumn("_hash", key_hash(key, seed))
    prefix, wanted = "", n
    while True:
        if len(prefix) == _KEY_DIGITS:
            hashed = hashed.withColumn("_hash", F.concat("_hash", whole_row))
        length = len(prefix) + _PREFIX
        inside = hashed.select("_hash").filter(F.col("_hash").startswith(prefix))
        groups = inside.groupBy(F.substring("_hash", 1, length).alias("_prefix")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        upto = F.sum("_n").over(W.orderBy("_prefix"))
        cut = (
            groups.withColumn("_upto", upto)
            .filter(F.col("_upto") >= wanted)
            .orderBy("_prefix")
            .limit(1)
            .collect()
        )
        if not cut:
            return df
        prefix, size = cut[0]["_prefix"], cut[0]["_n"]
        wanted -= cut[0]["_upto"] - size
        start = F.substring("_hash", 1, len(prefix))
        if size == wanted:
            return hashed.filter(start <= prefix).drop("_hash")
        if len(prefix) == _KEY_DIGITS + _ROW_DIGITS:
            tail = hashed.filter(start == prefix).drop("_hash")
            return hashed.filter(start < prefix).drop("_hash").unionByName(_of_equal_rows(tail, wanted))
