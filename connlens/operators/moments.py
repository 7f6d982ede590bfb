"""Descriptive statistics of numeric columns, whole-table and per label, in one pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.fields import LABEL
from connlens.functions import std_from_variance

_STATISTICS = ("mean", "variance", "std", "min", "max", "count", "nonzeros")


def _statistics(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """(keys, place of the column, statistics): one row per value, then six grouped aggregates.

    One wide aggregate with six expressions per column would be a single huge method, which takes
    longer to compile than to run. Each task still sends one row per key and column only.
    """
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    cells = df.select(*keys, F.posexplode(values).alias("_place", "_value"))
    variance = F.var_samp("_value")
    return cells.groupBy(*keys, "_place").agg(
        F.avg("_value").alias("mean"),
        variance.alias("variance"),
        std_from_variance(variance).alias("std"),
        F.min("_value").alias("min"),
        F.max("_value").alias("max"),
        F.count("_value").alias("count"),
        F.count_if(F.col("_value") != 0).alias("nonzeros"),
    )


def _named(columns: list[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in columns]), F.col("_place")).alias("feature")


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, sample variance, std, min, max, count and nonzeros per column, as a long table.

    An empty table has counts of 0 and no other statistics.
    """
    places = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("_place"))
    found = places.join(_statistics(df, columns, []), "_place", "left")
    shown = [F.coalesce(c, F.lit(0)).alias(c) if c in ("count", "nonzeros") else c for c in _STATISTICS]
    return found.select(_named(columns), *shown)


def column_stats_for_tag(
    df: DataFrame, columns: list[str], value: str, tag: str = LABEL
) -> DataFrame:
    return column_stats(df.filter(F.col(tag) == value), columns)


def column_stats_by_tag(df: DataFrame, columns: list[str], tag: str = LABEL) -> DataFrame:
    """The same for every label from one scan (label, feature, ...)."""
    return _statistics(df, columns, [tag]).select(tag, _named(columns), *_STATISTICS)


def variable_stats(df: DataFrame, variable: str, tag: str = LABEL) -> DataFrame:
    """Statistics of one variable per label; only that column is read."""
    return column_stats_by_tag(df, [variable], tag).select(
        tag, "mean", "std", "min", "max", "count"
    )


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, stddev, min and max per column, as numbers."""
    return column_stats(df, columns).select(
        "feature", "count", "mean", F.col("std").alias("stddev"), "min", "max"
    )
