"""Counts, sums and means, whole-table and per key.

All are plain ``agg`` calls: Spark aggregates inside each task first, so the shuffle carries one
row per key and task even where a single key holds most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from connlens.fields import LABEL, NORMAL
from connlens.functions import class_name


def _condition(predicate: Column | str) -> Column:
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_where(df: DataFrame, predicate: Column | str, name: str = "n") -> DataFrame:
    return df.filter(predicate).agg(F.count(F.lit(1)).alias(name))


def class_ratio(df: DataFrame, value: str, tag: str = LABEL, digits: int = 3) -> DataFrame:
    """Share of the rows that carry one label."""
    hit = F.when(F.col(tag) == value, F.lit(1.0)).otherwise(F.lit(0.0))
    return df.agg(F.round(F.avg(hit), digits).alias("ratio"))


def class_totals(df: DataFrame, tag: str = LABEL, normal: str = NORMAL) -> DataFrame:
    """Normal, attack and all records in one row, from one pass."""
    is_normal = F.coalesce(F.col(tag) == normal, F.lit(False))
    return df.agg(
        F.count_if(is_normal).alias("normal"),
        F.count_if(~is_normal).alias("attack"),
        F.count(F.lit(1)).alias("total"),
    )


def reduce_sum(
    df: DataFrame, measure: str, tag: str = LABEL, normal: str = NORMAL, name: str = "total"
) -> DataFrame:
    """Total of a measure for the normal and for the attack records."""
    return df.groupBy(class_name(tag, normal).alias("class")).agg(F.sum(measure).alias(name))


def mean_from_totals(
    df: DataFrame, measure: str, tag: str = LABEL, normal: str = NORMAL, digits: int = 3
) -> DataFrame:
    """Mean per class as total / count of the known measures."""
    mean = F.sum(measure) / F.count(measure)
    return df.groupBy(class_name(tag, normal).alias("class")).agg(
        F.round(mean, digits).alias("mean")
    )


def aggregate_sum_count(df: DataFrame, measure: str, predicate: Column | str = "true") -> DataFrame:
    """(sum, count) of the known measures over the rows that meet a predicate."""
    return df.filter(predicate).agg(F.sum(measure).alias("total"), F.count(measure).alias("n"))


def fold_sum(df: DataFrame, measure: str, zero: float = 0.0, name: str = "total") -> DataFrame:
    """Sum that starts from ``zero``, so an empty table gives ``zero``."""
    return df.agg((F.lit(zero) + F.coalesce(F.sum(measure), F.lit(0))).alias(name))


def sum_by_tag(df: DataFrame, measure: str, tag: str = LABEL) -> DataFrame:
    return df.groupBy(tag).agg(F.sum(measure).alias("total"))


def count_by_tag(df: DataFrame, tag: str = LABEL) -> DataFrame:
    return df.groupBy(tag).agg(F.count(F.lit(1)).alias("n"))


def sum_count_by_tag(df: DataFrame, measure: str, tag: str = LABEL) -> DataFrame:
    """Sum and count of the known measures per label."""
    return df.groupBy(tag).agg(F.sum(measure).alias("total"), F.count(measure).alias("n"))


def mean_by_tag(df: DataFrame, measure: str, tag: str = LABEL, digits: int = 3) -> DataFrame:
    """Mean of a measure per label, highest first."""
    means = df.groupBy(tag).agg(F.round(F.avg(measure), digits).alias("mean"))
    return means.orderBy(F.desc("mean"), F.asc(tag))


def group_count(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    """Rows per key, smallest group first; ties in key order."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return sort_by_count(counts, name)


def filtered_group_count(
    df: DataFrame, predicates: list[Column | str], *keys: str | Column, name: str = "n"
) -> DataFrame:
    for predicate in predicates:
        df = df.filter(predicate)
    return group_count(df, *keys, name=name)


def group_by_predicate(
    df: DataFrame, predicate: Column | str, *keys: str, predicate_name: str, name: str = "n"
) -> DataFrame:
    """Rows per key and truth value of a predicate."""
    return group_count(df, *keys, _condition(predicate).alias(predicate_name), name=name)


def sql_topk_groups(
    spark: SparkSession, view: str, key: str, k: int, name: str = "interaction_count"
) -> DataFrame:
    """The k largest groups of a view, by SQL."""
    return spark.sql(
        f"SELECT {key}, COUNT(*) AS {name} FROM {view} "
        f"GROUP BY {key} ORDER BY {name} DESC, {key} LIMIT {int(k)}"
    )


def sort_by_count(counts: DataFrame, name: str = "n") -> DataFrame:
    ties = [F.asc(c) for c in counts.columns if c != name]
    return counts.orderBy(F.asc(name), *ties)


def sort_desc(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    """All rows, largest measure first. The tie columns also let Spark split equal measures over
    several sort ranges, so name columns that tell the rows apart."""
    return df.orderBy(F.desc(measure), *[F.asc(c) for c in ties])


def top_k(df: DataFrame, k: int, measure: str, *ties: str) -> DataFrame:
    """The k rows with the largest measure, for report-sized k: each task keeps only k rows."""
    return sort_desc(df, measure, *ties).limit(k)
