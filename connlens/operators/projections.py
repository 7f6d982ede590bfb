"""Projections, predicates and scalar columns. Catalyst fuses chains of these into one stage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.fields import LABEL, NORMAL
from connlens.functions import binary_label


def select_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns)


def project_expr(df: DataFrame, *expressions: str) -> DataFrame:
    """Project with SQL expressions; alias every computed one."""
    return df.selectExpr(*expressions)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Change column types; values that do not fit become null."""
    return df.withColumns({name: F.col(name).try_cast(dtype) for name, dtype in types.items()})


def add_column(df: DataFrame, name: str, value: Column | str) -> DataFrame:
    return df.withColumn(name, F.expr(value) if isinstance(value, str) else value)


def filter_like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).like(pattern))


def filter_contains(df: DataFrame, column: str, text: str) -> DataFrame:
    return df.filter(F.col(column).contains(text))


def filter_member(df: DataFrame, fields: str, value: str) -> DataFrame:
    """Rows where one of the fields equals the value exactly."""
    return df.filter(F.array_contains(fields, value))


def filter_tag(df: DataFrame, value: str, tag: str = LABEL, keep: bool = True) -> DataFrame:
    """Rows with the label, or with ``keep=False`` all other rows (those without a label, too)."""
    has_label = F.col(tag).eqNullSafe(F.lit(value))
    return df.filter(has_label if keep else ~has_label)


def filter_conjunction(df: DataFrame, *predicates: Column | str) -> DataFrame:
    return reduce(lambda kept, predicate: kept.filter(predicate), predicates, df)


def with_binary_label(
    df: DataFrame, tag: str = LABEL, normal: str = NORMAL, name: str = "label"
) -> DataFrame:
    return df.withColumn(name, binary_label(tag, normal))


def drop_fields(df: DataFrame, dropped: list[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in set(dropped)])


def key_by(df: DataFrame, fields: str, position: int, keep_last: bool = True) -> DataFrame:
    """(tag, fields) pairs; without ``keep_last`` the last field is left out of the value."""
    value = F.col(fields)
    if not keep_last:
        value = F.slice(value, 1, F.greatest(F.size(value) - 1, F.lit(0)))
    return df.select(F.get(fields, F.lit(position)).alias("tag"), value.alias("fields"))


def collect_tag(df: DataFrame, value: str, tag: str = "tag") -> DataFrame:
    """All records of one label. They stay distributed."""
    return df.filter(F.col(tag) == value)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def format_row(df: DataFrame, template: str, *columns: str, name: str = "line") -> DataFrame:
    """Each row as a sentence, in printf notation."""
    return df.select(F.format_string(template, *columns).alias(name))


def round_measure(df: DataFrame, columns: list[str], digits: int = 3) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
