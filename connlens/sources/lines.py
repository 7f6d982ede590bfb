"""Text lines to typed records, with a reject side instead of a failed job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from connlens.fields import FIELD_NAMES, INTERACTION_SCHEMA, LABEL, NARROW_FIELDS, NORMAL
from connlens.functions import class_name, field_at

# Java reads "1d" and "2f" as numbers; in a text record they are bad input.
_SUFFIXED = r"[0-9.][dDfF]"
_SUFFIXED_NUMBER = _SUFFIXED + r"\s*$"
_REGEX_SIGNS = ".$|()[{^?*+\\"


def read_lines(
    spark: SparkSession, path: str | list[str], partitions: int | None = None
) -> DataFrame:
    """Load (compressed) text files as one column ``value``.

    A gzip file cannot be split, so each one is read by a single task. ``partitions`` spreads the
    lines afterwards; it is worth its shuffle only when several later steps read the lines.
    """
    lines = spark.read.text(path)
    return lines if partitions is None else lines.repartition(partitions)


def render_lines(df: DataFrame, columns: list[str], sep: str = ",") -> DataFrame:
    """The inverse of parsing: one delimited text line per row."""
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value"))


def _split(value: str | Column, sep: str) -> Column:
    if len(sep) > 1:
        pattern = f"\\Q{sep}\\E"
    else:
        pattern = "\\" + sep if sep in _REGEX_SIGNS else sep
    return F.split(value, pattern, -1)


def parse_fields(df: DataFrame, sep: str = ",", value: str = "value") -> DataFrame:
    """Add the positional array ``fields``."""
    return df.withColumn("fields", _split(value, sep))


def pick_fields(
    df: DataFrame, wanted: dict[int, str | tuple[str, str]], fields: str = "fields"
) -> DataFrame:
    """Name chosen positions, and type those given as ``(name, type)``."""
    picked = []
    for position, target in wanted.items():
        name, dtype = (target, None) if isinstance(target, str) else target
        picked.append(field_at(fields, position, dtype).alias(name))
    return df.select(*picked)


def _typed(schema: T.StructType, fields: str = "fields") -> list[Column]:
    columns = []
    for position, field in enumerate(schema.fields):
        text = isinstance(field.dataType, T.StringType)
        dtype = None if text else field.dataType.simpleString()
        columns.append(field_at(fields, position, dtype).alias(field.name))
    return columns


def parse_interactions(
    df: DataFrame, schema: T.StructType = INTERACTION_SCHEMA, sep: str = ",", value: str = "value"
) -> DataFrame:
    """Decode lines to the typed record. Only the columns used later are decoded.

    Fields that are missing or not of their type become null; see ``split_rejects`` to keep such
    lines apart.
    """
    return parse_fields(df.select(value), sep, value).select(*_typed(schema))


def parse_outcome(
    df: DataFrame,
    schema: T.StructType = INTERACTION_SCHEMA,
    sep: str = ",",
    value: str = "value",
    labels: list[str] | None = None,
) -> DataFrame:
    """Typed columns plus the line and ``reason``: null for a good line, else what is wrong.

    With ``labels``, a last field that is none of them is wrong.

    A line is split and typed once: the typed columns come out of a generator, below which the optimizer moves no filter.
    Otherwise a filter on the reason would split the line again for each field that the reason looks at. Numbers are searched for a
    suffix only in lines that have one somewhere.
    """
    parsed = parse_fields(df.select(value), sep, value)
    split = F.struct(
        F.size("fields").alias("arity"), F.col("fields"), F.col(value).rlike(_SUFFIXED).alias("suffixed")
    )
    parsed = parsed.select(F.col(value).alias("line"), F.inline(F.array(split)))
    typed = parsed.select("line", "arity", "fields", "suffixed", F.struct(*_typed(schema)).alias("record"))
    typed = typed.select("line", "arity", "fields", "suffixed", F.explode(F.array("record")).alias("record"))

    def unreadable(position: int, field: T.StructField) -> Column:
        bad = F.col("record")[field.name].isNull()
        if isinstance(field.dataType, T.DoubleType):
            bad = bad | (F.col("suffixed") & field_at("fields", position).rlike(_SUFFIXED_NUMBER))
        return bad

    numbers = [
        F.when(unreadable(p, f), F.lit(f.name))
        for p, f in enumerate(schema.fields)
        if not isinstance(f.dataType, T.StringType)
    ]
    first_bad = F.coalesce(*numbers) if numbers else F.lit(None).cast("string")
    reason = (
        F.when(F.trim("line") == "", "empty line")
        .when(F.col("arity") < len(schema), "too few fields")
        .when(F.col("arity") > len(schema), "too many fields")
        .when(first_bad.isNotNull(), F.concat(F.lit("bad number: "), first_bad))
    )
    if labels is not None:
        known = F.col("record")[schema.names[-1]].isin(labels)
        reason = reason.when(~F.coalesce(known, F.lit(False)), "unknown label")
    return typed.select(F.col("line").alias(value), reason.alias("reason"), "record.*")


def split_rejects(
    df: DataFrame,
    schema: T.StructType = INTERACTION_SCHEMA,
    sep: str = ",",
    value: str = "value",
    labels: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good records, rejected lines with their reason). Together they hold every input line."""
    outcome = parse_outcome(df, schema, sep, value, labels)
    good = outcome.filter(F.col("reason").isNull()).select(*schema.names)
    bad = outcome.filter(F.col("reason").isNotNull()).select(value, "reason")
    return good, bad


def narrow_interactions(
    df: DataFrame, columns: list[str] = NARROW_FIELDS, tag: str = LABEL, normal: str = NORMAL
) -> DataFrame:
    """A few columns with the label collapsed to attack/normal."""
    return df.select(*[class_name(tag, normal).alias(c) if c == tag else F.col(c) for c in columns])


def interaction_lines(df: DataFrame) -> DataFrame:
    """Text lines of a typed interaction table."""
    return render_lines(df, FIELD_NAMES)
