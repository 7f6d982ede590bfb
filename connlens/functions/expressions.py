"""Column expressions shared by the operators. All of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from connlens.fields import NORMAL

HASH_DIGITS = 8
HASH_RANGE = 16**HASH_DIGITS


def _column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def binary_label(tag: str | Column, normal: str = NORMAL) -> Column:
    """0.0 for the normal label, 1.0 for every other one (a missing tag counts as not normal)."""
    return F.when(_column(tag) == normal, F.lit(0.0)).otherwise(F.lit(1.0))


def class_name(tag: str | Column, normal: str = NORMAL) -> Column:
    """The label collapsed to the words ``normal`` and ``attack``."""
    return F.when(_column(tag) == normal, F.lit("normal")).otherwise(F.lit("attack"))


def field_at(fields: str | Column, position: int, dtype: str | None = None) -> Column:
    """Field by position. A short line or text that is not a ``dtype`` gives null, not an error."""
    picked = F.get(_column(fields), F.lit(position))
    return picked if dtype is None else picked.try_cast(dtype)


def std_from_variance(variance: str | Column) -> Column:
    return F.sqrt(_column(variance))


def key_hash(key: str | Column, seed: int) -> Column:
    """Hex hash of a row key. It depends on the seed and the key only, never on partitioning.

    A missing key has a hash of its own, so that its rows belong to some side of every split.
    """
    text = F.concat(F.lit(f"{seed}:"), _column(key).cast("string"))
    return F.md5(F.coalesce(text, F.lit(f"{seed};")))


def in_hash_sample(key: str | Column, fraction: float, seed: int) -> Column:
    """True for a repeatable share ``fraction`` of the key values."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction must lie in [0, 1], got {fraction}")
    limit = round(fraction * HASH_RANGE)
    if limit >= HASH_RANGE:
        return F.lit(True)
    return F.substring(key_hash(key, seed), 1, HASH_DIGITS) < F.lit(f"{limit:0{HASH_DIGITS}x}")
