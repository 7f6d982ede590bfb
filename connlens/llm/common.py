"""Helpers that several operators of the subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.sources.storage import new_scratch_path, write_result

#: A word is a longest run of characters other than these.
BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A table of so many rows at most is broadcast; a larger one joins by shuffle.
BROADCAST_ROWS = 100_000


def written(df: DataFrame, name: str) -> DataFrame:
    """A copy of `df` in the shared folder, so that later steps neither repeat its work nor depend on lost executors."""
    return write_result(df, new_scratch_path(df.sparkSession, name))


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """For tables that were written: broadcast up to `rows` rows, leave the join to Spark beyond."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, other letters unchanged."""
    return F.translate(text, UPPER, LOWER)


def with_suffix(names: list[str], wanted: str) -> str:
    """`wanted`, with underscores added until no name of a table equals it (Spark compares without case)."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
