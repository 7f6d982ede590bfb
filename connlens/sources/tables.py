"""Tables as such: sequences, views, schemas, caching, partitions, first rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def range_source(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """The sequence 0 .. n-1 in column ``id``."""
    return spark.range(0, n, 1, partitions)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Publish a table for SQL and return it."""
    df.createOrReplaceTempView(name)
    return df


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name and type of each column, with its number of non-null values."""
    filled = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col(field.name).alias("filled"),
        )
        for position, field in enumerate(df.schema.fields)
    ]
    return filled.select(F.inline(F.array(*rows)))


def cache_table(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Keep a table that several later queries read. Lost blocks are recomputed."""
    return df.persist(level)


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """The table, kept in memory or on disk until the block ends, also by an error.

    Results that the block returns must be written or collected inside it: what is read later is
    computed again.
    """
    table = cache_table(df, level)
    try:
        yield table
    finally:
        table.unpersist()


def spread(df: DataFrame, partitions: int | None = None, *keys: str | Column) -> DataFrame:
    """Set the number of partitions; by default three per core of the running cluster."""
    n = partitions or 3 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n, *keys)


#: Stored bytes for one partition of a table that is spread. Compressed columns become rows of ten times as many bytes or more.
STORED_BYTES = 8 << 20


def _stored_bytes(spark: SparkSession, files: list[str]) -> int:
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in files]
    return sum(path.getFileSystem(configuration).getFileStatus(path).getLen() for path in paths)


def spread_if_few(df: DataFrame, stored: int = STORED_BYTES) -> DataFrame:
    """Spread a table that is stored in fewer files than there are cores.

    That is the case for gzip text and for small tables; a table of many files passes unchanged,
    and so does one that isn't read from files. There is a partition for each core, and more where the files have more than
    ``stored`` bytes for each, so that a partition doesn't grow with the table. Only the list of files and their sizes are looked at, so
    nothing runs while the plan is built. Put it before work that is much dearer than one shuffle of the columns used.
    """
    spark = df.sparkSession
    cores, files = spark.sparkContext.defaultParallelism, df.inputFiles()
    if not 0 < len(files) < cores:
        return df
    return df.repartition(max(cores, -(-_stored_bytes(spark, files) // stored)))


#: Rows of one partition of a table that is passed over many times, as in training: there a row takes up to 0.8 KB of a task's input.
TASK_ROWS = 1 << 18


def _in_tasks(df: DataFrame, total: int, rows: int) -> DataFrame:
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-total // rows)))


def spread_by_rows(df: DataFrame, rows: int = TASK_ROWS, total: int | None = None) -> DataFrame:
    """Deal a table out evenly: a partition for each core, and more where they would have more than about ``rows`` rows.

    Stored bytes don't tell the number of rows, as well compressed files have ten times as many of them, and many large files
    give partitions of many rows too. Rows are counted first, which for a parquet table reads only the ends of its files; for a part of a
    table, ``total`` gives the rows of the whole, so that nothing is read twice.
    """
    return _in_tasks(df, df.count() if total is None else total, rows)


@contextmanager
def kept_evenly(df: DataFrame, rows: int = TASK_ROWS) -> Iterator[DataFrame]:
    """The table, kept in memory or on disk until the block ends, with at most about ``rows`` rows in a partition.

    It is dealt out again only if a partition has more; the copy before is then given up at once.
    """
    table = cache_table(df)
    try:
        sizes = table.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
        total, largest = sizes.agg(F.sum("n"), F.max("n")).first()
        if (largest or 0) > rows:
            dealt = cache_table(_in_tasks(table, total, rows))
            dealt.count()
            table.unpersist()
            table = dealt
        yield table
    finally:
        table.unpersist()


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first n rows in a stated order (without one, "first" would mean nothing)."""
    if not order:
        raise ValueError("preview needs at least one ordering column")
    return df.orderBy(*order).limit(n)
