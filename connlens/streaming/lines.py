"""Streams of text lines from files that arrive in a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH_INTERVAL = "10 seconds"


def stream_lines(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    """Lines of the files in a folder, and of those that arrive later, as column ``value``.

    A batch takes all files that are there, or ``files_per_batch`` of them.
    """
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def skip_blank(lines: DataFrame, value: str = "value") -> DataFrame:
    return lines.filter(F.trim(value) != "")


def _trigger(writer, interval: str | None):
    """Micro-batches at an interval, or with None everything that is there now."""
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def start_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = BATCH_INTERVAL,
) -> StreamingQuery:
    """Call ``handle(rows, batch_id)`` for every micro-batch."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def lines_to_table(
    stream: DataFrame, path: str, checkpoint: str, interval: str | None = BATCH_INTERVAL
) -> StreamingQuery:
    """Append a stream to a parquet table, each row exactly once.

    Lines of text are repetitive: zstd leaves about half of what snappy does.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("compression", "zstd")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def batch_counts(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = BATCH_INTERVAL,
    *measures: Column,
) -> StreamingQuery:
    """Write the number of lines of every micro-batch, and other aggregates that are named.

    A replayed batch overwrites its own row.
    """

    def count(batch: DataFrame, batch_id: int) -> None:
        batch.agg(F.count(F.lit(1)).alias("n"), *measures).write.mode("overwrite").parquet(
            f"{path}/batch_id={batch_id}"
        )

    return start_batches(stream, count, checkpoint, interval)


def await_stream(query: StreamingQuery, timeout: int | None = None) -> bool:
    """Wait for the end of a stream, True when it ended in time; re-raises its failure."""
    return query.awaitTermination(timeout) if timeout else query.awaitTermination() is None
