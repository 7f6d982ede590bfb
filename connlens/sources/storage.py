"""Where intermediate and final tables live.

Executors can be lost at any time, so whatever must outlive a stage goes to the shared folder
that the cluster names in ``spark.checkpoint.dir``. A machine-local folder is used only when the
session runs in local mode and names none.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the session."""
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="connlens-")
    return _local_folder


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/connlens/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this process has written under scratch paths; returns the number of paths.

    Call it when the results of its queries are written or no longer needed: tables that still
    read from such a path fail afterwards. Paths of other processes are never touched.
    """
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        removed += bool(path.getFileSystem(configuration).delete(path, True))
    return removed


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written copy."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_result(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "errorifexists",
    options: dict[str, object] | None = None,
) -> DataFrame:
    """Write a table as parquet, with ``options`` of the writer, and return the written copy."""
    writer = df.write.mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
