"""Tables that are replaced as a whole.

A version is written to a folder of its own, then a manifest that lists its files is renamed to
the next free number. That rename is the only commit: before it a reader sees the version before,
after it the new one, and what a killed writer or a repeated task left behind is in no manifest.
A version's files are never changed, so a reader that has begun goes on reading its version until
``expire`` removes it.

The rename must be atomic and must refuse an existing name, as it is on HDFS and on one machine.
On a store without such a rename, publish from one writer at a time.
"""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_MANIFESTS = "_manifests"


class _Folder:
    """The files below one path, by Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.configuration = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.of(self.path).getFileSystem(self.configuration)

    def of(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        path = self.of(f"{self.path}/{folder}" if folder else self.path)
        return [s.getPath().getName() for s in self.fs.listStatus(path)] if self.fs.exists(path) else []

    def files(self, folder: str) -> list[list]:
        """Relative path and length of every data file below a folder."""
        root = self.fs.makeQualified(self.of(f"{self.path}/{folder}")).toString()
        found, left = [], self.fs.listFiles(self.of(root), True)
        while left.hasNext():
            status = left.next()
            if not status.getPath().getName().startswith(("_", ".")):
                found.append([status.getPath().toString()[len(root) + 1 :], status.getLen()])
        return sorted(found)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.of(f"{self.path}/{name}"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.of(f"{self.path}/{name}"), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, name: str, target: str) -> bool:
        """False where the target exists."""
        options = self.jvm.org.apache.hadoop.fs.Options
        none = self.spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.configuration)
        source, wanted = (self.fs.makeQualified(self.of(f"{self.path}/{n}")) for n in (name, target))
        try:
            context.rename(source, wanted, none)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def age(self, name: str) -> float:
        """Seconds since the last change."""
        return time.time() - self.fs.getFileStatus(self.of(f"{self.path}/{name}")).getModificationTime() / 1000

    def delete(self, name: str) -> None:
        self.fs.delete(self.of(f"{self.path}/{name}"), True)


def _versions(folder: _Folder) -> list[int]:
    names = folder.names(_MANIFESTS)
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _manifest(version: int) -> str:
    return f"{_MANIFESTS}/{version:012d}.json"


def _commit(folder: _Folder, data: str, schema: T.StructType) -> int:
    content = json.dumps({"data": data, "schema": schema.jsonValue(), "files": folder.files(data)})
    staged = f"{_MANIFESTS}/.{uuid.uuid4().hex}"
    folder.write(staged, content)
    while True:
        version = max(_versions(folder), default=0) + 1
        if folder.rename(staged, _manifest(version)):
            return version


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Replace the published table under ``path`` by ``df``; returns the number of the version.

    A run that fails or is killed at any point leaves the version before in place; running it
    again is enough. The last of several writers wins, and no version is lost.
    """
    folder, data = _Folder(df.sparkSession, path), f"data-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{folder.path}/{data}")
    return _commit(folder, data, df.schema)


def published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The published table: the last version, or the one with a number."""
    folder = _Folder(spark, path)
    version = max(_versions(folder), default=0) if version is None else version
    if version == 0:
        raise FileNotFoundError(f"nothing is published under {path}")
    manifest = json.loads(folder.read(_manifest(version)))
    schema = T.StructType.fromJson(manifest["schema"])
    base = f"{folder.path}/{manifest['data']}"
    if not manifest["files"]:
        return spark.createDataFrame([], schema)
    files = [f"{base}/{name}" for name, _ in manifest["files"]]
    rows = spark.read.schema(schema).option("basePath", base).parquet(*files)
    return rows.select(*(f"`{c}`" for c in schema.names))


def expire(spark: SparkSession, path: str, keep: int = 2, hours: float = 24.0) -> int:
    """Remove all but the last ``keep`` versions, and data without a manifest that has not changed
    for ``hours`` (a killed writer's; set it above the longest run). Returns the folders removed.
    """
    folder = _Folder(spark, path)
    versions = _versions(folder)
    kept = set()
    for version in versions[-keep:]:
        kept.add(json.loads(folder.read(_manifest(version)))["data"])
    old = set()
    for version in versions[: max(0, len(versions) - keep)]:
        old.add(json.loads(folder.read(_manifest(version)))["data"])
        folder.delete(_manifest(version))
    data = [n for n in folder.names("") if n.startswith("data-") and n not in kept]
    gone = [n for n in data if n in old or folder.age(n) > 3600 * hours]
    for name in gone:
        folder.delete(name)
    return len(gone)
