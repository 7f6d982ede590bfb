"""A stream of the lines that are appended to files, as a streaming data source in Python.

Spark's own file source takes each file once, whole. This one remembers how many bytes of every file it
has passed on, so that it follows files that grow, as a log does, without a port or a receiver. The
offsets are part of the stream's checkpoint: after a restart it goes on where it stopped, each line once.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "growing_lines"
#: Bytes that one task reads, and lines of one Arrow batch.
PIECE = 64 << 20
LINES_A_BATCH = 10_000
_TAIL = 1 << 16


@dataclass
class Piece(InputPartition):
    """The lines of a file that begin at ``start`` or later, and before ``end``."""

    path: str
    start: int
    end: int


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _whole_lines(store: fs.FileSystem, path: str, size: int, known: int) -> int:
    """The place behind the last line end between ``known`` and ``size``."""
    with store.open_input_file(path) as file:
        at = size
        while at > known:
            start = max(known, at - _TAIL)
            found = file.read_at(at - start, start).rfind(b"\n")
            if found >= 0:
                return start + found + 1
            at = start
    return known


class GrowingLinesReader(DataSourceStreamReader):
    def __init__(self, folder: str, piece: int) -> None:
        self.folder, self.piece = folder, piece

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        store, folder = _opened(self.folder)
        files = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        known = getattr(self, "known", {})
        ends = {
            f.path: _whole_lines(store, f.path, f.size, min(known.get(f.path, 0), f.size))
            for f in files
            if f.is_file and not f.base_name.startswith((".", "_"))
        }
        self.known = known | ends
        return {"files": json.dumps(self.known, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        begun, ended = json.loads(start["files"]), json.loads(end["files"])
        return [
            Piece(path, at, min(at + self.piece, last))
            for path, last in sorted(ended.items())
            for at in range(begun.get(path, 0), last, self.piece)
        ]

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        store, _ = _opened(self.folder)
        held: list[str] = []
        with io.BufferedReader(store.open_input_file(piece.path)) as file:
            # A piece has the lines that begin in it: the first one may belong to the piece before.
            at = piece.start
            file.seek(max(0, at - 1))
            if at and file.read(1) != b"\n":
                at += len(file.readline())
            while at < piece.end:
                line = file.readline()
                if not line.endswith(b"\n"):
                    break
                at += len(line)
                held.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                if len(held) >= LINES_A_BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(held)], names=["value"])
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held)], names=["value"])


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> GrowingLinesReader:
        return GrowingLinesReader(self.options["path"], int(self.options.get("piece", PIECE)))


def follow_lines(spark: SparkSession, folder: str, piece: int = PIECE) -> DataFrame:
    """Lines of the files in a folder as column ``value``, and those that are appended later.

    A line counts once its end is written; blank lines are lines, and files whose name begins with a
    dot or underscore are none. Files may grow but not shrink, and are read uncompressed. The folder is a path or address
    that driver and executors open by themselves (a shared mount, an object store), as Spark's readers
    are not at hand in a Python source. Large additions are read in pieces of ``piece`` bytes by different tasks.
    """
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format(FORMAT).option("piece", str(piece)).load(folder)
