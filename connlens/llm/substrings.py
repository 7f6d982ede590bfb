"""Removal of repeated passages: windows of words that start earlier elsewhere.

1. Sketches. Each task counts the windows of a block of documents in a count-min sketch and sends its slices to the shards of the
   sketch. A window is counted by its anchor: the smallest of the hashes of its runs of `run` words, at its leftmost place. Equal
   windows have equal anchors at different places, so that the count of an anchor's cell is never below the count of a window; and
   neighbouring windows share anchors, so that about one cell in seven words is sent. The sketch has one row of 2**48 cells and is
   kept sparsely: slices hold the cells that occur, once per block. Counts add up in the shard; 2 stands for 2 or more.
2. Shards answer which cells of a block are repeated, by document. What is repeated within a block is known there and only its cell
   is sent, so that a cell in a third of all documents comes once from each block.
3. Windows with a repeated cell are grouped by their 128-bit digest, and the first (smallest document, then start) is kept. All
   occurrences but firsts go: windows that the sketch overestimated are firsts themselves. A group is reduced to a minimum within
   tasks before it is shuffled and is never gathered.
4. Words covered by a window that isn't first are removed.

Texts are shuffled by document once: steps 3 and 4 read the same exchange. Broadcast is nothing but what Spark's own size
check allows. A task holds one block of texts, or the pieces of one longer text, and one shard of the sketch.

Defined results: a null or empty text has no words; documents under `length` words keep all words; rows of one doc_id are one
document, with equal starts equally early; a null doc_id counts as smallest; an empty table gives an empty table; extra columns
don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connlens.llm.common import written

NULL_ID = -(2**63)
#: Words of texts in one block, and in one pass over a long text; bytes of texts that are split into words at once.
BLOCK_WORDS, BLOCK_BYTES = 400_000, 2_500_000
#: Known words of a worker; beyond, it starts anew.
KNOWN_WORDS = 300_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Windows:
    length: int = 20
    run: int = 8
    shards_per_partition: int = 4


class _Digests(dict):
    """Place of each word in two arrays of 64-bit digests."""

    def __init__(self) -> None:
        self.low, self.high, self.new = np.zeros(0, np.uint64), np.zeros(0, np.uint64), []

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        self.new.append(xxhash.xxh3_128_digest(word))
        return place

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > KNOWN_WORDS:
            self.clear()
            self.low = self.high = np.zeros(0, np.uint64)
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            pairs = np.frombuffer(b"".join(self.new), "<u8").reshape(-1, 2)
            self.low, self.high = np.append(self.low, pairs[:, 0]), np.append(self.high, pairs[:, 1])
            self.new = []
        return self.low[places], self.high[places]


_digests = _Digests()


def _rolling(values: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    """A digest of each run of `length` values."""
    n = len(values) - length + 1
    out = values[:n].copy()
    for k in range(1, length):
        out *= factor
        out += values[k : k + n]
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _anchors(low: np.ndarray, how: Windows) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the sequence, the place of its anchor; and the cell of each place."""
    cells = _mixed(_rolling(low, how.run, _M1))
    span = how.length - how.run + 1  # runs in a window
    n = len(low) - how.length + 1
    best, reach = np.arange(len(cells)), 1
    while reach < span:
        step = min(reach, span - reach)
        a, b = best[: len(best) - step], best[step:]
        best = np.where(cells[b] < cells[a], b, a)
        reach += step
    return best[:n], (cells >> np.uint64(16)).astype(np.int64)


def _passes(counts: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about BLOCK_WORDS words; a row with more is a range of its own."""
    start = total = 0
    for i, n in enumerate(counts.tolist()):
        if i > start and total + n > BLOCK_WORDS:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(counts):
        yield start, len(counts)


class _Block:
    """Words of some texts and everything about their windows."""

    def __init__(self, words: list[list[bytes]], how: Windows, digests: bool = False) -> None:
        self.counts = np.fromiter(map(len, words), np.int64, len(words))
        low, high = _digests.of([w for row in words for w in row])
        n = len(low) - how.length + 1
        row = np.repeat(np.arange(len(words)), self.counts)
        if n <= 0:
            self.windows = self.row = self.start = self.anchor = self.cell = np.zeros(0, np.int64)
            self.k1 = self.k2 = self.windows
            return
        self.windows = np.flatnonzero(row[:n] == row[how.length - 1 :])
        anchor, cells = _anchors(low, how)
        self.row = row[self.windows]
        begins = np.cumsum(self.counts) - self.counts
        self.start = self.windows - begins[self.row]
        self.anchor = anchor[self.windows]
        self.cell = cells[self.anchor]
        if digests:
            self.k1 = _rolling(low, how.length, _M1)[self.windows].view(np.int64)
            self.k2 = _rolling(high, how.length, _M2)[self.windows].view(np.int64)


def _parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, with texts of about BLOCK_BYTES at a time; a longer text comes alone."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > BLOCK_BYTES:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def _words(texts: list[str | None]) -> list[list[bytes]]:
    return [(t or "").encode().split() for t in texts]  # bytes.split cuts at exactly the six blanks


def _sketch(how: Windows, shards: int):
    def slices(keys: np.ndarray, words: list[list[bytes]]) -> Iterator[dict]:
        block = _Block(words, how)
        if not len(block.windows):
            return
        first = np.ones(len(block.anchor), bool)  # an anchor's neighbours share its place
        first[1:] = block.anchor[1:] != block.anchor[:-1]
        cell, doc = block.cell[first], keys[block.row[first]]
        order = np.argsort(cell, kind="stable")
        cell, doc = cell[order], doc[order]
        begin = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        times = np.diff(np.append(begin, len(cell)))
        again = np.repeat(times > 1, times)
        known, once = begin[times > 1], ~again
        # Documents with a cell that is repeated within the block: their way leads through any shard.
        where = int(cell[0]) % shards
        yield {"shard": where, "kind": 2, "cells": cell[again], "docs": doc[again]}
        for kind, cells, docs in ((1, cell[known], None), (0, cell[once], doc[once])):
            to = cells % shards
            order = np.argsort(to, kind="stable")
            borders = np.searchsorted(to[order], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(borders)).tolist():
                part = order[borders[s] : borders[s + 1]]
                yield {"shard": s, "kind": kind, "cells": cells[part], "docs": None if docs is None else docs[part]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, "text"):
            keys, words = batch.column(0).to_numpy(zero_copy_only=False), _words(batch.column(1).to_pylist())
            counts = np.fromiter(map(len, words), np.int64, len(words))
            for a, b in _passes(counts, how.length):
                if b - a == 1 and counts[a] > BLOCK_WORDS:  # pieces that share no window
                    whole = words[a]
                    parts = [whole[i : i + BLOCK_WORDS + how.length - 1] for i in range(0, len(whole), BLOCK_WORDS)]
                    rows = [r for p in parts for r in slices(keys[a:b], [p])]
                else:
                    rows = list(slices(keys[a:b], words[a:b]))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r["shard"] for r in rows], pa.int32()),
                            pa.array([r["kind"] for r in rows], pa.int32()),
                            pa.array([_planes(r["cells"]) for r in rows], pa.binary()),
                            pa.array([None if r["docs"] is None else _planes(r["docs"]) for r in rows], pa.binary()),
                        ],
                        ["shard", "kind", "cells", "docs"],
                    )

    return run


def _planes(values: np.ndarray) -> bytes:
    """First bytes first: what large numbers share is then compressed away in the shuffle."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _merge(table: pa.Table) -> pa.Table:
    """One shard: the documents of repeated cells."""
    parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {0: [], 1: [], 2: []}
    for kind, cells, docs in zip(*(table.column(c).to_pylist() for c in ("kind", "cells", "docs")), strict=True):
        parts[kind].append((_values(cells), np.zeros(0, np.int64) if docs is None else _values(docs)))
    both = lambda k, i: np.concatenate([np.zeros(0, np.int64), *(p[i] for p in parts[k])])
    once, docs, known = both(0, 0), both(0, 1), both(1, 0)
    cells, at = np.unique(np.concatenate([once, known]), return_inverse=True)
    total = np.bincount(at[: len(once)], minlength=len(cells)) + 2 * np.bincount(at[len(once) :], minlength=len(cells))
    repeated = total[at[: len(once)]] > 1
    out = [np.concatenate([docs[repeated], both(2, 1)]), np.concatenate([once[repeated], both(2, 0)])]
    return pa.table({"key": pa.array(out[0], pa.int64()), "cell": pa.array(out[1], pa.int64())})


def _candidates(how: Windows):
    """Windows with a repeated cell: key, k1, k2, start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, "text"):
            for keys, _, block, chosen in _chosen(batch, how):
                arrays = [keys[block.row[chosen]], block.k1[chosen], block.k2[chosen], block.start[chosen]]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], ["key", "k1", "k2", "start"])

    return run


def _chosen(batch: pa.RecordBatch, how: Windows) -> Iterator[tuple]:
    """Blocks of the batch's rows that have repeated cells, with the windows that hold one."""
    keys = batch.column("key").to_numpy(zero_copy_only=False)
    cells = batch.column("cells")
    rows = np.flatnonzero(np.asarray(cells.is_valid()))
    words = _words(batch.column("text").take(pa.array(rows)).to_pylist()) if len(rows) else []
    counts = np.fromiter(map(len, words), np.int64, len(words))
    for a, b in _passes(counts, how.length):
        block = _Block(words[a:b], how, digests=True)
        hit = np.zeros(len(block.windows), bool)
        borders = np.searchsorted(block.row, np.arange(b - a + 1))
        for i in range(b - a):
            s, e = borders[i], borders[i + 1]
            if e > s:
                hit[s:e] = np.isin(block.cell[s:e], cells[int(rows[a + i])].values.to_numpy())
        yield keys[rows[a:b]], rows[a:b], block, np.flatnonzero(hit)


def _removal(how: Windows):
    """Per row: number of words, number removed, digest of the words that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, "text"):
            removed: dict[int, np.ndarray] = {}
            firsts = batch.column("firsts")
            for _, rows, block, chosen in _chosen(batch, how):
                borders = np.searchsorted(block.row[chosen], np.arange(len(rows) + 1))
                for i, row in enumerate(rows.tolist()):
                    part = chosen[borders[i] : borders[i + 1]]
                    if not len(part):
                        continue
                    starts, k1 = block.start[part], block.k1[part]
                    if firsts[row].is_valid:
                        own = firsts[row].values
                        pairs = np.stack([own.field("start").to_numpy(), own.field("k1").to_numpy()], 1)
                        # A start is first only together with the digest of its own window.
                        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
                        where = np.searchsorted(pairs[:, 0], starts)
                        is_first = np.zeros(len(starts), bool)
                        for shift in range(int(np.bincount(np.unique(pairs[:, 0], return_inverse=True)[1]).max())):
                            at = np.minimum(where + shift, len(pairs) - 1)
                            is_first |= (pairs[at, 0] == starts) & (pairs[at, 1] == k1)
                        starts = starts[~is_first]
                    edge = np.zeros(block.counts[i] + 1, np.int64)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + how.length, -1)
                    removed[row] = np.cumsum(edge[:-1]) > 0
            n_words, n_removed, digest = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                words = (text or "").encode().split()
                gone = removed.get(row)
                n_words.append(len(words))
                n_removed.append(0 if gone is None else int(gone.sum()))
                if n_removed[-1]:
                    words = [words[i] for i in np.flatnonzero(~gone).tolist()]
                digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return run


def without_repeats(docs: DataFrame, how: Windows | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (words that stay, joined by blanks) of every document."""
    how = how or Windows()
    spark = docs.sparkSession
    shards = how.shards_per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.coalesce(F.col(doc_id), F.lit(NULL_ID)).cast("long").alias("key"), F.col(text).alias("text"))
    slices = plain.mapInArrow(_sketch(how, shards), "shard int, kind int, cells binary, docs binary")
    repeated = slices.groupBy("shard").applyInArrow(_merge, "key long, cell long")
    cells = written(repeated.groupBy("key").agg(F.collect_set("cell").alias("cells")), "window-cells")
    joined = plain.join(cells.hint("shuffle_hash"), "key", "left").select("key", "text", "cells")
    windows = joined.mapInArrow(_candidates(how), "key long, k1 long, k2 long, start long")
    firsts = windows.groupBy("k1", "k2").agg(F.min(F.struct("key", "start")).alias("first"))
    firsts = firsts.select("first.key", F.struct("first.start", "k1").alias("first")).groupBy("key").agg(F.collect_list("first").alias("firsts"))
    final = joined.join(firsts.hint("shuffle_hash"), "key", "left")
    final = final.select(F.when(F.col("key") != NULL_ID, F.col("key")).alias("doc_id"), "key", "text", "cells", "firsts")
    return final.mapInArrow(_removal(how), "doc_id long, n_words long, n_removed long, kept_sha256 string")


ORACLE = r"""
WITH words AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), windows AS (
    SELECT doc_id, s, array_to_string(words[s:s + 19], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM words)
), later AS (
    SELECT doc_id, s FROM windows
    QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, s) > 1
), gone AS (
    SELECT DISTINCT doc_id, s + k AS place FROM later, (SELECT unnest(range(0, 20)) AS k)
), kept AS (
    SELECT doc_id, sum(stays::INTEGER) AS n_kept, coalesce(string_agg(word, ' ' ORDER BY place) FILTER (WHERE stays), '') AS text
    FROM (
        SELECT w.doc_id, w.place, w.word, g.place IS NULL AS stays
        FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM words) w
        LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.place = w.place
    )
    GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
