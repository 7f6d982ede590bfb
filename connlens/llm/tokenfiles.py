"""Files of token ids, coded by static range asymmetric numeral systems (`rans`).

Writing. Documents are range-partitioned and sorted by doc_id, null first (equal ids by digest of the text). Each task encodes its
texts with the tokenizers library, appends the end id to each document, and codes segments of about `segment` ids: the ids of a
segment are counted, their table is shared by its blocks, and each block is an independent interleaved stream with checkpoints and
a checksum. A row of the file is a segment with its documents, its table and its blocks, so that each can be read alone; Spark
commits the files, so that a task that is repeated leaves no second copy. A document is never split between segments.

Texts are cut at the added tokens of the file first, as the library does: such a token is one id wherever its string stands. Of the
rest, a worker encodes each different piece (`pretokens`) once, as far as its memory of pieces reaches: the library splits at the
same borders. New pieces reach it many at a time: those of a blank and a word as they are, since only their first token begins with a
blank, others without white space with line feeds between them.

Reading. Segments are decoded block by block, in parallel. Where a document starts follows from the ids before it in its segment, the
ids before the segment in its shard, and the sums of the shards before.

A task holds one segment, or a longer document, and one slice of texts. Broadcast is the tokenizer.

Defined results: a null or empty text has the end id alone; a string of a special token in a text is that token's id; added tokens that
take blanks beside them or need word borders are refused; repeated ids are repeated documents; an empty table gives an empty table; extra columns don't matter.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from connlens.llm import pretokens
from connlens.llm.memo import Memo
from connlens.llm.rans import Block, Coder, Table
from connlens.sources.storage import new_scratch_path

_BLOCK = pa.struct(
    [("n", pa.int64()), ("lanes", pa.int32()), ("every", pa.int32()), ("states", pa.binary()), ("places", pa.binary()), ("words", pa.binary()), ("crc32", pa.int64())]
)
_SEGMENT = pa.schema(
    [
        ("shard", pa.int32()),
        ("segment", pa.int32()),
        ("before", pa.int64()),  # ids of the shard before the segment
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("ids", pa.list_(pa.int32())),
        ("slots", pa.list_(pa.int32())),
        ("blocks", pa.list_(_BLOCK)),
    ]
)
SEGMENT_SCHEMA = (
    "shard int, segment int, before long, doc_ids array<long>, lengths array<long>, ids array<int>, slots array<int>, "
    "blocks array<struct<n: long, lanes: int, every: int, states: binary, places: binary, words: binary, crc32: long>>"
)


#: Pieces that a worker remembers, twice; and the texts that it takes at once.
KNOWN_PIECES, SLICE_CHARS = 300_000, 2_500_000


@dataclass(frozen=True)
class Format:
    end_id: int = 2
    segment: int = 4_000_000
    block: int = 500_000
    lanes: int = 1024


class Encoder:
    """Encodes texts in one Python worker with the tokenizers library."""

    def __init__(self, description: str, classes: np.ndarray) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        added = json.loads(description).get("added_tokens") or []
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that look at what stands beside them are not supported")
        self.added = {t["content"]: t["id"] for t in added}
        # Of tokens that begin at the same place the longest counts.
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.classes = classes
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # it only meets pieces that are new
        self.feed = self._ids("\n")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.blank = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)  # a blank is written so by byte-level tokenizers
        self.blank[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.known = Memo(self._new, KNOWN_PIECES)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _new(self, pieces: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        simple = [i for i, p in enumerate(pieces) if not p[-1].isspace() and "\n" not in p]
        led = [i for i in simple if pieces[i][0] == " " and " " not in pieces[i][1:]] if self.blank.any() else []
        # A line feed is a piece of its own between pieces that hold none.
        fed = sorted(set(simple).difference(led)) if len(self.feed) == 1 else []
        simple = led + fed
        for chosen, between in ((led, ""), (fed, "\n")):
            for start in range(0, len(chosen), 2_000):
                part = chosen[start : start + 2_000]
                ids = np.array(self._ids(between.join(pieces[i] for i in part)), np.int32)
                if between:
                    after = np.flatnonzero(ids == self.feed[0])
                    begins, ends = np.append(0, after + 1), np.append(after, len(ids))
                else:
                    begins = np.flatnonzero(self.blank[ids])
                    ends = np.append(begins[1:], len(ids))
                if len(begins) != len(part) or begins[0] != 0:
                    raise ValueError("the tokenizer doesn't keep pieces apart")
                data = ids.tobytes()
                for i, a, b in zip(part, begins.tolist(), ends.tolist(), strict=True):
                    out[i] = data[4 * a : 4 * b]
        for i in set(range(len(pieces))).difference(simple):
            out[i] = np.array(self._ids(pieces[i]), np.int32).tobytes()
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        if self.cut is None or not any(map(self.cut.search, texts)):
            return self._plain(texts)
        rows = [self.cut.split(t) for t in texts]  # an added token stands at each odd place
        marks = np.array([i % 2 for row in rows for i in range(len(row))], np.int64)
        parts = [p for row in rows for p in row]
        ids, counts = self._plain(["" if mark else p for p, mark in zip(parts, marks.tolist(), strict=True)])
        found = [self.added[parts[i]] for i in np.flatnonzero(marks).tolist()]
        ids = np.insert(ids, np.cumsum(counts)[marks == 1], found)
        starts = np.cumsum([0, *map(len, rows[:-1])])
        return ids, np.add.reduceat(counts + marks, starts)

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens."""
        pieces, counts = pretokens.pieces(texts, self.classes)
        if len(pieces) == 0:
            return np.zeros(0, np.int32), counts
        coded = pieces.dictionary_encode()
        answers = pa.array(self.known.many(pretokens.listed(coded.dictionary)), pa.large_binary())
        taken = answers.take(coded.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] // 4
        ids = np.frombuffer(taken.buffers()[2], np.int32)[: ends[-1]]
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])


_encoders: dict[int, Encoder] = {}


def _encoder(shared: Broadcast) -> Encoder:
    description, classes = shared.value
    key = hash(description)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(description, classes)
    return _encoders[key]


def _ended(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """With the end id after each document."""
    out = np.full(len(ids) + len(counts), end_id, np.int32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(counts + 1) - 1] = False
    out[keep] = ids
    return out, counts + 1


def _segment(shard: int, number: int, before: int, keys: list, lengths: np.ndarray, tokens: np.ndarray, how: Format) -> pa.RecordBatch:
    table = Table.of(tokens)
    coder = Coder(table)
    blocks = []
    for start in range(0, len(tokens), how.block):
        b = coder.encode(tokens[start : start + how.block], how.lanes)
        parts = {k: getattr(b, k).tobytes() for k in ("states", "places", "words")}
        blocks.append({"n": b.n, "lanes": b.lanes, "every": b.every, "crc32": b.crc32, **parts})
    row = {
        "shard": shard, "segment": number, "before": before, "doc_ids": keys, "lengths": lengths.tolist(),
        "ids": table.ids.astype(np.int32), "slots": table.slots.astype(np.int32), "blocks": blocks,
    }
    return pa.RecordBatch.from_pylist([row], schema=_SEGMENT)


def _write(shared: Broadcast, how: Format):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(shared), TaskContext.get().partitionId()
        number = before = held = 0
        keys: list = []
        lengths: list[np.ndarray] = []
        tokens: list[np.ndarray] = []
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            names = batch.column(0).to_pylist()
            for a, b in pretokens.slices(texts, SLICE_CHARS):
                ids, counts = _ended(*encoder.encode(texts[a:b]), how.end_id)
                keys += names[a:b]
                lengths.append(counts)
                tokens.append(ids)
                held += len(ids)
                if held >= how.segment:
                    yield _segment(shard, number, before, keys, np.concatenate(lengths), np.concatenate(tokens), how)
                    number, before, held, keys, lengths, tokens = number + 1, before + held, 0, [], [], []
        if keys:
            yield _segment(shard, number, before, keys, np.concatenate(lengths), np.concatenate(tokens), how)

    return run


def write(docs: DataFrame, path: str, tokenizer: str, how: Format | None = None, text: str = "text", doc_id: str = "doc_id") -> None:
    """Writes the ids of all documents under `path`, in ascending doc_id order. `tokenizer` is a file of the tokenizers library."""
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast((file.read(), pretokens.tiktoken_classes()))
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keys = (F.col("doc_id"), F.xxhash64("text"))
    ordered = plain.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.mapInArrow(_write(shared, how or Format()), SEGMENT_SCHEMA).write.parquet(path)


def _tokens(row: dict) -> np.ndarray:
    """The ids of a segment."""
    coder = Coder(Table(np.array(row["ids"], np.int64), np.array(row["slots"], np.int64)))
    out = []
    for b in row["blocks"]:
        states = np.frombuffer(b["states"], np.uint64).reshape(-1, b["lanes"])
        places, words = np.frombuffer(b["places"], np.int64), np.frombuffer(b["words"], np.uint32)
        out.append(coder.decode(Block(b["n"], b["lanes"], b["every"], states, places, words, b["crc32"])))
    return np.concatenate([np.zeros(0, np.uint32), *out])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            data = memoryview(np.ascontiguousarray(_tokens(row), "<u4")).cast("B")
            lengths = np.array(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            crc = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            shard = pa.array(np.full(len(crc), row["shard"]), pa.int32())
            start = pa.array(row["before"] + ends - lengths, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), shard, start, pa.array(lengths), pa.array(crc, pa.int64())],
                ["doc_id", "shard", "start", "n_tokens", "ids_crc32"],
            )


def documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files under `path`, from the decoded ids."""
    files = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    # One row a shard: as many as the writing job had tasks.
    sums = files.groupBy("shard").agg(F.sum(F.expr("aggregate(lengths, 0L, (s, n) -> s + n)")).alias("n"))
    earlier = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("shard", F.coalesce(earlier, F.lit(0)).alias("offset"))
    rows = files.mapInArrow(_read, "doc_id long, shard int, start long, n_tokens long, ids_crc32 long")
    joined = rows.join(F.broadcast(offsets), "shard")
    return joined.select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def token_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and token_ids array<int> of every document in the files under `path`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                offsets = pa.array(np.concatenate([[0], np.cumsum(row["lengths"])]), pa.int32())
                ids = pa.ListArray.from_arrays(offsets, pa.array(_tokens(row).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), ids], ["doc_id", "token_ids"])

    return spark.read.schema(SEGMENT_SCHEMA).parquet(path).mapInArrow(run, "doc_id long, token_ids array<int>")


def round_trip(docs: DataFrame, tokenizer: str, how: Format | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Writes files to the shared folder and returns what `documents` reads from them."""
    path = new_scratch_path(docs.sparkSession, "tokens")
    write(docs, path, tokenizer, how, text, doc_id)
    return documents(docs.sparkSession, path)
