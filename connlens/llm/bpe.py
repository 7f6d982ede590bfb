"""Byte-level BPE: encoding and decoding by DuckDB queries inside each partition.

Encoding. A partition splits its texts into the pieces that merge separately (`pretokens`) and gives each piece that its worker
hasn't met lately to a recursive DuckDB query. There, token positions join the merge table and each word's leftmost pair of the
lowest rank is contracted, until no pair of any word is in the table. A word's tokens are a string with one character for each id, which
the queries cut and join faster than lists. Words of over 64 bytes are lists; they contract all pairs of the lowest rank at once
where the merge table shows that no token which such a merge can lead to has a lower rank. That is a matter of speed, the outcome is the same.

Decoding. Ids join the vocabulary, and an aggregation ordered by position puts their bytes together. Sequences are cut
where letters, digits and other bytes meet and before blanks, so that equal stretches are decoded once.

Nothing is shuffled: each row is encoded where it is read. Broadcast are the vocabulary and its merge table, which have the size
of the vocabulary file, whatever the data. A worker holds one slice of texts (`pretokens.SLICE_CHARS` characters, or one longer
text) and a bounded memory of words.

Defined results: a null or empty text has no ids and decodes to no bytes; null ids decode to no bytes; rows are kept as they are,
repeats included; an empty table gives an empty table. Columns other than the named ones don't matter, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from connlens.llm import pretokens
from connlens.llm.memo import Memo, give_back

#: Words of more bytes than this contract many pairs at a time.
LONG_WORD = 64
#: Words, and bytes of words, that one recursive query takes.
WORDS_PER_QUERY, BYTES_PER_QUERY = 50_000, 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    """tokens[i] are the bytes of id ids[i]; each merge joins ids left and right to id merged, which is also its rank."""

    tokens: list[bytes]
    ids: np.ndarray
    left: np.ndarray
    right: np.ndarray
    merged: np.ndarray
    together: np.ndarray  # pairs of this rank may contract at once
    classes: np.ndarray


def read_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a rank file: lines of base64 bytes and a rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    merges, lower = [], set()
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                merges.append((a, b, rank))
            lower.update(part for part in (a, b) if part is not None and part > rank)
    table = np.array(merges, np.int32).reshape(-1, 3)
    return Vocabulary(
        tokens=list(ranks),
        ids=np.fromiter(ranks.values(), np.int32, len(ranks)),
        left=table[:, 0].copy(),
        right=table[:, 1].copy(),
        merged=table[:, 2].copy(),
        together=~np.isin(table[:, 2], np.fromiter(lower, np.int32, len(lower))),
        classes=pretokens.tiktoken_classes(),
    )


_SHORT = """
WITH RECURSIVE word(w, toks) USING KEY (w) AS (
    SELECT w, toks FROM given
    UNION
    SELECT w, substr(toks, 1, spot - 1) || chr(merged + CASE WHEN merged < 55040 THEN 256 ELSE 2304 END) || substr(toks, spot + 2)
    FROM (
        SELECT w, any_value(toks) AS toks, min(merged::BIGINT * 4294967296 + pos) AS lowest,
               (lowest // 4294967296)::INTEGER AS merged, (lowest % 4294967296)::INTEGER AS spot
        FROM (SELECT w, toks, unnest(range(1, length(toks))) AS pos FROM word)
        JOIN merges ON pair = substr(toks, pos, 2)
        GROUP BY w
    )
)
SELECT toks FROM word ORDER BY w
"""

_LONG = """
WITH RECURSIVE word(w, toks) USING KEY (w) AS (
    SELECT w, toks FROM given
    UNION
    (
        WITH place AS (SELECT w, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM word),
        pair AS (SELECT w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS next FROM place),
        hit AS (SELECT w, pos, merged, together FROM pair JOIN merges ON l = tok AND r = next),
        lowest AS (SELECT w, min(merged) AS merged FROM hit GROUP BY w),
        best AS (
            SELECT w, pos, merged, together, row_number() OVER (PARTITION BY w ORDER BY pos) AS k
            FROM hit SEMI JOIN lowest USING (w, merged)
        ),
        pick AS (
            SELECT w, pos, merged
            FROM (SELECT *, row_number() OVER (PARTITION BY w, pos - k ORDER BY pos) AS i FROM best)
            WHERE CASE WHEN together THEN i % 2 = 1 ELSE k = 1 END
        )
        SELECT p.w, list(coalesce(a.merged, p.tok) ORDER BY p.pos)
        FROM place p
        SEMI JOIN lowest ON p.w = lowest.w
        LEFT JOIN pick a ON p.w = a.w AND p.pos = a.pos
        ANTI JOIN pick b ON p.w = b.w AND p.pos = b.pos + 1
        GROUP BY p.w
    )
)
SELECT toks FROM word ORDER BY w
"""

_DECODE = """
SELECT string_agg(piece, '' ORDER BY pos) AS piece
FROM (SELECT w, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM given) JOIN vocabulary USING (id)
GROUP BY w ORDER BY w
"""


def _lists(values: np.ndarray, lengths: list[int]) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _signs(ids: np.ndarray) -> str:
    """One character for each id: 256 above it (none is NUL), and beyond the surrogates."""
    points = ids.astype(np.int64) + np.where(ids < 0xD800 - 256, 256, 256 + 0x800)
    return points.astype("<u4").tobytes().decode("utf-32-le")


def _unsigned(signs: str) -> np.ndarray:
    """The ids that `_signs` wrote."""
    points = np.frombuffer(signs.encode("utf-32-le"), "<u4").astype(np.int64)
    return (points - np.where(points < 0xD800, 256, 256 + 0x800)).astype("<i4")


def _cut(flat: str | bytes, lengths: list[int]) -> list:
    ends = np.cumsum(lengths).tolist()
    return [flat[e - n : e] for e, n in zip(ends, lengths, strict=True)]


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and (total + size > BYTES_PER_QUERY or i - start == WORDS_PER_QUERY):
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


class Codec:
    """Encodes and decodes in one Python worker, by queries of a DuckDB connection of its own."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import duckdb

        # Without a folder to spill to: its tables are bounded by one block of words.
        self.connection = duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        v = vocabulary
        pairs = _cut(_signs(np.stack([v.left, v.right], axis=1).ravel()), [2] * len(v.left))
        columns = {"pair": pa.array(pairs, pa.string()), "l": v.left, "r": v.right, "merged": v.merged, "together": pa.array(v.together)}
        table = pa.table(columns)
        # Bytes as characters of the same number: only text can be aggregated in order.
        words = pa.table({"id": v.ids, "piece": pa.array([t.decode("latin-1") for t in v.tokens], pa.string())})
        for name, arrow in (("merges", table), ("vocabulary", words)):
            self.connection.register("source", arrow)
            self.connection.execute(f"CREATE TABLE {name} AS SELECT * FROM source")
            self.connection.unregister("source")
        self.classes = v.classes
        by_token = dict(zip(v.tokens, v.ids.tolist(), strict=True))
        self.single = np.array([by_token.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.size = int(v.ids.max(initial=-1)) + 1
        # Stretches begin where the kind of the bytes changes, as words do, and before blanks.
        kind = np.array([1 if chr(b).isalpha() or b >= 0x80 else 2 if chr(b).isdigit() else 0 for b in range(256)], np.uint8)
        self.first, self.last = np.zeros(self.size, np.uint8), np.zeros(self.size, np.uint8)
        for token, i in by_token.items():
            self.first[i], self.last[i] = 3 if token.startswith(b" ") else kind[token[0]], kind[token[-1]]
        self.ids_of, self.bytes_of = Memo(self._contract), Memo(self._join)

    def rest(self) -> None:
        """At the end of a task: other stages need the memory of an idle worker, whose answers can be computed again."""
        self.ids_of.forget_older()
        self.bytes_of.forget_older()
        give_back()

    def _run(self, query: str, given: pa.Table) -> pa.Array:
        self.connection.register("given", given)
        out = self.connection.sql(query).to_arrow_table().column(0).combine_chunks()
        self.connection.unregister("given")
        return out

    def _contract(self, words: list[str]) -> list[bytes]:
        """The ids of each word as 32-bit integers."""
        data = [w.encode() for w in words]
        out: list[bytes] = [b""] * len(words)
        for query, chosen in (
            (_SHORT, [i for i, d in enumerate(data) if len(d) <= LONG_WORD]),
            (_LONG, [i for i, d in enumerate(data) if len(d) > LONG_WORD]),
        ):
            for start, end in _blocks([len(data[i]) for i in chosen]):
                part = chosen[start:end]
                flat = self.single[np.frombuffer(b"".join(data[i] for i in part), np.uint8)]
                lengths, w = [len(data[i]) for i in part], np.arange(len(part), dtype=np.int32)
                if query is _SHORT:
                    signs = self._run(query, pa.table({"w": w, "toks": pa.array(_cut(_signs(flat), lengths), pa.string())})).to_pylist()
                    values, sizes = _unsigned("".join(signs)).tobytes(), [4 * len(x) for x in signs]
                else:
                    found = self._run(query, pa.table({"w": w, "toks": _lists(flat, lengths)}))
                    values, sizes = found.flatten().to_numpy().astype("<i4").tobytes(), (4 * np.diff(found.offsets.to_numpy())).tolist()
                for i, ids in zip(part, _cut(values, sizes), strict=True):
                    out[i] = ids
        return out

    def _join(self, stretches: list[bytes]) -> list[bytes]:
        """The bytes of each stretch of ids."""
        out: list[bytes] = []
        for start, end in _blocks([len(s) for s in stretches]):
            part = stretches[start:end]
            ids = np.frombuffer(b"".join(part), "<i4")
            given = pa.table({"w": np.arange(len(part), dtype=np.int32), "ids": _lists(ids, [len(s) // 4 for s in part])})
            out += [s.encode("latin-1") for s in self._run(_DECODE, given).to_pylist()]
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        words, counts = pretokens.pieces(texts, self.classes)
        if len(words) == 0:
            return np.zeros(0, np.int32), counts
        coded = words.dictionary_encode()
        answers = pa.array(self.ids_of.many(pretokens.listed(coded.dictionary)), pa.large_binary())
        taken = answers.take(coded.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] // 4
        ids = np.frombuffer(taken.buffers()[2], "<i4")[: ends[-1]]
        borders = ends[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(borders)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """All bytes in order, and the number of bytes of each sequence. An id outside the vocabulary is an error."""
        if len(ids) == 0:
            return memoryview(b""), np.zeros(len(counts), np.int64)
        if ids.min() < 0 or ids.max() >= self.size:
            raise ValueError("an id is outside the vocabulary")
        start = np.ones(len(ids), bool)
        start[1:] = self.first[ids[1:]] != self.last[ids[:-1]]
        ends = np.cumsum(counts)
        begins = ends - counts
        start[begins[counts > 0]] = True
        cut = np.flatnonzero(start)
        offsets = pa.py_buffer((np.append(cut, len(ids)) * 4).astype(np.int64))
        data = pa.py_buffer(np.ascontiguousarray(ids, "<i4"))
        stretches = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut), [None, offsets, data])
        coded = stretches.dictionary_encode()
        taken = pa.array(self.bytes_of.many(pretokens.listed(coded.dictionary)), pa.large_binary()).take(coded.indices)
        places = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
        borders = places[np.searchsorted(cut, np.append(begins, len(ids)))]
        return memoryview(taken.buffers()[2] or b"")[: places[-1]], np.diff(borders)


_codecs: dict[str, Codec] = {}


def _codec(path: str, vocabulary: Broadcast) -> Codec:
    if path not in _codecs:
        _codecs.clear()
        _codecs[path] = Codec(vocabulary.value)
    return _codecs[path]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]


def _share(spark: SparkSession, path: str) -> Broadcast:
    return spark.sparkContext.broadcast(read_vocabulary(path))


def _with_column(batch: pa.RecordBatch, arrays: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    keep = batch.num_columns - 1
    return pa.RecordBatch.from_arrays([*batch.columns[:keep], *arrays], [*batch.schema.names[:keep], *names])


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, and token_ids array<int> of the column `text` under the rank file at `path`."""
    shared = _share(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, shared)
        for batch in batches:
            texts = _texts(batch)
            for a, b in pretokens.slices(texts):
                ids, counts = codec.encode(texts[a:b])
                yield _with_column(batch.slice(a, b - a), [_lists(ids, counts.tolist())], ["token_ids"])
        codec.rest()

    chosen = docs.select(*keep, F.col(text).alias("__text"))
    kept = docs.select(*keep).schema.fields
    return chosen.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "token_ids array<int>"]))


def decode(tokens: DataFrame, path: str, ids: str = "token_ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, and decoded binary: the bytes of the column `ids`. A null within the ids is left out."""
    shared = _share(tokens.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, shared)
        for batch in batches:
            rows = [np.array(r or [], np.int32) for r in batch.column(batch.num_columns - 1).to_pylist()]
            counts = np.fromiter(map(len, rows), np.int64, len(rows))
            data, sizes = codec.decode(np.concatenate([np.zeros(0, np.int32), *rows]), counts)
            ends = np.cumsum(sizes)
            out = pa.array([bytes(data[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary())
            yield _with_column(batch, [out], ["decoded"])
        codec.rest()

    chosen = tokens.select(*keep, F.coalesce(F.array_compact(ids), F.array().cast("array<int>")).alias("__ids"))
    kept = tokens.select(*keep).schema.fields
    return chosen.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "decoded binary"]))


def round_trip(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """Encodes and decodes in one pass: the columns `keep`, n_tokens, and the SHA-256 of ids and of decoded bytes in hex.

    ids_sha256 is over the ids as little-endian unsigned 32-bit integers. `with_ids` adds token_ids.
    """
    shared = _share(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, shared)
        for batch in batches:
            texts = _texts(batch)
            for a, b in pretokens.slices(texts):
                ids, counts = codec.encode(texts[a:b])
                data, sizes = codec.decode(ids, counts)
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                digests: list[list[str]] = [[], []]
                for out, buffer, lengths in ((digests[0], raw, counts * 4), (digests[1], data, sizes)):
                    ends = np.cumsum(lengths)
                    out += [hashlib.sha256(buffer[e - n : e]).hexdigest() for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                arrays = [pa.array(counts, pa.int64()), *(pa.array(d, pa.string()) for d in digests)]
                names = ["n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    arrays, names = [*arrays, _lists(ids, counts.tolist())], [*names, "token_ids"]
                yield _with_column(batch.slice(a, b - a), arrays, names)
        codec.rest()

    chosen = docs.select(*keep, F.col(text).alias("__text"))
    kept = docs.select(*keep).schema.fields
    columns = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    return chosen.mapInArrow(run, ", ".join([*columns, *(["token_ids array<int>"] if with_ids else [])]))
