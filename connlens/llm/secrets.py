"""Spans of secrets in texts.

Three kinds follow fixed patterns: values assigned to names of secrets, access keys, and long hexadecimal strings. The fourth, random,
is found by token efficiency: a long run of characters as in base 64 counts if a tiktoken vocabulary needs many tokens for it, since
the vocabulary holds what texts repeat and random strings repeat nothing: words in one case or put together have long tokens, random
letters don't. Left out are known digests, UUIDs, runs of digits alone, and what overlaps a span of another kind.

Every text is scanned whole in the task that reads it; nothing is shuffled or broadcast but the vocabulary file.

Defined results: spans are in code points, end exclusive; a null text has none; rows are kept as they are, repeats included; an empty
table gives an empty table; extra columns are kept by `redacted` and ignored by `scanned`.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connlens.llm.common import with_suffix

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
SIGNS = str.maketrans("", "", "_-/+=")
NAMES = ("passw", "secret", "token", "api")
#: Letters, digits and signs in a row that a word could not hold.
SHORTEST_RUN = 20


@dataclass(frozen=True)
class Efficiency:
    """A run is random if it has fewer characters per token than `ratio`."""

    ratio: float = 2.2
    #: Digests that are known to be harmless, as written.
    known: frozenset[str] = frozenset()


def _is_identifier(run: str) -> bool:
    """A UUID, or a number. Words are left to the ratio."""
    return bool(UUID.fullmatch(run)) or run.translate(SIGNS).isdigit()


class Scanner:
    def __init__(self, ranks: dict[bytes, int], pattern: str, how: Efficiency) -> None:
        import tiktoken

        self.encoding = tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.how = how

    def _random(self, run: str) -> bool:
        if run in self.how.known or _is_identifier(run):
            return False
        return len(run) < self.how.ratio * len(self.encoding.encode_ordinary(run))

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) in order."""
        out = []
        small = text.lower()
        if any(name in small for name in NAMES):
            out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
        # Every long run lies within something without white space that is as long.
        if max(map(len, text.split()), default=0) >= SHORTEST_RUN:
            out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
            # Runs and the other spans are walked together, so that time grows with the text. `upto` is the furthest end
            # of the spans that begin before the run ends.
            base, i, upto = sorted(out), 0, 0
            for m in RUN.finditer(text):
                while i < len(base) and base[i][0] < m.end():
                    i, upto = i + 1, max(upto, base[i][2])
                if upto <= m.start() and self._random(m[0]):
                    out.append((m.start(), 3, m.end()))
        return sorted(out)


_scanners: dict[tuple, Scanner] = {}


def _scanner(key: tuple, shared: Broadcast) -> Scanner:
    if key not in _scanners:
        _scanners.clear()
        _, pattern, how = key
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        _scanners[key] = Scanner(ranks, pattern, how)
    return _scanners[key]


def _share(docs: DataFrame, path: str) -> Broadcast:
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scanned(docs: DataFrame, path: str, pattern: str, how: Efficiency | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256 and spans (kind:start:end, comma-joined) of every document."""
    key, shared = (path, pattern, how or Efficiency()), _share(docs, path)
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(key, shared)
        for batch in batches:
            found = [scanner.spans(t or "") for t in batch.column(1).to_pylist()]
            count = lambda kind: pa.array([sum(k == kind for _, k, _ in s) for s in found], pa.int64())  # noqa: E731, B023
            base = [hashlib.sha256(_joined([x for x in s if x[1] < 3]).encode()).hexdigest() for s in found]
            columns = [batch.column(0), count(0), count(1), count(2), pa.array(base, pa.string()), pa.array([_joined(s) for s in found], pa.string()), count(3)]
            yield pa.RecordBatch.from_arrays(columns, names)

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    return plain.mapInArrow(run, schema)


def redacted(docs: DataFrame, path: str, pattern: str, how: Efficiency | None = None, text: str = "text", marker: str = "[secret]") -> DataFrame:
    """`docs` with each secret in the text replaced by `marker`; a null text stays null, a text without secrets stays as it is."""
    key, shared = (path, pattern, how or Efficiency()), _share(docs, path)

    def clean(scanner: Scanner, value: str | None) -> str | None:
        spans = scanner.spans(value) if value else []
        if not spans:
            return value
        parts, end = [], 0
        for s, _, e in spans:
            if s >= end:
                parts += [value[end:s], marker]
            end = max(end, e)
        return "".join([*parts, value[end:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(key, shared)
        for batch in batches:
            place = batch.num_columns - 1
            texts = pa.array([clean(scanner, t) for t in batch.column(place).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], texts], batch.schema.names)

    new = with_suffix(docs.columns, "clean_text")
    rows = docs.withColumn(new, F.col(text))
    rows = rows.select(*(f"`{c}`" for c in docs.columns if c != text), f"`{new}`")
    out = rows.mapInArrow(run, rows.schema)
    return out.select(*(F.col(new).alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns))
