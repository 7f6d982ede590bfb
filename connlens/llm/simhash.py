"""Near copies by SimHash fingerprints, found with BK-trees.

Fingerprints. Words are lower-cased (A-Z), runs of `words` words are hashed by XXH64, and a bit is 1 if it is set in over half of
the hashes. Each task makes the fingerprints of the texts it reads.

Shards. A fingerprint is cut into `blocks` blocks and goes to one shard for each choice of `equal` of them, named by their bits.
Fingerprints that differ in at most blocks - equal bits agree in `equal` blocks at least, so with radius <= blocks - equal no link is
lost.

Trees. The members of a shard form a BK-tree: children are keyed by their Hamming distance to the parent. Each member asks the tree
of those before it, following only edges within the radius of its distance to a node, and then joins it. Equal fingerprints are one
member, so copies cost nothing; members that link are united in the task, and each sends one link, to the smallest of its set. A
shard of the exact search has at most 2**26 different fingerprints, as only so many bits are free.

Components follow from the links (`components`). Nothing is broadcast or collected.

One of each (`one_of_each`) keeps the row with the smallest doc_id of each component, null last; of rows that share it, the one with the
smallest digest of all columns. Its components are those of fingerprints, so that rows of one doc_id and unlike texts all stay.

Defined results: a null or empty text, or one of blanks, has fingerprint zero, linked like any other; fewer words than a run are one run;
rows that repeat are kept; a null doc_id is no component's name unless no other is there (then null); an empty table gives an
empty table; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.llm.common import with_suffix, written
from connlens.llm.components import components

NO_ID = 2**63 - 1


@dataclass(frozen=True)
class Search:
    words: int = 3
    radius: int = 2
    blocks: int = 5
    equal: int = 3
    seed: int = 42


#: By contract: all links at two bits or fewer.
EXACT = Search()


def _hashes(words: list[bytes], n: int, seed: int) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        runs: Iterator[bytes] = iter([b" ".join(words)])
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
    return np.fromiter((xxhash.xxh64_intdigest(r, seed) for r in runs), np.uint64, max(1, len(words) - n + 1))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 100_000):
        part = hashes[start : start + 100_000].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def _prints(how: Search):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = [fingerprint(_hashes((t or "").encode().lower().split(), how.words, how.seed)) for t in texts]
            prints = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], prints], [*batch.schema.names[:-1], "print"])

    return run


def fingerprints(docs: DataFrame, how: Search = EXACT, text: str = "text", doc_id: str = "doc_id", digest: Column | None = None) -> DataFrame:
    """doc_id, print long (the 64 bits); between them the column `digest` string, if given."""
    more = [] if digest is None else [digest.alias("digest")]
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *more, F.col(text).alias("text"))
    return plain.mapInArrow(_prints(how), "doc_id long, " + ("digest string, " if more else "") + "print long")


def _shards(how: Search) -> Column:
    """Names of the shards of the column print."""
    edges = [64 * i // how.blocks for i in range(how.blocks + 1)]
    names = []
    for k, chosen in enumerate(combinations(range(how.blocks), how.equal)):
        name = F.lit(k).cast("long")
        for b in chosen:
            width = edges[b + 1] - edges[b]
            part = F.shiftrightunsigned("print", edges[b]).bitwiseAND((1 << width) - 1)
            name = F.shiftleft(name, width).bitwiseOR(part)
        names.append(name)
    return F.explode(F.array(*names))


class BKTree:
    """Nodes are (print, place, children by distance)."""

    def __init__(self) -> None:
        self.root: tuple[int, int, dict] | None = None

    def within(self, value: int, radius: int) -> list[int]:
        """Places of the nodes at most `radius` bits away."""
        out, todo = [], [self.root] if self.root else []
        while todo:
            other, place, children = todo.pop()
            d = (value ^ other).bit_count()
            if d <= radius:
                out.append(place)
            if children:
                todo += [child for edge, child in children.items() if -radius <= edge - d <= radius]
        return out

    def add(self, value: int, place: int) -> None:
        if self.root is None:
            self.root = (value, place, {})
            return
        node = self.root
        while True:
            d = (value ^ node[0]).bit_count()
            following = node[2].get(d)
            if following is None:
                node[2][d] = (value, place, {})
                return
            node = following


def _linked(values: list[int], nodes: list[int], how: Search) -> list[tuple[int, int]]:
    """For each member that links to others, its node and the smallest node that its links lead to."""
    above = list(range(len(values)))

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    tree = BKTree()
    for i, value in enumerate(values):
        for j in tree.within(value, how.radius):
            a, b = top(i), top(j)
            if a != b:
                if nodes[a] > nodes[b]:
                    a, b = b, a
                above[b] = a
        tree.add(value, i)
    return [(nodes[i], nodes[top(i)]) for i in range(len(values)) if top(i) != i]


def _search(how: Search):
    def groups(table: pa.Table, cut: np.ndarray) -> Iterator[tuple[int, int]]:
        yield from ((a, b) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) if b - a > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def links(table: pa.Table, last: bool) -> tuple[pa.Table, list[tuple[int, int]]]:
            """Links within all shards that are complete, and the rows of the one that isn't."""
            shard = table.column("shard").to_numpy()
            cut = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)]])
            keep = len(shard) if last else int(cut[-2])
            cut = cut[cut <= keep]
            values = table.column("print").to_numpy().view(np.uint64).tolist()
            nodes = table.column("node").to_pylist()
            found: list[tuple[int, int]] = []
            for a, b in groups(table, cut):
                found += _linked(values[a:b], nodes[a:b], how)
            return table.slice(keep), found

        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            if rest is not None and rest.num_rows:
                table = pa.concat_tables([rest, table]).combine_chunks()
                if rest.num_rows > batch.num_rows and table.column("shard")[0] == table.column("shard")[-1]:
                    rest = table  # a shard of many batches: wait for its end
                    continue
            rest, found = links(table, last=False)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])
        if rest is not None and rest.num_rows:
            _, found = links(rest, last=True)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return run


def _links(members: DataFrame, how: Search) -> DataFrame:
    """Links (a, b) between the nodes of `members` (print, node), whose prints differ from each other."""
    spread = members.select(_shards(how).alias("shard"), "print", "node")
    return spread.repartition("shard").sortWithinPartitions("shard", "print").mapInArrow(_search(how), "a long, b long")


def near_components(docs: DataFrame, how: Search = EXACT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    prints = written(fingerprints(docs, how, text, doc_id), "prints")
    node = F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("node")
    members = written(prints.groupBy("print").agg(node), "print-members")
    named = members.join(components(_links(members, how)), "node", "left")
    named = named.select("print", F.coalesce("component", "node").alias("component_id"))
    joined = prints.join(named, "print")
    component = F.when(F.col("component_id") != NO_ID, F.col("component_id"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return joined.select("doc_id", digits.alias("fingerprint"), component.alias("component_id"))


def one_of_each(docs: DataFrame, how: Search = EXACT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of `docs` for each component."""
    digest = F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns))))
    prints = fingerprints(docs, how, text, doc_id, digest)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("best")
    members = written(prints.groupBy("print").agg(best).withColumn("node", F.col("print")), "print-members")
    named = members.join(components(_links(members, how)), "node", "left")
    stays = named.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("best").alias("best"))
    own = with_suffix(docs.columns, "row_digest")
    stays = written(stays.select(F.col("best.digest").alias(own)), "print-stays")
    # Equal rows become one before the join, so that no digest has more than one row.
    rows = docs.withColumn(own, digest).dropDuplicates([own])
    return rows.join(stays, own, "left_semi").select(*(f"`{c}`" for c in docs.columns))


ORACLE = None
