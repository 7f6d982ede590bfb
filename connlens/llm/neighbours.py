"""Approximate nearest neighbours by learned partitions: the largest inner products.

Learning. On a bounded sample (the `sample` rows of smallest digest of vec_id) the graph of nearest neighbours is built and cut into
2**levels partitions of equal size, by halving: rows are ordered along the main direction, then rows trade sides in pairs
while that lets more neighbours be together. A small network learns which partitions hold a row and its neighbours. The sample, its
graph by blocks and the network are on the driver; their size doesn't depend on the table.

Index. The network sends every row to its most probable partition, and each query to as many of the most probable as have
`mass` of the probability together and more than `k` rows; `mass` is the least of a few values with which neighbours within the sample reach `wanted` recall.
Rows that repeat an id with its vector are dropped first. Partitions are divided into blocks of about `block` rows by digest of vec_id and
vector, and so are the queries of a partition, so that a partition, or an id, that holds a third of all rows is many tasks. A task reranks one block of queries against one block of rows in
double precision and returns the nearest `k` ids of each query, each with its best score; these are ranked by query.

Nothing is broadcast but the network. Recall is measured against brute force in the tests and given in the README.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do those whose length isn't
the most frequent (the smaller one on a tie). Rows that repeat a vec_id count once per query, with their best score; a query's own
vec_id is no candidate. Ties go to the smaller vec_id, null vec_ids take no part. An empty table gives an empty table; extra
columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from connlens.llm.common import written


@dataclass(frozen=True)
class Index:
    k: int = 20
    every: int = 20  # queries are the rows whose vec_id it divides
    sample: int = 4096
    graph: int = 10
    levels: int = 5
    hidden: int = 128
    rounds: int = 30
    wanted: float = 0.95
    block: int = 4096


@dataclass
class Router:
    """Probability of each partition."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    mass: float = 1.0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def chosen(self, p: np.ndarray, mass: float, sizes: np.ndarray | None = None, k: int = 0) -> np.ndarray:
        """For each row the partitions that have `mass` together and hold more than `k` rows, as a table of booleans."""
        order = np.argsort(-p, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(p, order, 1), axis=1) - np.take_along_axis(p, order, 1)
        wanted = before < mass
        if sizes is not None:
            wanted |= np.cumsum(sizes[order], axis=1) - sizes[order] <= k
        out = np.zeros(p.shape, bool)
        np.put_along_axis(out, order, wanted, 1)
        return out


def _graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows with the largest inner products of each row."""
    out = []
    for i in range(0, len(x), 256):
        s = x[i : i + 256] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out.append(np.argpartition(-s, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def _halves(rows: np.ndarray, graph: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of `rows` between which few edges run."""
    n = len(rows)
    place = np.full(len(graph), -1)
    place[rows] = np.arange(n)
    src, dst = np.repeat(np.arange(n), graph.shape[1]), place[graph[rows]].ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    a, b = np.concatenate([src, dst]), np.concatenate([dst, src])
    centred = x[rows] - x[rows].mean(axis=0)
    side = np.zeros(n, np.int64)
    side[np.argsort(centred @ np.linalg.svd(centred.T @ centred)[0][:, 0], kind="stable")[n // 2 :]] = 1
    for _ in range(40):
        gain = np.bincount(a, 2.0 * (side[a] != side[b]) - 1, n)
        left, right = (np.flatnonzero(side == s) for s in (0, 1))
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        pairs = min(len(left), len(right))
        better = int((gain[left[:pairs]] + gain[right[:pairs]] > 0).sum())
        if not better:
            break
        few = max(1, better // 4)  # a few at a time, since each trade changes the gains of others
        side[left[:few]], side[right[:few]] = 1, 0
    return rows[side == 0], rows[side == 1]


def learned(x: np.ndarray, how: Index) -> Router:
    """The router for the sample `x`."""
    rng = np.random.default_rng(5)
    parts, k = 2**how.levels, min(how.graph, len(x) - 1)
    if len(x) < 32 * parts:  # too few rows to cut: one partition
        d = x.shape[1]
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph, sets = _graph(x, k), [np.arange(len(x))]
    for _ in range(how.levels):
        sets = [half for rows in sets for half in _halves(rows, graph, x)]
    part = np.empty(len(x), np.int64)
    for i, rows in enumerate(sets):
        part[rows] = i
    wanted = np.zeros((len(x), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(x)), k), part[graph].ravel()), 0.5 / k)
    wanted[np.arange(len(x)), part] += 0.5
    weights = [rng.normal(size=(x.shape[1], how.hidden)) * 0.3, np.zeros(how.hidden), rng.normal(size=(how.hidden, parts)) * 0.1, np.zeros(parts)]
    mean, square, t = [0.0 * w for w in weights], [0.0 * w for w in weights], 0
    for _ in range(how.rounds):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 256):
            rows = order[i : i + 256]
            h = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            p = Router(*weights)(x[rows])
            dz = (p - wanted[rows]) / len(rows)
            dh = dz @ weights[2].T * (h > 0)
            t += 1
            for j, g in enumerate((x[rows].T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0))):
                mean[j], square[j] = 0.9 * mean[j] + 0.1 * g, 0.999 * square[j] + 0.001 * g * g
                weights[j] -= 0.003 * (mean[j] / (1 - 0.9**t)) / (np.sqrt(square[j] / (1 - 0.999**t)) + 1e-8)
    router = Router(*weights)
    p = router(x)
    home = p.argmax(axis=1)
    near = _graph(x, min(how.k, len(x) - 1))
    for mass in (0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.925, 0.95, 0.97, 0.98, 0.99, 1.0):
        if np.take_along_axis(router.chosen(p, mass), home[near], 1).mean() >= how.wanted:
            break
    router.mass = mass
    return router


def _sample(valid: DataFrame, size: int, rows: int, width: int) -> np.ndarray:
    """Vectors of the `size` smallest digests of vec_id; little more than these come to the driver, each id once."""
    digest = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40))
    share = min(1.0, 1.2 * size / max(1, rows))
    found = valid.filter(digest < int(share * (1 << 40))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    chosen = sorted(found.select(digest.alias("digest"), "vec_id", "vector").collect())[:size]
    return np.array([r["vector"] for r in chosen], np.float64).reshape(-1, width)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _route(router: Router, width: int, sizes: np.ndarray | None = None, k: int = 0):
    """Rows with their partition; with the `sizes` of the partitions, queries with each that they ask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            p = router(_matrix(batch.column(1), width))
            row, part = np.arange(len(p)), p.argmax(axis=1)
            if sizes is not None:
                row, part = np.nonzero(router.chosen(p, router.mass, sizes, k))
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *taken.columns], ["part", "vec_id", "vector"])

    return run


def nearest(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query ids, ids and scores of the k nearest of `x` to each row of `q`, by score, then id."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    first_rows = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))  # of each id
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for start in range(0, len(q), 512):
        part, names = q[start : start + 512], qids[start : start + 512]
        scores = part @ x.T
        scores[names[:, None] == ids] = -np.inf
        best = np.maximum.reduceat(scores, first_rows, axis=1) if len(first_rows) < len(ids) else scores
        keep = min(k, len(first_rows))
        least = np.partition(best, len(first_rows) - keep, axis=1)[:, len(first_rows) - keep]
        # All that rounding could bring among the nearest, scored again in one fixed way.
        row, col = np.nonzero((scores >= (least - 1e-9 * (1 + np.abs(least)))[:, None]) & np.isfinite(scores))
        exact = np.concatenate([np.zeros(0), *((part[row[i : i + 50_000]] * x[col[i : i + 50_000]]).sum(axis=1) for i in range(0, len(row), 50_000))])
        order = np.lexsort((ids[col], -exact, row))
        row, col, exact = row[order], col[order], exact[order]
        # Rows that repeat an id: the best of each, which comes first.
        _, first = np.unique(np.stack([row, ids[col]], 1), axis=0, return_index=True)
        first = np.sort(first)
        row, col, exact = row[first], col[first], exact[first]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        row, col, exact = row[place < k], col[place < k], exact[place < k]
        out.append((names[row], ids[col], exact))
    return tuple(np.concatenate(parts) for parts in zip(*out, strict=True))  # type: ignore[return-value]


def _rerank(k: int, width: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        else:
            sides = [(t.column("vec_id").to_numpy(), _matrix(t.column("vector").combine_chunks(), width)) for t in (rows, queries)]
            found = nearest(*sides[0], *sides[1], k)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2])})

    return run


def _blocks(routed: DataFrame, block: int, parts: int) -> tuple[Column, dict[int, int], np.ndarray]:
    """Block of each row within its partition, the number of blocks of each partition, and the partitions' sizes."""
    sizes = np.zeros(parts, np.int64)
    for p, n in routed.groupBy("part").count().collect():
        sizes[p] = n
    counts = {p: -(-n // block) for p, n in enumerate(sizes.tolist()) if n}
    number = F.element_at(F.create_map(*(F.lit(x) for pair in counts.items() for x in pair)), F.col("part")) if counts else F.lit(1)
    return F.pmod(F.xxhash64("vec_id", "vector"), number.cast("long")).cast("int"), counts, sizes


def _spread(counts: dict[int, int]) -> Column:
    """All blocks of the other side of a partition; a partition without the other side has none."""
    if not counts:
        return F.explode(F.array().cast("array<int>"))
    number = F.element_at(F.create_map(*(F.lit(x) for pair in counts.items() for x in pair)), F.col("part"))
    return F.explode(F.when(number > 0, F.sequence(F.lit(0), number - 1)).otherwise(F.array().cast("array<int>")))


def search(vectors: DataFrame, how: Index | None = None, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for every row whose vec_id is divisible by `every`, the nearest rows that were found."""
    how = how or Index()
    value = F.col(embedding).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    valid = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), value.alias("vector")).filter(F.col("vec_id").isNotNull())
    valid = valid.filter(F.col("vector").isNotNull() & ~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0))
    widths = valid.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = widths[0] if widths else 1
    valid = valid.filter(F.size("vector") == width)
    router = learned(_sample(valid, how.sample, widths["count"] if widths else 0, width), how)
    schema = "part int, vec_id long, vector array<double>"
    rows = written(valid.distinct().mapInArrow(_route(router, width), schema), "ann-rows")
    row_block, row_counts, sizes = _blocks(rows, how.block, len(router.b2))
    asked = rows.filter(F.col("vec_id") % how.every == 0).select("vec_id", "vector")
    queries = written(asked.mapInArrow(_route(router, width, sizes, how.k), schema), "ann-queries")
    query_block, query_counts, _ = _blocks(queries, how.block, len(router.b2))
    left = rows.withColumn("row_block", row_block).withColumn("query_block", _spread(query_counts))
    right = queries.withColumn("query_block", query_block).withColumn("row_block", _spread(row_counts))
    keys = ("part", "row_block", "query_block")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_rerank(how.k, width), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= how.k).select("query_id", "rank", "vec_id", "score")
