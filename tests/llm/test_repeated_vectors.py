"""Neighbours where rows repeat an id, with the same vector or with others."""

from collections import defaultdict

import numpy as np

from connlens.llm import neighbours


def brute(rows, k=20, every=20):
    best = defaultdict(dict)
    for q, v in rows:
        if q % every == 0:
            for i, x in rows:
                if i != q:
                    score = float((np.array(v) * np.array(x)).sum())
                    best[q][i] = max(score, best[q].get(i, -np.inf))
    return {q: sorted(((i, s) for i, s in found.items()), key=lambda p: (-p[1], p[0]))[:k] for q, found in best.items()}


def searched(spark, rows, how=None):
    found = defaultdict(list)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for r in neighbours.search(table, how).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    return dict(found)


def test_every_row_repeated(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    assert searched(spark, rows + rows) == brute(rows)


def test_ids_with_many_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(150)]
    rows += [(i, (rng.normal(size=6) * 3).tolist()) for i in (7, 8) for _ in range(60)]
    wanted = brute(rows)
    assert searched(spark, rows) == wanted
    assert searched(spark, rows, neighbours.Index(levels=1, wanted=1.1, block=30)) == wanted
