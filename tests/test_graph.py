import pytest
from pyspark.sql import functions as F

from connlens.operators import graph as G


def graph(spark, edges):
    table = spark.createDataFrame([(s, d, "r") for s, d in edges], "a string, b string, r string")
    return G.build_graph(table, "a", "b", "r")


def reference(edges, steps, reset=0.15):
    names = sorted({v for e in edges for v in e})
    out = {v: sum(1 for s, _ in edges if s == v) for v in names}
    rank = dict.fromkeys(names, 1.0)
    for _ in range(steps):
        new = dict.fromkeys(names, 0.0)
        for s, d in edges:
            new[d] += rank[s] / out[s]
        rank = {v: reset + (1 - reset) * new[v] for v in names}
    scale = len(names) / sum(rank.values())
    return {v: r * scale for v, r in rank.items()}


EDGES = {
    "cycle": [("a", "b"), ("b", "c"), ("c", "a")],
    "sink": [("a", "b"), ("a", "c"), ("b", "c")],
    "parallel": [("a", "b"), ("a", "b"), ("a", "c"), ("b", "a"), ("c", "a"), ("d", "d")],
    "hub": [("h", f"v{i}") for i in range(40)] + [(f"v{i}", "h") for i in range(0, 40, 3)],
}


@pytest.mark.parametrize("name", EDGES)
def test_pagerank_equals_brute_force(spark, name):
    edges = EDGES[name]
    ranks = {r.id: r.pagerank for r in G.pagerank(graph(spark, edges), iterations=6).collect()}
    assert ranks == pytest.approx(reference(edges, 6), abs=1e-9)
    assert sum(ranks.values()) == pytest.approx(len(ranks))


def test_hot_source_is_split(spark, monkeypatch):
    monkeypatch.setattr(G, "BLOCK_LINKS", 1_000)
    edges = spark.range(3000).select(
        F.when(F.col("id") < 2500, "hub").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("src"),
        F.concat(F.lit("t"), F.col("id")).alias("dst"),
        F.lit("r").alias("relationship"),
    )
    links, sources = G._weighted_links(edges)
    assert sources.filter("src = 'hub'").first().blocks == 3
    per_block = links.filter("src = 'hub'").groupBy("block").count().collect()
    assert len(per_block) == 3 and sum(r["count"] for r in per_block) == 2500
    ranks = G.pagerank(G.build_graph(edges, "src", "dst", "relationship"), iterations=2)
    plain = reference([(r.src, r.dst) for r in edges.collect()], 2)
    assert {r.id: r.pagerank for r in ranks.collect()} == pytest.approx(plain, abs=1e-9)


def test_size_and_filter(spark):
    small = graph(spark, EDGES["parallel"])
    assert tuple(G.graph_size(small).first()) == (4, 6)
    assert G.edge_filter(small, "r").count() == 6 and G.edge_filter(small, "x").count() == 0


def test_links_stay_where_they_are(spark, monkeypatch):
    """No step of PageRank moves the links: they are read as kept, without an exchange of their own."""
    plans = []
    real = G.cut_lineage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(G, "cut_lineage", seen)
    graph = G.build_graph(spark.range(500).selectExpr("id % 50 AS a", "id % 7 AS b"), "a", "b", F.lit("r"))
    G.pagerank(graph, iterations=1)
    step = plans[-1]
    assert "InMemoryTableScan" in step
    kept = [line for line in step.split("\n") if "InMemoryTableScan [src" in line or "InMemoryTableScan [id" in line]
    assert len(kept) >= 2
