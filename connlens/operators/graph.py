"""Property graphs as two DataFrames, and PageRank by joins and grouped sums."""

from __future__ import annotations

from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.sources.storage import cut_lineage

# Links of one source in one join key. A source with more is spread over several keys.
BLOCK_LINKS = 1_000_000


class Graph(NamedTuple):
    vertices: DataFrame  # id
    edges: DataFrame  # src, dst, relationship


def build_graph(
    df: DataFrame, src: str | Column, dst: str | Column, relationship: str | Column
) -> Graph:
    """Labelled edges from two columns; the vertices are all their endpoints."""

    def named(column: str | Column, name: str) -> Column:
        return (F.col(column) if isinstance(column, str) else column).alias(name)

    edges = df.select(
        named(src, "src"), named(dst, "dst"), named(relationship, "relationship")
    )
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return Graph(ends.distinct(), edges)


def graph_size(graph: Graph) -> DataFrame:
    """Vertex and edge counts in one row."""
    counts = graph.vertices.agg(
        F.count(F.lit(1)).alias("vertices"), F.lit(0).cast("long").alias("edges")
    ).union(graph.edges.agg(F.lit(0).cast("long"), F.count(F.lit(1))))
    return counts.agg(F.sum("vertices").alias("vertices"), F.sum("edges").alias("edges"))


def edge_filter(graph: Graph, relationship: str) -> DataFrame:
    return graph.edges.filter(F.col("relationship") == relationship)


def _weighted_links(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, sources): parallel edges merged to a weight, and out-degree per source.

    A source with very many targets gets several ``block`` numbers. Its links are split over them
    and its rank is copied to each, so that no join key has more than ``BLOCK_LINKS`` links,
    whatever the size of the table. There are at most links / BLOCK_LINKS such sources.
    """
    links = cut_lineage(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight")))
    sources = links.groupBy("src").agg(
        F.sum("weight").alias("out"), F.count(F.lit(1)).alias("targets")
    )
    blocks = F.ceil(F.col("targets") / BLOCK_LINKS).cast("int")
    sources = sources.select("src", "out", blocks.alias("blocks"))
    hot = sources.filter("blocks > 1").select("src", "blocks")
    place = F.pmod(F.xxhash64("dst"), F.coalesce("blocks", F.lit(1))).cast("int")
    links = links.join(hot, "src", "left").select(
        "src", place.alias("block"), "dst", "weight"
    )
    return links, sources


def pagerank(
    graph: Graph, reset: float = 0.15, iterations: int = 10, checkpoint_every: int = 5
) -> DataFrame:
    """Static PageRank (id, pagerank); the ranks sum to the number of vertices.

    All vertices start at 1. A step gives every vertex ``reset`` plus ``1 - reset`` of the shares
    received. Where vertices without outgoing edges lose rank, the result is scaled back.

    Links and vertices are partitioned by their join keys once and kept so: a step moves the
    shares and what they add up to, never the links. A lost part of them is read again from the
    written copy.
    """
    links, sources = _weighted_links(graph.edges)
    vertices = graph.vertices.join(sources, graph.vertices["id"] == sources["src"], "left").select(
        "id", "out", "blocks"
    )
    parts = int(graph.edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = links.repartition(parts, "src", "block").persist(StorageLevel.MEMORY_AND_DISK)
    vertices = cut_lineage(vertices)
    vertices = vertices.repartition(parts, "id").persist(StorageLevel.MEMORY_AND_DISK)
    ranks = vertices.withColumn("rank", F.lit(1.0))
    for step in range(1, iterations + 1):
        shares = ranks.filter("out IS NOT NULL").select(
            F.col("id").alias("src"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
            (F.col("rank") / F.col("out")).alias("share"),
        )
        received = (
            links.join(shares, ["src", "block"])
            .groupBy("dst")
            .agg(F.sum(F.col("weight") * F.col("share")).alias("received"))
        )
        rank = F.lit(reset) + (1.0 - reset) * F.coalesce("received", F.lit(0.0))
        ranks = vertices.join(received, vertices["id"] == received["dst"], "left").select(
            "id", "out", "blocks", rank.alias("rank")
        )
        if step % checkpoint_every == 0 or step == iterations:
            ranks = cut_lineage(ranks)
    total, size = ranks.agg(F.sum("rank"), F.count(F.lit(1))).first()
    for kept in (links, vertices):  # the ranks are written by now
        kept.unpersist()
    scale = size / total if total else 1.0
    return ranks.select("id", (F.col("rank") * scale).alias("pagerank"))


def pagerank_top(ranks: DataFrame, k: int = 10) -> DataFrame:
    return ranks.orderBy(F.desc("pagerank"), F.asc("id")).limit(k)
