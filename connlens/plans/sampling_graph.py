"""Samples and graphs (registered queries)."""

from __future__ import annotations

from pyspark.sql import functions as F

from connlens.operators import graph as G
from connlens.operators import sampling as S
from connlens.sources import read_table

FRACTION = 0.1
SEED = 7
SAMPLE_ROWS = 700
PAGERANK_STEPS = 10


def _events(spark, folder):
    return read_table(spark, folder, "events").select("event_id", "event_type", "value")


def _sample_fraction(spark, folder):
    """What must hold for any Bernoulli sample: a part of the table, no row twice, a likely size."""
    rows = _events(spark, folder)
    sample = S.sample_fraction(rows, FRACTION, SEED)
    total = rows.agg(F.count(F.lit(1)).alias("total_rows"))
    found = sample.withColumn("sampled", F.lit(1)).join(rows, rows.columns, "left_semi")
    size = found.agg(F.count(F.lit(1)).alias("inside"), F.count_distinct("event_id").alias("ids"))
    drawn = sample.agg(F.count(F.lit(1)).alias("drawn"))
    both = total.select("*", F.lit(1).alias("one")).join(
        size.select("*", F.lit(1).alias("one")), "one"
    )
    both = both.join(drawn.select("*", F.lit(1).alias("one")), "one")
    deviation = F.abs(F.col("drawn") - F.col("total_rows") * FRACTION)
    likely = 5 * F.sqrt(F.col("total_rows") * FRACTION * (1 - FRACTION))
    return both.select(
        "total_rows",
        (F.col("inside") == F.col("drawn")).alias("part_of_table"),
        (F.col("ids") == F.col("drawn")).alias("no_row_twice"),
        (deviation <= likely).alias("likely_size"),
    )


def _sample_fraction_hash(spark, folder):
    return S.sample_fraction_hash(_events(spark, folder), "event_id", FRACTION, SEED)


def _sample_ratio(spark, folder):
    return S.sample_ratio(
        _events(spark, folder), "event_id", "event_type = 'error'", FRACTION, SEED
    )


def _sample_exact(spark, folder):
    return S.sample_exact(_events(spark, folder), "event_id", SAMPLE_ROWS, SEED)


def supply_graph(spark, folder) -> G.Graph:
    """Suppliers and parts. Returned goods point back from the part to the supplier."""
    rows = read_table(spark, folder, "lineitem")
    supplier = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    part = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    back = F.col("l_returnflag") == "R"
    return G.build_graph(
        rows,
        F.when(back, part).otherwise(supplier),
        F.when(back, supplier).otherwise(part),
        "l_returnflag",
    )


def _build_graph(spark, folder):
    graph = supply_graph(spark, folder)
    nothing = F.lit(None).cast("string")
    vertices = graph.vertices.select(
        F.lit("vertex").alias("kind"), "id", nothing.alias("dst"), nothing.alias("relationship")
    )
    edges = graph.edges.select(F.lit("edge"), "src", "dst", "relationship")
    return vertices.union(edges)


def _graph_size(spark, folder):
    return G.graph_size(supply_graph(spark, folder))


def _edge_filter(spark, folder):
    return G.edge_filter(supply_graph(spark, folder), "R")


def _pagerank(spark, folder):
    ranks = G.pagerank(supply_graph(spark, folder), iterations=PAGERANK_STEPS)
    return ranks.select("id", F.round("pagerank", 6).alias("pagerank"))


def _pagerank_top(spark, folder):
    ranks = G.pagerank(supply_graph(spark, folder), iterations=PAGERANK_STEPS)
    return G.pagerank_top(ranks).select("id", F.round("pagerank", 6).alias("pagerank"))


QUERIES = {
    "sample_fraction": _sample_fraction,
    "sample_fraction_hash": _sample_fraction_hash,
    "sample_ratio": _sample_ratio,
    "sample_exact": _sample_exact,
    "build_graph": _build_graph,
    "graph_size": _graph_size,
    "edge_filter": _edge_filter,
    "pagerank": _pagerank,
    "pagerank_top": _pagerank_top,
}

_IN_SAMPLE = (
    f"substr(md5(concat('{SEED}:', CAST(event_id AS VARCHAR))), 1, 8) "
    f"< '{round(FRACTION * 16**8):08x}'"
)
_ENDS = (
    "CASE WHEN l_returnflag = 'R' THEN 'p' || l_partkey ELSE 's' || l_suppkey END AS src, "
    "CASE WHEN l_returnflag = 'R' THEN 's' || l_suppkey ELSE 'p' || l_partkey END AS dst, "
    "l_returnflag AS relationship"
)
_EDGES = f"edges AS MATERIALIZED (SELECT {_ENDS} FROM lineitem)"
_VERTICES = (
    "vertices AS MATERIALIZED (SELECT src AS id FROM edges UNION SELECT dst FROM edges)"
)


def _pagerank_sql() -> str:
    steps = ["r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE AS rank FROM vertices)"]
    for step in range(1, PAGERANK_STEPS + 1):
        steps.append(
            f"r{step} AS MATERIALIZED (SELECT v.id, 0.15 + 0.85 * coalesce(s.received, 0) AS rank "
            f"FROM vertices v LEFT JOIN (SELECT e.dst, sum(r.rank / o.n) AS received "
            f"FROM edges e JOIN r{step - 1} r ON e.src = r.id JOIN outs o ON e.src = o.src "
            f"GROUP BY e.dst) s ON v.id = s.dst)"
        )
    last = f"r{PAGERANK_STEPS}"
    return (
        f"WITH {_EDGES}, {_VERTICES}, "
        "outs AS MATERIALIZED (SELECT src, count(*) AS n FROM edges GROUP BY src), "
        + ", ".join(steps)
        + f", scaled AS (SELECT id, round(rank * (SELECT count(*) FROM vertices) / "
        f"(SELECT sum(rank) FROM {last}), 6) AS pagerank FROM {last}) "
    )


ORACLES = {
    "sample_fraction": (
        "SELECT count(*) AS total_rows, true AS part_of_table, true AS no_row_twice, "
        "true AS likely_size FROM events"
    ),
    "sample_fraction_hash": f"SELECT event_id, event_type, value FROM events WHERE {_IN_SAMPLE}",
    "sample_ratio": (
        f"SELECT count(*) FILTER (WHERE {_IN_SAMPLE}) AS sample_rows, count(*) AS total_rows, "
        "round(avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) "
        f"FILTER (WHERE {_IN_SAMPLE}), 3) AS sample_ratio, "
        "round(avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 3) "
        "AS exact_ratio FROM events"
    ),
    "sample_exact": (
        "SELECT event_id, event_type, value FROM events "
        f"ORDER BY md5(concat('{SEED}:', CAST(event_id AS VARCHAR))) LIMIT {SAMPLE_ROWS}"
    ),
    "build_graph": (
        f"WITH {_EDGES}, {_VERTICES} SELECT 'vertex' AS kind, id, "
        "CAST(NULL AS VARCHAR) AS dst, CAST(NULL AS VARCHAR) AS relationship FROM vertices "
        "UNION ALL SELECT 'edge', src, dst, relationship FROM edges"
    ),
    "graph_size": (
        f"WITH {_EDGES}, {_VERTICES} SELECT (SELECT count(*) FROM vertices) AS vertices, "
        "(SELECT count(*) FROM edges) AS edges"
    ),
    "edge_filter": f"SELECT {_ENDS} FROM lineitem WHERE l_returnflag = 'R'",
    "pagerank": _pagerank_sql() + "SELECT id, pagerank FROM scaled",
    "pagerank_top": _pagerank_sql()
    + "SELECT id, pagerank FROM scaled ORDER BY pagerank DESC, id LIMIT 10",
}
