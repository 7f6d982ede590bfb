"""Counts, sums and means (registered queries)."""

from __future__ import annotations

from pyspark.sql import functions as F

from connlens.operators import aggregates as A
from connlens.plans.roles import interaction_text, interactions, over_interactions, raw_lines
from connlens.sources import (
    narrow_interactions,
    parse_fields,
    parse_interactions,
    pick_fields,
    register_view,
)


def _rows(spark, folder):
    return interactions(spark, folder)


def sql_topk_groups(spark, folder):
    """Text lines to fields, to typed columns, to a view, to SQL: the whole path in one query."""
    lines = interaction_text(spark, folder)
    register_view(parse_interactions(lines), "interactions")
    return A.sql_topk_groups(spark, "interactions", "service", 5)


def _count_rows(spark, folder):
    return A.count_rows(_rows(spark, folder))


def _class_ratio(spark, folder):
    return A.class_ratio(_rows(spark, folder), "neptune.")


def _class_totals(spark, folder):
    return A.class_totals(_rows(spark, folder))


def _reduce_sum(spark, folder):
    return A.reduce_sum(_rows(spark, folder), "duration")


def _mean_from_totals(spark, folder):
    return A.mean_from_totals(_rows(spark, folder), "duration")


def _aggregate_sum_count(spark, folder):
    return A.aggregate_sum_count(_rows(spark, folder), "duration", "attack <> 'normal.'")


def _fold_sum(spark, folder):
    total = A.fold_sum(_rows(spark, folder), "duration")
    nothing = A.fold_sum(_rows(spark, folder).filter("duration < 0"), "duration")
    return total.select(F.lit("all").alias("part"), "total").union(
        nothing.select(F.lit("none"), "total")
    )


def _sum_by_tag(spark, folder):
    """From text lines: the measure is decoded, nothing else."""
    fields = parse_fields(raw_lines(spark, folder))
    return A.sum_by_tag(
        pick_fields(fields, {0: ("duration", "double"), 41: "tag"}), "duration", "tag"
    )


def _count_by_tag(spark, folder):
    return A.count_by_tag(_rows(spark, folder))


def _sum_count_by_tag(spark, folder):
    return A.sum_count_by_tag(_rows(spark, folder), "duration")


def _mean_by_tag(spark, folder):
    return A.mean_by_tag(_rows(spark, folder), "duration")


def _group_count(spark, folder):
    narrow = narrow_interactions(_rows(spark, folder))
    return A.group_count(narrow, "attack", "protocol_type")


def _filtered_group_count(spark, folder):
    return A.filtered_group_count(
        _rows(spark, folder), ["duration < 1000", "dst_bytes = 0"], "protocol_type"
    )


def _group_by_predicate(spark, folder):
    narrow = narrow_interactions(_rows(spark, folder))
    return A.group_by_predicate(
        narrow, "dst_bytes = 0", "attack", "protocol_type", predicate_name="no_reply"
    )


QUERIES = {
    "sql_topk_groups": sql_topk_groups,
    "count_rows": _count_rows,
    "class_ratio": _class_ratio,
    "class_totals": _class_totals,
    "reduce_sum": _reduce_sum,
    "mean_from_totals": _mean_from_totals,
    "aggregate_sum_count": _aggregate_sum_count,
    "fold_sum": _fold_sum,
    "sum_by_tag": _sum_by_tag,
    "count_by_tag": _count_by_tag,
    "sum_count_by_tag": _sum_count_by_tag,
    "mean_by_tag": _mean_by_tag,
    "group_count": _group_count,
    "filtered_group_count": _filtered_group_count,
    "group_by_predicate": _group_by_predicate,
}

_CLASS = "CASE WHEN attack = 'normal.' THEN 'normal' ELSE 'attack' END"

ORACLES = {
    "sql_topk_groups": over_interactions(
        "SELECT service, count(*) AS interaction_count FROM interactions GROUP BY service "
        "ORDER BY interaction_count DESC, service LIMIT 5"
    ),
    "count_rows": "SELECT count(*) AS n FROM lineitem",
    "class_ratio": over_interactions(
        "SELECT round(avg(CASE WHEN attack = 'neptune.' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 3)"
        " AS ratio FROM interactions"
    ),
    "class_totals": over_interactions(
        "SELECT count(*) FILTER (WHERE attack = 'normal.') AS normal, "
        "count(*) FILTER (WHERE attack <> 'normal.') AS attack, count(*) AS total "
        "FROM interactions"
    ),
    "reduce_sum": over_interactions(
        f"SELECT {_CLASS} AS class, CAST(sum(duration) AS BIGINT) AS total "
        "FROM interactions GROUP BY 1"
    ),
    "mean_from_totals": over_interactions(
        f"SELECT {_CLASS} AS class, round(sum(duration)::DOUBLE / count(*), 3) AS mean "
        "FROM interactions GROUP BY 1"
    ),
    "aggregate_sum_count": over_interactions(
        "SELECT CAST(sum(duration) AS BIGINT) AS total, count(*) AS n FROM interactions "
        "WHERE attack <> 'normal.'"
    ),
    "fold_sum": over_interactions(
        "SELECT 'all' AS part, sum(duration)::DOUBLE AS total FROM interactions "
        "UNION ALL SELECT 'none', 0.0::DOUBLE"
    ),
    "sum_by_tag": over_interactions(
        "SELECT attack AS tag, CAST(sum(duration) AS DOUBLE) AS total FROM interactions GROUP BY attack"
    ),
    "count_by_tag": over_interactions(
        "SELECT attack, count(*) AS n FROM interactions GROUP BY attack"
    ),
    "sum_count_by_tag": over_interactions(
        "SELECT attack, CAST(sum(duration) AS BIGINT) AS total, count(*) AS n "
        "FROM interactions GROUP BY attack"
    ),
    "mean_by_tag": over_interactions(
        "SELECT attack, round(avg(duration), 3) AS mean FROM interactions GROUP BY attack"
    ),
    "group_count": over_interactions(
        f"SELECT {_CLASS} AS attack, protocol_type, count(*) AS n FROM interactions "
        f"GROUP BY {_CLASS}, protocol_type"
    ),
    "filtered_group_count": over_interactions(
        "SELECT protocol_type, count(*) AS n FROM interactions "
        "WHERE duration < 1000 AND dst_bytes = 0 GROUP BY protocol_type"
    ),
    "group_by_predicate": over_interactions(
        f"SELECT {_CLASS} AS attack, protocol_type, dst_bytes = 0 AS no_reply, count(*) AS n "
        f"FROM interactions GROUP BY {_CLASS}, protocol_type, dst_bytes = 0"
    ),
}
