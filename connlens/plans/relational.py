"""Projections, filters, pairs, set operations, sorts (registered queries)."""

from __future__ import annotations

from pyspark.sql import functions as F

from connlens.fields import FEATURE_GROUPS, FIELD_NAMES, LABEL_POSITION
from connlens.functions import std_from_variance
from connlens.operators import projections as P
from connlens.operators import setops as S
from connlens.operators.aggregates import count_rows, count_where, group_count, sort_desc, top_k
from connlens.plans.roles import (
    RAW_LINE,
    interaction_text,
    interactions,
    over_interactions,
    raw_line,
    raw_lines,
)
from connlens.sources import parse_fields, read_table

def _fields(spark, folder):
    return parse_fields(raw_lines(spark, folder))


def _narrow_numbers(spark, folder):
    return interactions(spark, folder).select("protocol_type", "duration", "dst_bytes")


def _select_columns(spark, folder):
    return P.select_columns(
        interactions(spark, folder), "protocol_type", "duration", "dst_bytes"
    )


def _project_expr(spark, folder):
    return P.project_expr(
        interactions(spark, folder),
        "protocol_type AS src",
        "service AS dst",
        "attack AS relationship",
        "src_bytes + dst_bytes AS all_bytes",
    )


def _cast_columns(spark, folder):
    fields = _fields(spark, folder).select(
        F.get("fields", F.lit(0)).alias("duration"),
        F.get("fields", F.lit(4)).alias("src_bytes"),
        F.get("fields", F.lit(24)).alias("serror_rate"),
        F.get("fields", F.lit(LABEL_POSITION)).alias("tag"),
    )
    return P.cast_columns(
        fields.withColumn("tag_number", F.col("tag")),
        {"duration": "double", "src_bytes": "bigint", "serror_rate": "double", "tag_number": "int"},
    )


def _add_column(spark, folder):
    rows = interactions(spark, folder).select("service", "duration", "serror_rate")
    rows = P.add_column(rows, "minutes", F.round(F.col("duration") / 60, 4))
    return P.add_column(rows, "is_long", "duration > 30")


def _filter_like(spark, folder):
    return count_rows(
        P.filter_like(interaction_text(spark, folder), "value", "%neptune.%")
    )


def _filter_contains(spark, folder):
    return count_rows(P.filter_contains(interaction_text(spark, folder), "value", "normal."))


def _filter_member(spark, folder):
    return P.filter_member(_fields(spark, folder), "fields", "neptune.").select("value")


def _filter_tag(spark, folder):
    rows = interactions(spark, folder).select("attack", "duration")
    kept = count_rows(P.filter_tag(rows, "normal.")).select(F.lit("normal").alias("class"), "n")
    rest = count_rows(P.filter_tag(rows, "normal.", keep=False))
    return kept.union(rest.select(F.lit("attack"), "n"))


def _filter_conjunction(spark, folder):
    return P.filter_conjunction(
        _narrow_numbers(spark, folder), F.col("duration") < 20, F.col("dst_bytes") == 0
    )


def _binary_label(spark, folder):
    rows = interactions(spark, folder).select("attack", "service")
    return P.with_binary_label(rows)


def _drop_fields(spark, folder):
    rows = interactions(spark, folder).select(*FEATURE_GROUPS["all_indexed"])
    gone = [c for c in FIELD_NAMES if c not in FEATURE_GROUPS["uncorrelated"]]
    return P.drop_fields(rows, gone)


def _key_by(spark, folder):
    parsed = _fields(spark, folder)
    full = P.key_by(parsed, "fields", LABEL_POSITION)
    short = P.key_by(parsed, "fields", LABEL_POSITION, keep_last=False)

    def shown(df, variant):
        return df.select(
            F.lit(variant).alias("variant"), "tag", F.concat_ws("|", "fields").alias("fields")
        )

    return shown(full, "all").union(shown(short, "without last"))


def _collect_tag(spark, folder):
    pairs = P.key_by(_fields(spark, folder), "fields", LABEL_POSITION)
    return P.collect_tag(pairs, "smurf.").select("tag", F.concat_ws("|", "fields").alias("fields"))


def _distinct_values(spark, folder):
    return P.distinct_values(interactions(spark, folder), "service", "flag")


def _format_row(spark, folder):
    counts = group_count(interactions(spark, folder), "service")
    return P.format_row(counts, "Service: %s, count: %d", "service", "n")


def _round_measure(spark, folder):
    events = read_table(spark, folder, "events")
    means = events.groupBy("user_id").agg(F.avg("value").alias("mean"))
    return P.round_measure(means, ["mean"], 3)


def _sqrt_abs(spark, folder):
    rows = interactions(spark, folder).groupBy("attack").agg(
        F.var_samp("duration").alias("variance"),
        F.corr("duration", "serror_rate").alias("rho"),
    )
    return rows.select(
        "attack",
        F.round(std_from_variance("variance"), 6).alias("std"),
        F.round(F.abs("rho"), 6).alias("strength"),
    )


def _cross_values(spark, folder):
    return S.cross_values(interactions(spark, folder), "attack", "service")


def _cross_count(spark, folder):
    return S.cross_count(interactions(spark, folder), "protocol_type", "service")


def _cross_observed(spark, folder):
    return S.cross_observed(interactions(spark, folder), "attack", "duration")


def _bags(spark, folder):
    rows = interactions(spark, folder).select("service", "flag", "attack")
    return rows, rows.filter("attack = 'normal.'")


def _except_distinct(spark, folder):
    return S.except_distinct(*_bags(spark, folder))


def _except_all(spark, folder):
    rows, normal = _bags(spark, folder)
    return S.except_all(rows, normal)


def _union_all(spark, folder):
    rows, normal = _bags(spark, folder)
    return group_count(S.union_all(rows, normal), "service", "attack")


def _intersect_rows(spark, folder):
    rows = interactions(spark, folder).select("service", "flag", "duration", "protocol_type")
    tcp = rows.filter("protocol_type = 'tcp'").drop("protocol_type")
    udp = rows.filter("protocol_type = 'udp'").drop("protocol_type")
    common = S.intersect_distinct(tcp, udp).select(F.lit("set").alias("kind"), "*")
    copies = S.intersect_all(tcp, udp).select(F.lit("bag").alias("kind"), "*")
    return common.union(copies)


def _sort_by_count(spark, folder):
    return group_count(interactions(spark, folder), "protocol_type", "service")


def _sort_desc(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return sort_desc(orders, "o_totalprice", "o_orderkey")


def _top_k(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return top_k(orders, 10, "o_totalprice", "o_orderkey")


def _count_where(spark, folder):
    return count_where(interactions(spark, folder), "attack = 'neptune.'")


QUERIES = {
    "select_columns": _select_columns,
    "project_expr": _project_expr,
    "cast_columns": _cast_columns,
    "add_column": _add_column,
    "filter_like": _filter_like,
    "filter_contains": _filter_contains,
    "filter_member": _filter_member,
    "filter_tag": _filter_tag,
    "filter_conjunction": _filter_conjunction,
    "binary_label": _binary_label,
    "drop_fields": _drop_fields,
    "key_by": _key_by,
    "collect_tag": _collect_tag,
    "distinct_values": _distinct_values,
    "format_row": _format_row,
    "round_measure": _round_measure,
    "sqrt_abs": _sqrt_abs,
    "cross_values": _cross_values,
    "cross_count": _cross_count,
    "cross_observed": _cross_observed,
    "except_distinct": _except_distinct,
    "except_all": _except_all,
    "union_all": _union_all,
    "intersect_rows": _intersect_rows,
    "sort_by_count": _sort_by_count,
    "sort_desc": _sort_desc,
    "top_k": _top_k,
    "count_where": _count_where,
}

_UNCORRELATED = (
    "duration, src_bytes, dst_bytes, land, wrong_fragment, urgent, hot, num_failed_logins, "
    "logged_in, num_compromised, root_shell, su_attempted, num_root, num_file_creations, "
    'num_shells, num_access_files, num_outbound_cmds, is_host_login, is_guest_login, "count", '
    "srv_count, serror_rate, rerror_rate, same_srv_rate, diff_srv_rate, srv_diff_host_rate, "
    "dst_host_count, dst_host_srv_count, dst_host_same_srv_rate, dst_host_diff_srv_rate, "
    "dst_host_srv_diff_host_rate, dst_host_serror_rate, dst_host_rerror_rate"
)
_PIPED, _PIPED_SHORT = raw_line("|"), raw_line("|", FIELD_NAMES[:-1])

ORACLES = {
    "select_columns": over_interactions(
        "SELECT protocol_type, duration, dst_bytes FROM interactions"
    ),
    "project_expr": over_interactions(
        "SELECT protocol_type AS src, service AS dst, attack AS relationship, "
        "src_bytes + dst_bytes AS all_bytes FROM interactions"
    ),
    "cast_columns": over_interactions(
        "SELECT CAST(duration AS DOUBLE) AS duration, src_bytes, serror_rate, attack AS tag, "
        "CAST(NULL AS INTEGER) AS tag_number FROM interactions"
    ),
    "add_column": over_interactions(
        "SELECT service, duration, serror_rate, round(duration / 60, 4) AS minutes, "
        "duration > 30 AS is_long FROM interactions"
    ),
    "filter_like": over_interactions(
        "SELECT count(*) AS n FROM interactions WHERE attack LIKE '%neptune.%'"
    ),
    "filter_contains": over_interactions(
        "SELECT count(*) AS n FROM interactions WHERE attack = 'normal.'"
    ),
    "filter_member": over_interactions(
        f"SELECT {RAW_LINE} AS value FROM interactions WHERE attack = 'neptune.'"
    ),
    "filter_tag": over_interactions(
        "SELECT CASE WHEN attack = 'normal.' THEN 'normal' ELSE 'attack' END AS class, "
        "count(*) AS n FROM interactions GROUP BY 1"
    ),
    "filter_conjunction": over_interactions(
        "SELECT protocol_type, duration, dst_bytes FROM interactions "
        "WHERE duration < 20 AND dst_bytes = 0"
    ),
    "binary_label": over_interactions(
        "SELECT attack, service, CASE WHEN attack = 'normal.' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE "
        "END AS label FROM interactions"
    ),
    "drop_fields": over_interactions(f"SELECT {_UNCORRELATED} FROM interactions"),
    "key_by": over_interactions(
        f"SELECT 'all' AS variant, attack AS tag, {_PIPED} AS fields FROM interactions "
        f"UNION ALL SELECT 'without last', attack, {_PIPED_SHORT} FROM interactions"
    ),
    "collect_tag": over_interactions(
        f"SELECT attack AS tag, {_PIPED} AS fields FROM interactions WHERE attack = 'smurf.'"
    ),
    "distinct_values": over_interactions("SELECT DISTINCT service, flag FROM interactions"),
    "format_row": over_interactions(
        "SELECT 'Service: ' || service || ', count: ' || count(*) AS line "
        "FROM interactions GROUP BY service"
    ),
    "round_measure": "SELECT user_id, round(avg(value), 3) AS mean FROM events GROUP BY user_id",
    "sqrt_abs": over_interactions(
        "SELECT attack, round(stddev_samp(duration), 6) AS std, "
        "round(abs(corr(duration, serror_rate)), 6) AS strength FROM interactions GROUP BY attack"
    ),
    "cross_values": over_interactions(
        "SELECT attack, service FROM (SELECT DISTINCT attack FROM interactions) "
        "CROSS JOIN (SELECT DISTINCT service FROM interactions)"
    ),
    "cross_count": over_interactions(
        "SELECT count(DISTINCT protocol_type) * count(DISTINCT service) AS pairs FROM interactions"
    ),
    "cross_observed": over_interactions(
        "WITH pairs AS (SELECT attack, duration FROM (SELECT DISTINCT attack FROM interactions) "
        "CROSS JOIN (SELECT DISTINCT duration FROM interactions)) "
        "SELECT p.attack, p.duration, count(k.attack) AS n, count(k.attack) > 0 AS observed "
        "FROM pairs p LEFT JOIN interactions k ON p.attack = k.attack "
        "AND p.duration = k.duration GROUP BY p.attack, p.duration"
    ),
    "except_distinct": over_interactions(
        "SELECT service, flag, attack FROM interactions "
        "EXCEPT SELECT service, flag, attack FROM interactions WHERE attack = 'normal.'"
    ),
    "except_all": over_interactions(
        "SELECT service, flag, attack FROM interactions "
        "EXCEPT ALL SELECT service, flag, attack FROM interactions WHERE attack = 'normal.'"
    ),
    "union_all": over_interactions(
        "SELECT service, attack, count(*) AS n FROM (SELECT service, attack FROM interactions "
        "UNION ALL SELECT service, attack FROM interactions WHERE attack = 'normal.') "
        "GROUP BY service, attack"
    ),
    "intersect_rows": over_interactions(
        "WITH tcp AS (SELECT service, flag, duration FROM interactions "
        "WHERE protocol_type = 'tcp'), "
        "udp AS (SELECT service, flag, duration FROM interactions WHERE protocol_type = 'udp') "
        "SELECT 'set' AS kind, * FROM (SELECT * FROM tcp INTERSECT SELECT * FROM udp) "
        "UNION ALL SELECT 'bag' AS kind, * FROM "
        "(SELECT * FROM tcp INTERSECT ALL SELECT * FROM udp)"
    ),
    "sort_by_count": over_interactions(
        "SELECT protocol_type, service, count(*) AS n FROM interactions "
        "GROUP BY protocol_type, service ORDER BY n"
    ),
    "sort_desc": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC",
    "top_k": (
        "SELECT o_orderkey, o_totalprice FROM orders "
        "ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"
    ),
    "count_where": over_interactions(
        "SELECT count(*) AS n FROM interactions WHERE attack = 'neptune.'"
    ),
}
