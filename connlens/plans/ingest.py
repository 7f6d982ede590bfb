"""Sources, parsing and sinks (registered queries)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from connlens.fields import FIELD_COUNT, FIELD_NAMES, INTERACTION_SCHEMA, LABELS, NARROW_FIELDS
from connlens.functions import field_at
from connlens.plans.roles import (
    RAW_LINE,
    interaction_text,
    interactions,
    over_interactions,
    raw_lines,
    raw_text,
)
from connlens.sources import (
    kept,
    narrow_interactions,
    new_scratch_path,
    parse_fields,
    parse_interactions,
    parse_outcome,
    pick_fields,
    preview,
    publish,
    published,
    range_source,
    read_lines,
    read_table,
    register_view,
    schema_report,
    split_rejects,
    spread,
    write_result,
)


def written_lines(spark: SparkSession, folder: str, name: str) -> str:
    """The raw lines as gzip text files in the shared folder."""
    path = new_scratch_path(spark, name)
    raw_lines(spark, folder).write.option("compression", "gzip").text(path)
    return path


def _read_lines(spark, folder):
    return read_lines(spark, written_lines(spark, folder, "lines"))


def _parse_fields(spark, folder):
    fields = parse_fields(raw_lines(spark, folder))
    return fields.select(
        F.size("fields").alias("arity"),
        *[field_at("fields", p).alias(f"f{p}") for p in range(FIELD_COUNT + 1)],
    )


def _pick_fields(spark, folder):
    wanted = {0: ("duration", "bigint"), 2: "service", 24: ("serror_rate", "double"), 41: "tag"}
    return pick_fields(parse_fields(raw_lines(spark, folder)), wanted)


def _parse_interactions(spark, folder):
    return parse_interactions(interaction_text(spark, folder))


def damaged_text(lines: DataFrame) -> DataFrame:
    """Interaction lines, some of them damaged by a rule over their own fields.

    The fields come out of a generator, so that a line is split once and not for every rule.
    """
    fields = F.split("value", ",")
    chosen = F.struct(*[field_at("fields", p).alias(n) for n, p in (("flag", 3), ("rate", 26), ("hot", 9))])
    lines = lines.select("value", F.explode(F.array(fields)).alias("fields")).select("value", F.inline(F.array(chosen)))
    flag, rate, hot = F.col("flag"), F.col("rate").cast("double"), F.col("hot")
    line = F.col("value")
    damaged = (
        F.when((flag == "REJ") & (hot == "0"), F.lit("  "))
        .when((flag == "SF") & (hot == "1"), F.substring_index(line, ",", 41))
        .when((flag == "SF") & (hot == "2"), F.concat(line, F.lit(",x")))
        .when((flag == "S0") & (rate == 0.0), F.concat(F.lit("ten"), line))
        .when((flag == "S0") & (hot == "3"), F.regexp_replace(line, r"^([^,]*,){4}", "$0x"))
        .when((flag == "SF") & (hot == "3"), F.concat(F.substring_index(line, ",", 41), F.lit(",unheard.")))
        .otherwise(line)
    )
    return lines.select(damaged.alias("value"))


def _parse_reject(spark, folder):
    outcome = parse_outcome(damaged_text(interaction_text(spark, folder)))
    reason = F.coalesce("reason", F.lit("good"))
    return outcome.groupBy(reason.alias("reason")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration").alias("total_duration")
    )


def _rejected_lines(spark, folder):
    """Every rejected line with its reason; a label that the record layout doesn't know is one."""
    path = new_scratch_path(spark, "damaged")
    damaged_text(raw_lines(spark, folder)).write.option("compression", "gzip").text(path)
    _, rejected = split_rejects(read_lines(spark, path), labels=LABELS)
    return rejected


def _narrow(spark, folder):
    return narrow_interactions(parse_interactions(interaction_text(spark, folder)))


def _range(spark, folder):
    """Numbers up to the last order key, and which of them no order has."""
    lines = read_table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("id"))
    lines = lines.agg(F.count(F.lit(1)).alias("lines"))
    last = lines.agg(F.max("id")).first()[0]
    numbers = range_source(spark, 0 if last is None else last + 1).join(lines, "id", "left")
    unused = F.col("lines").isNull()
    return numbers.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(unused).alias("unused"),
        F.sum(F.when(unused, F.col("id"))).alias("unused_total"),
        F.sum("lines").alias("lines"),
        F.max("id").alias("last"),
    )


def _register_view(spark, folder):
    register_view(interactions(spark, folder), "connlens_interactions")
    return spark.sql(
        "SELECT protocol_type, count(*) AS n, sum(duration) AS total_duration "
        "FROM connlens_interactions GROUP BY protocol_type"
    )


def _schema_report(spark, folder):
    return schema_report(interactions(spark, folder).select(*FIELD_NAMES))


def _preview(spark, folder):
    return preview(read_table(spark, folder, "events"), 5, "event_id").select(
        "event_id", "user_id", "event_type", "value"
    )


def _write_result(spark, folder):
    counts = interactions(spark, folder).select(*NARROW_FIELDS)
    path = new_scratch_path(spark, "published")
    publish(counts.filter("attack = 'normal.'"), path, ["attack"])  # replaced by the next
    publish(counts, path, ["attack"])
    return published(spark, path).groupBy("attack").agg(
        F.count(F.lit(1)).alias("n"), F.sum("src_bytes").alias("total_bytes")
    )


def _cache_table(spark, folder):
    """Two queries over one kept table, which is released when both have been written."""
    with kept(interactions(spark, folder).select("attack", "duration")) as rows:
        normal = rows.filter("attack = 'normal.'").agg(F.count(F.lit(1)).alias("n"))
        longest = rows.agg(F.max("duration").cast("long").alias("n"))
        both = normal.select(F.lit("normal").alias("what"), "n").union(
            longest.select(F.lit("longest"), "n")
        )
        return write_result(both, new_scratch_path(spark, "counts"))


def _spread(spark, folder):
    rows = spread(interactions(spark, folder).select("service", "duration"), 16, "service")
    return rows.groupBy("service").agg(F.sum("duration").alias("total_duration"))


QUERIES = {
    "read_lines": _read_lines,
    "parse_fields": _parse_fields,
    "pick_fields": _pick_fields,
    "parse_interactions": _parse_interactions,
    "parse_reject": _parse_reject,
    "rejected_lines": _rejected_lines,
    "narrow_interactions": _narrow,
    "range_source": _range,
    "register_view": _register_view,
    "schema_report": _schema_report,
    "cache_table": _cache_table,
    "spread": _spread,
    "preview": _preview,
    "write_result": _write_result,
}

_DAMAGE = (
    "CASE WHEN flag = 'REJ' AND hot = 0 THEN 'empty line' "
    "WHEN flag = 'SF' AND hot = 1 THEN 'too few fields' "
    "WHEN flag = 'SF' AND hot = 2 THEN 'too many fields' "
    "WHEN flag = 'S0' AND rerror_rate = 0 THEN 'bad number: duration' "
    "WHEN flag = 'S0' AND hot = 3 THEN 'bad number: src_bytes' ELSE 'good' END"
)
_REST, _UNHEARD = "ELSE 'good' END", "WHEN flag = 'SF' AND hot = 3 THEN 'unknown label' "
_DAMAGED_LINE = (
    "CASE reason WHEN 'empty line' THEN '  ' WHEN 'too many fields' THEN line || ',x' "
    "WHEN 'too few fields' THEN regexp_replace(line, ',[^,]*$', '') "
    "WHEN 'bad number: duration' THEN 'ten' || line "
    "WHEN 'unknown label' THEN regexp_replace(line, ',[^,]*$', ',unheard.') "
    "ELSE regexp_replace(line, '^(([^,]*,){4})', '\\1x') END"
)

ORACLES = {
    "read_lines": over_interactions(f"SELECT {RAW_LINE} AS value FROM interactions"),
    "parse_fields": over_interactions(
        f"SELECT {FIELD_COUNT} AS arity, "
        + ", ".join(f"{raw_text(name)} AS f{p}" for p, name in enumerate(FIELD_NAMES))
        + f", CAST(NULL AS VARCHAR) AS f{FIELD_COUNT} FROM interactions"
    ),
    "pick_fields": over_interactions(
        "SELECT duration, service, serror_rate, attack AS tag FROM interactions"
    ),
    "parse_interactions": over_interactions(
        "SELECT " + ", ".join(f'"{c}"' for c in FIELD_NAMES) + " FROM interactions"
    ),
    "parse_reject": over_interactions(
        f"SELECT reason, count(*) AS n, CAST(sum(CASE WHEN reason IN ('empty line', "
        "'bad number: duration') THEN NULL ELSE duration END) AS BIGINT) AS total_duration "
        f"FROM (SELECT {_DAMAGE} AS reason, duration FROM interactions) GROUP BY reason"
    ),
    "rejected_lines": over_interactions(
        f"SELECT {_DAMAGED_LINE} AS value, reason FROM (SELECT *, {RAW_LINE} AS line, "
        f"{_DAMAGE.replace(_REST, _UNHEARD + _REST)} AS reason FROM interactions) WHERE reason <> 'good'"
    ),
    "narrow_interactions": over_interactions(
        "SELECT duration, protocol_type, service, flag, src_bytes, dst_bytes, "
        "CASE WHEN attack = 'normal.' THEN 'normal' ELSE 'attack' END AS attack FROM interactions"
    ),
    "range_source": (
        "SELECT count(*) AS n, count(*) FILTER (WHERE l.lines IS NULL) AS unused, "
        "CAST(sum(i) FILTER (WHERE l.lines IS NULL) AS BIGINT) AS unused_total, "
        "CAST(sum(l.lines) AS BIGINT) AS lines, max(i) AS last "
        "FROM (SELECT unnest(range((SELECT max(l_orderkey) + 1 FROM lineitem))) AS i) "
        "LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1) l ON l.l_orderkey = i"
    ),
    "register_view": over_interactions(
        "SELECT protocol_type, count(*) AS n, CAST(sum(duration) AS BIGINT) AS total_duration "
        "FROM interactions GROUP BY protocol_type"
    ),
    "schema_report": over_interactions(
        " UNION ALL ".join(
            f"SELECT {p} AS position, '{c}' AS name, '{INTERACTION_SCHEMA[c].dataType.simpleString()}' AS type, "
            f'count("{c}") AS filled FROM interactions'
            for p, c in enumerate(FIELD_NAMES)
        )
    ),
    "cache_table": over_interactions(
        "SELECT 'normal' AS what, count(*) AS n FROM interactions WHERE attack = 'normal.' "
        "UNION ALL SELECT 'longest' AS what, max(duration) AS n FROM interactions"
    ),
    "spread": over_interactions(
        "SELECT service, CAST(sum(duration) AS BIGINT) AS total_duration "
        "FROM interactions GROUP BY service"
    ),
    "preview": "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 5",
    "write_result": over_interactions(
        "SELECT attack, count(*) AS n, CAST(sum(src_bytes) AS BIGINT) AS total_bytes "
        "FROM interactions GROUP BY attack"
    ),
}
