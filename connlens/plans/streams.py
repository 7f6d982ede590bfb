"""Streams run to their end over lines that Spark writes from the tables (registered queries)."""

from __future__ import annotations

from pyspark.sql import functions as F

from connlens.fields import FIELD_NAMES
from connlens.operators.aggregates import count_by_tag
from connlens.plans.ingest import written_lines
from connlens.plans.roles import (
    RAW_LINE,
    in_part,
    interaction_text,
    interactions,
    over_interactions,
    raw_lines,
)
from connlens.sources import (
    new_scratch_path,
    parse_fields,
    parse_interactions,
    pick_fields,
    register_view,
)
from connlens.streaming import (
    await_stream,
    batch_counts,
    follow_lines,
    lines_to_table,
    query_errors,
    query_results,
    skip_blank,
    start_query_stream,
    stream_lines,
)

VIEW = "stream_interactions"
TIMEOUT = 3600
#: Stored bytes of the table for one file of lines, where each file is a batch.
BATCH_STORED_BYTES = 64 << 20


def _to_table(lines, spark):
    """Run a line stream into a parquet table and return the table."""
    path = new_scratch_path(spark, "stream-table")
    query = lines_to_table(lines, path, new_scratch_path(spark, "stream-state"), None)
    await_stream(query, TIMEOUT)
    return spark.read.schema("value string").parquet(path)


def _stream_lines(spark, folder):
    lines = stream_lines(spark, written_lines(spark, folder, "stream-input"))
    tags = pick_fields(parse_fields(_to_table(lines, spark)), {41: "tag"})
    return count_by_tag(tags, "tag")


def _stream_follow(spark, folder):
    """Records of 42 fields that arrive in two parts; the second run goes on from the checkpoint of the first."""
    early = in_part(0, 3)
    source = new_scratch_path(spark, "follow-input")
    path, state = new_scratch_path(spark, "follow-table"), new_scratch_path(spark, "follow-state")
    for part in (early, ~early):
        interaction_text(spark, folder, part).write.mode("append").text(source)
        await_stream(lines_to_table(follow_lines(spark, source), path, state, None), TIMEOUT)
    records = parse_interactions(spark.read.schema("value string").parquet(path))
    return records.groupBy("attack").agg(
        F.count(F.lit(1)).alias("n"), F.sum("src_bytes").alias("total_bytes")
    )


def _label(fields: int = len(FIELD_NAMES)):
    """The label of a line, its last field if it has as many fields as a record: then no other field is cut out.

    Any other line is split: the label is the field at that place, or null where there is none.
    """
    last = F.substring_index("value", ",", -1)
    ends = F.octet_length(F.substring_index("value", ",", fields - 1)) + 1 + F.octet_length(last)
    return F.when(ends == F.octet_length("value"), last).otherwise(F.get(F.split("value", ","), F.lit(fields - 1)))


def _measured(lines):
    """(chars, duration, normal) of every line, made once, before the measures of a batch use them several times."""
    labelled = lines.select("value", _label().alias("label"))
    # The first field of a line without a label may be any other field.
    duration = F.when(F.col("label").isNotNull(), F.substring_index("value", ",", 1).cast("long"))
    return labelled.select(
        F.length("value").alias("chars"), duration.alias("duration"), (F.col("label") == "normal.").alias("normal")
    )


def _batch_measures():
    """What can be added up over batches of measured lines: characters, and the durations by label class."""
    normal = F.col("normal")
    return (
        F.sum("chars").alias("chars"),
        F.sum(F.when(normal, F.col("duration"))).alias("normal_duration"),
        F.sum(F.when(~normal, F.col("duration"))).alias("attack_duration"),
    )


_BATCHES = "n long, chars long, normal_duration long, attack_duration long, batch_id long"


def _sums():
    return [F.sum(c).alias(c) for c in ("chars", "normal_duration", "attack_duration")]


def _stream_micro_batch(spark, folder):
    """A batch for each file. Files are plain text, which several tasks can read, and few, as each costs a batch."""
    source = new_scratch_path(spark, "batch-input")
    raw_lines(spark, folder, stored=BATCH_STORED_BYTES).write.text(source)
    lines = _measured(stream_lines(spark, source, files_per_batch=1))
    path = new_scratch_path(spark, "batch-counts")
    query = batch_counts(
        lines, path, new_scratch_path(spark, "batch-state"), None, *_batch_measures()
    )
    await_stream(query, TIMEOUT)
    counts = spark.read.schema(_BATCHES).parquet(path)
    numbered = F.max("batch_id") + 1 == F.count_distinct("batch_id")
    return counts.agg(
        F.sum("n").alias("lines"),
        *_sums(),
        (numbered & (F.min("batch_id") == 0)).alias("without_gaps"),
        (F.count(F.lit(1)) == F.count_distinct("batch_id")).alias("one_row_each"),
    )


def _stream_lifecycle(spark, folder):
    """Start with a timed trigger, let the lines arrive in two intervals, stop."""
    path = new_scratch_path(spark, "timed-input")
    early = in_part(0, 2)
    raw_lines(spark, folder, early).write.option("compression", "gzip").text(path)
    counts = new_scratch_path(spark, "timed-counts")
    query = batch_counts(
        _measured(stream_lines(spark, path)),
        counts,
        new_scratch_path(spark, "timed-state"),
        "1 second",
        *_batch_measures(),
    )
    try:
        query.processAllAvailable()
        raw_lines(spark, folder, ~early).write.mode("append").option("compression", "gzip").text(path)
        query.processAllAvailable()
        was_active = query.isActive
    finally:
        query.stop()
    rows = spark.read.schema(_BATCHES).parquet(counts)
    return rows.agg(
        F.sum("n").alias("lines"),
        *_sums(),
        (F.count_if(F.col("n") > 0) >= 2).alias("several_batches"),
        F.lit(was_active and not query.isActive).alias("stopped"),
    )


def _stream_skip_blank(spark, folder):
    path = new_scratch_path(spark, "blank-input")
    tag = F.split("value", ",")[41]
    lines = raw_lines(spark, folder).select(
        F.when(tag == "smurf.", F.lit("   ")).otherwise(F.col("value")).alias("value")
    )
    lines.write.option("compression", "gzip").text(path)
    return _to_table(skip_blank(stream_lines(spark, path)), spark)


def _run_queries(spark, folder, template):
    """One query text per distinct label, as a stream over the interaction view."""
    rows = register_view(interactions(spark, folder), VIEW)
    texts = rows.select("attack").distinct().select(
        F.format_string(template, "attack").alias("value"), "attack"
    )
    path = new_scratch_path(spark, "query-input")
    # A single ordered file fixes the number of each query; there is one line per label.
    texts.repartition(1).sortWithinPartitions("attack").select("value").write.text(path)
    sink = new_scratch_path(spark, "query-output")
    state = new_scratch_path(spark, "query-state")
    await_stream(start_query_stream(stream_lines(spark, path), sink, state, None), TIMEOUT)
    return sink


_GOOD = (
    f"SELECT attack, count(*) AS n, round(avg(duration), 3) AS mean FROM {VIEW} "
    "WHERE attack = '%s' GROUP BY attack"
)
_BAD = f"SELECT no_such_field FROM {VIEW} WHERE attack = '%s'"


def _stream_sql(spark, folder):
    return query_results(spark, _run_queries(spark, folder, _GOOD))


def _stream_errors(spark, folder):
    errors = query_errors(spark, _run_queries(spark, folder, _BAD))
    return errors.select("batch_id", "query_no", "query", "error")


QUERIES = {
    "stream_lines": _stream_lines,
    "stream_follow": _stream_follow,
    "stream_micro_batch": _stream_micro_batch,
    "stream_lifecycle": _stream_lifecycle,
    "stream_sql": _stream_sql,
    "stream_skip_blank": _stream_skip_blank,
    "stream_errors": _stream_errors,
}

_SQL_SUMS = (
    f"count(*) AS lines, CAST(sum(length({RAW_LINE})) AS BIGINT) AS chars, "
    "CAST(sum(duration) FILTER (WHERE attack = 'normal.') AS BIGINT) AS normal_duration, "
    "CAST(sum(duration) FILTER (WHERE attack <> 'normal.') AS BIGINT) AS attack_duration"
)

ORACLES = {
    "stream_lines": over_interactions(
        "SELECT attack AS tag, count(*) AS n FROM interactions GROUP BY 1"
    ),
    "stream_follow": over_interactions(
        "SELECT attack, count(*) AS n, CAST(sum(src_bytes) AS BIGINT) AS total_bytes "
        "FROM interactions GROUP BY attack"
    ),
    "stream_micro_batch": over_interactions(
        f"SELECT {_SQL_SUMS}, true AS without_gaps, true AS one_row_each FROM interactions"
    ),
    "stream_lifecycle": over_interactions(
        f"SELECT {_SQL_SUMS}, true AS several_batches, true AS stopped FROM interactions"
    ),
    "stream_skip_blank": over_interactions(
        f"SELECT {RAW_LINE} AS value FROM interactions WHERE attack <> 'smurf.'"
    ),
    "stream_sql": over_interactions(
        "SELECT 0::BIGINT AS batch_id, (row_number() OVER (ORDER BY attack) - 1)::INTEGER "
        "AS query_no, to_json({'attack': attack, 'n': n, 'mean': mean})::VARCHAR AS row_json "
        "FROM (SELECT attack, count(*) AS n, round(avg(duration), 3) AS mean "
        "FROM interactions GROUP BY attack)"
    ),
    "stream_errors": over_interactions(
        "SELECT 0::BIGINT AS batch_id, (row_number() OVER (ORDER BY attack) - 1)::INTEGER "
        f"AS query_no, 'SELECT no_such_field FROM {VIEW} WHERE attack = ''' || attack || '''' "
        "AS query, 'AnalysisException' AS error FROM (SELECT DISTINCT attack FROM interactions)"
    ),
}
