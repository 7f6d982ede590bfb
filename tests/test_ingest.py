from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from connlens import fields
from connlens.sources import (
    clear_scratch,
    kept_evenly,
    new_scratch_path,
    parse_fields,
    parse_interactions,
    pick_fields,
    range_source,
    read_lines,
    render_lines,
    schema_report,
    shared_folder,
    split_rejects,
    spread_by_rows,
    spread_if_few,
)

GOOD = ",".join(
    ["3", "tcp", "http", "SF"] + ["1"] * 20 + ["0.5"] * 7 + ["9"] * 2 + ["0.25"] * 8 + ["normal."]
)
SMALL = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("share", T.DoubleType()),
    ]
)


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_field_layout():
    assert len(fields.FIELD_NAMES) == fields.FIELD_COUNT == 42
    assert len(set(fields.FIELD_NAMES)) == 42 and len(fields.LABELS) == 23
    sizes = {name: len(group) for name, group in fields.FEATURE_GROUPS.items()}
    assert sizes == {
        "numeric": 38,
        "uncorrelated": 33,
        "categorical_like": 35,
        "chi_selected": 36,
        "all_indexed": 41,
    }
    kinds = [f.dataType.simpleString() for f in fields.INTERACTION_SCHEMA]
    assert (kinds.count("string"), kinds.count("bigint"), kinds.count("double")) == (4, 23, 15)


def test_good_line(spark):
    row = parse_interactions(lines(spark, [GOOD])).first()
    assert (row.duration, row.service, row.dst_host_srv_rerror_rate, row.attack) == (
        3, "http", 0.25, "normal.",
    )


def test_bad_lines_are_kept_apart(spark):
    parts = GOOD.split(",")
    bad = {
        "too few fields": ",".join(parts[:41]),
        "too many fields": GOOD + ",x",
        "empty line": "",
        "bad number: src_bytes": ",".join(parts[:4] + ["ten"] + parts[5:]),
        "bad number: serror_rate": ",".join(parts[:24] + ["1d"] + parts[25:]),
    }
    good, rejected = split_rejects(lines(spark, [GOOD, GOOD, *bad.values()]))
    assert good.count() == 2
    assert {r.reason: r.value for r in rejected.collect()} == bad


def test_short_line_gives_nulls_not_errors(spark):
    picked = pick_fields(parse_fields(lines(spark, ["1,a"])), {0: ("n", "int"), 7: "x"})
    assert picked.first() == (1, None)


def test_gzip_lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines(spark, ["a", "b", "b"]).write.option("compression", "gzip").text(path)
    assert sorted(r.value for r in read_lines(spark, path, partitions=3).collect()) == [
        "a", "b", "b",
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.integers(-(2**63), 2**63 - 1),
            st.text(alphabet="abc. -_|", min_size=0, max_size=6),
            st.floats(allow_nan=False, allow_infinity=False),
        ),
        min_size=1,
        max_size=20,
    )
)
def test_parse_of_render_is_identity(spark, rows):
    table = spark.createDataFrame(rows, SMALL)
    for sep in (",", "|", "::"):
        if any(sep in r[1] or sep == "::" for r in rows) and sep != ",":
            continue
        again = parse_interactions(render_lines(table, SMALL.names, sep), SMALL, sep)
        assert sorted(map(tuple, again.collect())) == sorted(rows)


def test_other_separators(spark):
    for sep in ("|", "::", "."):
        parsed = parse_fields(lines(spark, [sep.join(["a", "", "b"])]), sep)
        assert parsed.first().fields == ["a", "", "b"]


def test_rejected_and_good_make_the_input(spark):
    table = lines(spark, [GOOD if i % 3 else GOOD[i:] for i in range(60)])
    good, rejected = split_rejects(table)
    assert good.count() + rejected.count() == 60


def test_unused_fields_are_not_decoded(spark):
    plan = parse_interactions(lines(spark, [GOOD])).select("service")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("try_cast") + text.count("TRY_CAST") == 0


def test_range_and_schema(spark):
    assert range_source(spark, 50).agg(F.sum("id")).first()[0] == 1225
    table = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in schema_report(table).collect()] == [
        (0, "a", "int", 2), (1, "b", "string", 1),
    ]


def test_shared_folder_is_the_configured_one(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert folder in spark.sparkContext.getCheckpointDir()


def test_only_tables_of_few_files_are_spread(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for files in (1, 2 * cores):
        spark.range(0, 100, 1, files).write.parquet(f"{tmp_path}/{files}")
    few, many = (spark.read.parquet(f"{tmp_path}/{files}") for files in (1, 2 * cores))
    assert spread_if_few(few).rdd.getNumPartitions() == cores
    assert spread_if_few(many) is many


def test_own_scratch_tables_are_removed(spark):
    import os

    paths = [new_scratch_path(spark, "kept-for-a-while") for _ in range(2)]
    spark.range(5).write.parquet(paths[0])
    assert os.path.isdir(paths[0])
    assert clear_scratch(spark) >= 1
    assert not os.path.exists(paths[0]) and clear_scratch(spark) == 0


def test_a_rejected_line_is_split_once(spark):
    """A filter on the reason doesn't split the line again for each field."""
    lines = spark.range(3).selectExpr("concat('a,b,', id) AS value")
    for side in split_rejects(lines):
        assert side._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_a_spread_table_has_more_partitions_with_more_stored_bytes(spark, tmp_path):
    path = str(tmp_path / "few")
    spark.range(0, 100_000, 1, 1).selectExpr("uuid() AS value").write.parquet(path)
    rows = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert spread_if_few(rows).rdd.getNumPartitions() == cores
    spread_rows = spread_if_few(rows, stored=100_000)
    assert spread_rows.rdd.getNumPartitions() > 2 * cores and spread_rows.count() == 100_000


def test_rows_bound_the_partitions_of_a_well_compressed_table(spark, tmp_path):
    """One value in many rows takes few bytes; the rows are dealt out all the same, whatever the number of files."""
    cores = spark.sparkContext.defaultParallelism
    for files in (1, 2 * cores):
        path = f"{tmp_path}/{files}"
        spark.range(0, 200_000, 1, files).selectExpr("1 AS n").write.parquet(path)
        rows = spread_by_rows(spark.read.parquet(path), 5_000)
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 200_000 and len(sizes) == 40 and max(sizes) < 5_100
    assert spread_by_rows(spark.range(0)).rdd.getNumPartitions() == cores


def test_a_kept_table_is_dealt_out_only_if_a_partition_is_large(spark):
    rows = spark.range(0, 100_000, 1, 2)
    with kept_evenly(rows, 50_000) as table:
        assert table.rdd.getNumPartitions() == 2 and table.count() == 100_000
    with kept_evenly(rows, 4_000) as table:
        sizes = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 100_000 and max(sizes) < 4_100
        assert table.storageLevel.useMemory and not rows.storageLevel.useMemory
    assert not table.storageLevel.useMemory
    with kept_evenly(rows.limit(0)) as table:
        assert table.count() == 0
