from pathlib import Path

import pytest

from connlens import streaming as R
from connlens.plans import roles, streams
from connlens.sources import new_scratch_path, register_view


@pytest.fixture
def folders(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    return source, str(tmp_path / "out"), str(tmp_path / "state")


def run(spark, folders):
    source, sink, state = folders
    query = R.start_query_stream(R.stream_lines(spark, str(source)), sink, state, None)
    assert R.await_stream(query, 120)


def test_good_blank_and_bad_queries(spark, folders, tmp_path):
    register_view(spark.range(10).selectExpr("id", "id % 2 AS odd"), "numbers")
    secret = str(tmp_path / "secret")
    spark.range(1).write.parquet(secret)
    texts = [
        "SELECT odd, count(*) AS n FROM numbers GROUP BY odd ORDER BY odd",
        "   ",
        "SELECT nothing FROM numbers",
        "DROP VIEW numbers",
        "WITH t AS (SELECT 1 AS a) INSERT INTO numbers SELECT a, a FROM t",
        f"SELECT * FROM parquet.`{secret}`",
        "SELECT java_method('java.lang.System', 'exit', 1)",
        "SELECT 1 / 0 AS x FROM numbers",
        "SELECT max(id) AS top, NULL AS gap FROM numbers;",
    ]
    (folders[0] / "q1.txt").write_text("\n".join(texts) + "\n")
    run(spark, folders)
    rows = sorted((r.query_no, r.row_json) for r in R.query_results(spark, folders[1]).collect())
    assert rows == [
        (0, '{"odd":0,"n":5}'), (0, '{"odd":1,"n":5}'), (7, '{"top":9,"gap":null}'),
    ]
    errors = R.query_errors(spark, folders[1]).orderBy("query_no").collect()
    assert [e.query_no for e in errors] == [1, 2, 3, 4, 5, 6]
    assert spark.table("numbers").count() == 10

    (folders[0] / "q2.txt").write_text("SELECT 7 AS x\n")  # a restart runs only what is new
    run(spark, folders)
    later = R.query_results(spark, folders[1])
    assert later.count() == 4 and later.filter("batch_id = 1").first().row_json == '{"x":7}'


def test_lines_reach_the_table_once(spark, folders):
    source, sink, state = folders
    for number in range(3):
        (source / f"{number}.txt").write_text("a\n\nb\n")
        stream = R.skip_blank(R.stream_lines(spark, str(source)))
        assert R.await_stream(R.lines_to_table(stream, sink, state, None), 120)
    assert spark.read.parquet(sink).count() == 6


def test_batches_follow_files(spark, folders):
    source, sink, state = folders
    for number in range(3):
        (source / f"{number}.txt").write_text("x\n" * (number + 1))
    stream = R.stream_lines(spark, str(source), files_per_batch=1)
    assert R.await_stream(R.batch_counts(stream, sink, state, None), 120)
    counts = spark.read.parquet(sink)
    assert counts.count() == 3 and sum(r.n for r in counts.collect()) == 6


def test_one_endless_query_among_ten(spark, folders):
    register_view(spark.range(10).selectExpr("id", "id % 2 AS odd"), "numbers")
    endless = "SELECT count(*) AS n FROM range(1000000000000000) WHERE hash(id) % 7 = id % 7 AND sha2(CAST(id AS STRING), 256) > ''"
    texts = [f"SELECT {i} + count(*) AS n FROM numbers" for i in range(10)]
    texts[3] = endless
    (folders[0] / "q.txt").write_text("\n".join(texts) + "\n")
    query = R.start_query_stream(
        R.stream_lines(spark, str(folders[0])), folders[1], folders[2], None, at_once=4, time_limit=20
    )
    assert R.await_stream(query, 240)
    rows = {r.query_no: r.row_json for r in R.query_results(spark, folders[1]).collect()}
    assert rows == {i: f'{{"n":{i + 10}}}' for i in range(10) if i != 3}
    error = R.query_errors(spark, folders[1]).collect()
    assert [(e.query_no, e.error, e.query) for e in error] == [(3, "QueryTimeout", endless)]


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_lines_appended_to_a_file_arrive_once(spark, folders, piece):
    source, sink, state = folders
    grown = source / "log.txt"
    steps = [
        ("one\ntwo\nthr", ["one", "two"]),
        ("ee\n", ["three"]),
        ("", []),
        ("\nfünf\r\n" + "six " * 20 + "\nunfinished", ["", "fünf", "six " * 20]),
        ("\n", ["unfinished"]),
    ]
    wanted = []
    for number, (text, lines) in enumerate(steps):
        with grown.open("ab") as file:
            file.write(text.encode())
        if number == 2:
            (source / "other.txt").write_text("another\n")
            lines = ["another"]
        (source / "_hidden").write_text("no\n")
        # Every step is a restart from the checkpoint.
        stream = R.follow_lines(spark, str(source), piece)
        assert R.await_stream(R.lines_to_table(stream, sink, state, None), 120)
        wanted += lines
        assert sorted(r.value for r in spark.read.schema("value string").parquet(sink).collect()) == sorted(wanted)


def test_a_running_stream_follows_a_file(spark, folders):
    source, sink, state = folders
    (source / "log.txt").write_text("a\nb\n")
    query = R.lines_to_table(R.follow_lines(spark, str(source)), sink, state, "1 second")
    try:
        query.processAllAvailable()
        with (source / "log.txt").open("a") as file:
            file.write("c\nd")
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.value for r in spark.read.schema("value string").parquet(sink).collect()) == ["a", "b", "c"]


def test_files_of_the_registered_streams(spark, data, monkeypatch):
    """Batches of one file read plain text, which several tasks can share; other lines are compressed, and so are tables of lines."""
    paths = {}

    def path_of(session, name):
        paths[name] = new_scratch_path(session, name)
        return paths[name]

    monkeypatch.setattr(streams, "new_scratch_path", path_of)
    streams.QUERIES["stream_micro_batch"](spark, data).collect()
    streams.QUERIES["stream_skip_blank"](spark, data).count()
    ends = {name: {f.name.split(".", 1)[1] for f in Path(path).glob("part-*")} for name, path in paths.items()}
    assert ends["batch-input"] == {"txt"} and ends["blank-input"] == {"txt.gz"}
    assert ends["stream-table"] == {"zstd.parquet"}


def test_parts_of_the_records_are_told_before_their_lines_are_made(spark, data):
    part = roles.in_part(0, 2)
    halves = [roles.raw_lines(spark, data, where) for where in (part, ~part)]
    whole = roles.raw_lines(spark, data)
    assert all(0 < h.count() < whole.count() for h in halves)
    assert halves[0].union(halves[1]).exceptAll(whole).isEmpty() and whole.exceptAll(halves[0].union(halves[1])).isEmpty()
    for half in halves:
        plan = half._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("decimal(9,4)") == whole._jdf.queryExecution().optimizedPlan().toString().count("decimal(9,4)")


def test_measures_of_a_line_are_made_once(spark, data, monkeypatch):
    """What reaches the count of a batch holds no lines, so that no measure splits them again; odd lines count as if they were split."""
    seen, plain = [], streams.batch_counts

    def counts(stream, *rest):
        seen.append(stream.columns)
        return plain(stream, *rest)

    monkeypatch.setattr(streams, "batch_counts", counts)
    for name in ("stream_micro_batch", "stream_lifecycle"):
        streams.QUERIES[name](spark, data).collect()
    assert len(seen) == 2 and all("value" not in columns for columns in seen)

    middle = ",".join("x" * 40)
    texts = ["", ",", "normal.", f"3,{middle},normal.", f"4,{middle},smurf.", f"5,{middle},", f"6,{middle},normal.,more", f"7,{middle},é,normal.",
             "tcp," + ",".join("x" * 39) + ",normal.", f"8,{middle},normal.,", "," * 39]

    def split(text):
        fields = text.split(",")
        normal = fields[41] == "normal." if len(fields) > 41 else None
        return len(text), None if normal is None else int(fields[0]), normal

    measured = streams._measured(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert sorted(measured.collect(), key=str) == sorted(map(split, texts), key=str)
