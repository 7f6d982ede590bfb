"""Splits and category numbers without limits."""

import pytest
from pyspark.sql import functions as F

from connlens.operators import correlation as C
from connlens.operators import features as X
from connlens.operators import graph as G
from connlens.operators import moments as M


def test_split_keeps_rows_without_key(spark):
    table = spark.range(1000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN id END AS k")
    train, test = X.hash_split(table, "k", 0.3, 1)
    assert train.count() + test.count() == 1000 and not set(train.collect()) & set(test.collect())
    assert len({r.id in {t.id for t in test.filter("k IS NULL").collect()} for r in table.filter("k IS NULL").collect()}) == 1


def test_more_categories_than_a_driver_would_list(spark):
    rows = spark.range(150_000).select(F.format_string("c%07d", F.col("id")).alias("c"))
    rows = rows.union(spark.createDataFrame([(None,), ("zzz",)], "c string"))
    found = X.encode_categories(rows, ["c"], fit_on=rows.filter("c <> 'zzz'"))
    wrong = found.filter(F.col("c").startswith("c0") & (F.col("c_index") != F.substring("c", 2, 7).cast("double")))
    assert wrong.count() == 0 and found.count() == 150_002
    assert {r.c_index for r in found.filter("c IS NULL OR c = 'zzz'").collect()} == {150_000.0}


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_heavy_categories_are_joined_apart(spark, limit):
    rows = [("hot",)] * 900 + [("new",)] * 500 + [(None,)] * 700 + [(f"c{i}",) for i in range(300)]
    table = spark.createDataFrame(rows, "c string").repartition(6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        found = X.encode_categories(table, ["c"], fit_on=table.filter("c <> 'new'"), block=100)
        got = sorted(((r.c or "", r.c_index) for r in found.collect()))
        if limit == "-1":
            joined = found._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in joined and "BroadcastHashJoin" in joined
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    numbers = {c: float(i) for i, c in enumerate(sorted({c for (c,) in rows if c and c != "new"}))}
    assert got == sorted((c or "", numbers.get(c, 301.0)) for (c,) in rows)


@pytest.mark.parametrize("matrix", [C.pearson_matrix, C.spearman_matrix])
def test_matrices_without_complete_rows(spark, matrix):
    for rows in ([], [(None, 1.0), (float("nan"), 2.0)]):
        table = spark.createDataFrame(rows, "a double, b double")
        assert sorted(map(tuple, matrix(table, ["a", "b"]).collect())) == [
            ("a", "a", None), ("a", "b", None), ("b", "a", None), ("b", "b", None),
        ]


def test_pearson_of_constant_columns(spark):
    table = spark.range(1, 6).selectExpr("id AS a", "3 AS b", "-2 * id AS c", "id * id AS d")
    cells = {(r.feature_a, r.feature_b): r.rho for r in C.pearson_matrix(table, ["a", "b", "c", "d"]).collect()}
    assert all(cells[pair] is None for pair in cells if "b" in pair)
    assert cells["a", "c"] == pytest.approx(-1) and cells["a", "a"] == 1.0 and 0.9 < cells["a", "d"] < 1


def test_statistics_of_an_empty_table(spark):
    table = spark.createDataFrame([], "a double, b long")
    found = M.column_stats(table, ["a", "b"]).collect()
    assert {(r.feature, r["mean"], r["count"], r.nonzeros) for r in found} == {("a", None, 0, 0), ("b", None, 0, 0)}
    assert M.column_stats_by_tag(table.withColumn("t", F.lit("x")), ["a"], "t").collect() == []


def test_hot_source_is_split_and_ranks_agree(spark, monkeypatch):
    rows = [("hub", f"v{i}") for i in range(40)] + [(f"v{i}", "hub") for i in range(0, 40, 2)] + [("hub", "v1")]
    graph = G.build_graph(spark.createDataFrame(rows, "s string, d string"), "s", "d", F.lit("r"))
    whole = {r.id: r.pagerank for r in G.pagerank(graph).collect()}
    monkeypatch.setattr(G, "BLOCK_LINKS", 7)
    split = {r.id: r.pagerank for r in G.pagerank(graph).collect()}
    assert whole.keys() == split.keys() and all(abs(whole[k] - split[k]) < 1e-9 for k in whole)
