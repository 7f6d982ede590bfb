from collections import Counter

import pytest
from pyspark.sql import functions as F

from connlens.operators import aggregates as A
from connlens.operators import projections as P
from connlens.operators import sampling as S
from connlens.operators import setops as B
from connlens.sources import preview


def bag(spark, text):
    return spark.createDataFrame([(c,) for c in text], "v string")


def content(df):
    return "".join(sorted(r[0] for r in df.collect()))


def test_bags(spark):
    a, b = bag(spark, "aabbc"), bag(spark, "b")
    assert content(B.except_distinct(a, b)) == "ac"
    assert content(B.except_all(a, b)) == "aabc"
    assert content(B.intersect_distinct(a, b)) == "b"
    assert content(B.intersect_all(a, bag(spark, "abbb"))) == "abb"
    assert content(B.union_all(a, b)) == "aabbbc"


def test_bags_agree_with_spark_on_hot_rows_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(B, "COPIES_PER_CHUNK", 7)
    a = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 1 WHEN id % 7 = 0 THEN NULL ELSE id END AS v")
    b = spark.range(200).selectExpr("CASE WHEN id % 2 = 0 THEN 1 WHEN id % 5 = 0 THEN NULL ELSE id END AS v")
    for ours, theirs in (
        (B.except_all(a, b), a.exceptAll(b)),
        (B.intersect_all(a, b), a.intersectAll(b)),
        (B.except_distinct(a, b), a.subtract(b)),
        (B.intersect_distinct(a, b), a.intersect(b)),
    ):
        assert sorted(map(repr, ours.collect())) == sorted(map(repr, theirs.collect()))


def test_difference_with_a_part_of_itself(spark):
    a = spark.range(90).selectExpr("id % 7 AS v")
    b = a.filter("v < 3")
    assert B.except_all(a, b).count() + b.count() == a.count()


def test_pairs_need_no_cross_join(spark):
    table = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 2), (None, 3)], "x string, y int"
    )
    pairs = B.cross_values(table, "x", "y")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert len({tuple(r) for r in pairs.collect()}) == pairs.count() == 9
    assert B.cross_count(table, "x", "y").first()[0] == 9
    seen = {tuple(r)[:3] for r in B.cross_observed(table, "x", "y").collect()}
    assert ("a", 2, 1) in seen and ("a", 3, 0) in seen and (None, 3, 1) in seen


def test_observed_pairs_are_labelled_where_they_are_made(spark, monkeypatch):
    rows = [(f"k{i % 9}" if i % 10 else None, i % 13 if i % 11 else None) for i in range(900)]
    table = spark.createDataFrame(rows, "x string, y int")
    pairs = B.cross_observed(table, "x", "y", "times")
    found = pairs.collect()
    wanted = Counter(rows)
    assert {(r.x, r.y): (r.times, r.observed) for r in found} == {
        (x, y): (wanted[x, y], (x, y) in wanted)
        for x in {r[0] for r in rows}
        for y in {r[1] for r in rows}
    }
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Generate explode(array_except")]
    monkeypatch.setattr(B, "VALUES_PER_BLOCK", 3)
    assert sorted(map(repr, B.cross_observed(table, "x", "y", "times").collect())) == sorted(map(repr, found))
    assert B.cross_observed(table.limit(0), "x", "y").collect() == []


def test_totals_agree(spark):
    table = spark.range(100).selectExpr(
        "CASE WHEN id % 4 = 0 THEN 'normal.' ELSE concat('k', id % 5) END AS attack", "id AS m"
    )
    totals = A.class_totals(table).first()
    assert totals.normal + totals.attack == totals.total == 100
    sums = {r["class"]: r.total for r in A.reduce_sum(table, "m").collect()}
    by_tag = {r.attack: r.total for r in A.sum_by_tag(table, "m").collect()}
    assert sums["normal"] == by_tag.pop("normal.") and sums["attack"] == sum(by_tag.values())
    assert A.fold_sum(table.limit(0), "m").first()[0] == 0


def test_hash_sample_does_not_depend_on_partitions(spark):
    table = spark.range(5000)
    first = S.sample_fraction_hash(table, "id", 0.1, 3)
    again = S.sample_fraction_hash(table.repartition(7), "id", 0.1, 3)
    assert sorted(first.collect()) == sorted(again.collect())
    assert 400 < first.count() < 600
    assert S.sample_fraction_hash(table, "id", 1.0, 3).count() == 5000
    assert S.sample_fraction_hash(table, "id", 0.0, 3).count() == 0


@pytest.mark.parametrize("digits", [2, 4])
def test_exact_sample(spark, monkeypatch, digits):
    monkeypatch.setattr(S, "_PREFIX", digits)
    table = spark.range(3000)
    hashed = table.withColumn("h", S.key_hash("id", 5)).orderBy("h")
    for n in (0, 1, 250, 2999, 3000, 4000):
        wanted = {r.id for r in hashed.limit(n).collect()}
        sample = S.sample_exact(table.repartition(5), "id", n, 5)
        assert sample.count() == min(n, 3000) and {r.id for r in sample.collect()} == wanted


def test_exact_sample_with_missing_keys(spark):
    table = spark.range(10).selectExpr("id", "CASE WHEN id % 2 = 0 THEN id END AS k")
    for n in (1, 5, 7, 9, 10, 11):
        assert S.sample_exact(table, "k", n, 1).distinct().count() == min(n, 10)


def test_exact_sample_of_rows_that_share_keys_or_are_equal(spark):
    table = spark.range(2000).selectExpr("1 AS k", "id % 3 AS v")
    for n in (1, 667, 1500, 1999):
        assert S.sample_exact(table.repartition(6), "k", n, 1).count() == n
    many = spark.range(1_200_000).selectExpr("1 AS k", "id AS v")
    assert S.sample_exact(many, "k", 600_001, 1).count() == 600_001


def test_null_measures_and_labels(spark):
    table = spark.createDataFrame([("normal.", 10), ("normal.", None), (None, 4)], "attack string, m int")
    means = {r["class"]: r["mean"] for r in A.mean_from_totals(table, "m").collect()}
    assert means == {"normal": 10.0, "attack": 4.0}
    assert A.aggregate_sum_count(table, "m").first() == (14, 2)
    assert {r.attack: (r.total, r.n) for r in A.sum_count_by_tag(table, "m").collect()} == {"normal.": (10, 1), None: (4, 1)}
    kept = P.filter_tag(table, "normal.").count(), P.filter_tag(table, "normal.", keep=False).count()
    assert kept == (2, 1)


def test_order_of_rows(spark):
    table = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 9.0), ("c", 1.0), ("d", 2.0)], "attack string, m double")
    assert [r.attack for r in A.sort_desc(table, "m", "attack").collect()] == ["c", "a", "b", "d", "c"]
    assert [r.attack for r in A.top_k(table, 3, "m", "attack").collect()] == ["c", "a", "b"]
    assert [(r.attack, r["mean"]) for r in A.mean_by_tag(table, "m").collect()] == [("c", 5.0), ("a", 2.0), ("b", 2.0), ("d", 2.0)]
    counts = A.group_count(table, "attack").collect()
    assert [(r.attack, r.n) for r in counts] == [("a", 1), ("b", 1), ("d", 1), ("c", 2)]
    assert [r.attack for r in preview(table, 2, "attack", "m").collect()] == ["a", "b"]
