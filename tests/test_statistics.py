import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from connlens.operators import chisquare as X
from connlens.operators import correlation as C
from connlens.operators import moments as M

COLUMNS = ["a", "b", "c", "flat"]


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 9, 2500).astype(float)
    a[:1200] = 4.0  # one value fills half of the column
    return pd.DataFrame({"a": a, "b": a * 2 + rng.normal(size=2500), "c": rng.normal(size=2500),
                         "flat": 7.0})


def as_frame(matrix):
    wide = matrix.toPandas().pivot(index="feature_a", columns="feature_b", values="rho")
    return wide.loc[COLUMNS, COLUMNS].to_numpy(dtype=float)


@pytest.mark.parametrize("limit", ["10MB", "-1"])
@pytest.mark.parametrize("cells", [10**6, 100, 1])
def test_spearman(spark, numbers, limit, cells):
    """The ranks as a small file and by exchange; large blocks, small ones, one row each."""
    table = numbers if cells > 1 else numbers.iloc[1100:1300]
    wanted = table.corr("spearman").loc[COLUMNS, COLUMNS].to_numpy()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = as_frame(C.spearman_matrix(spark.createDataFrame(table), COLUMNS, cells=cells))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    np.testing.assert_allclose(got, wanted, atol=1e-9)


def test_spearman_plan_does_not_grow_with_the_columns(spark, numbers):
    """The same joins and exchanges for two columns and for four."""
    plans = []
    for names in (COLUMNS[:2], COLUMNS):
        matrix = C.spearman_matrix(spark.createDataFrame(numbers), names)
        plan = matrix._jdf.queryExecution().executedPlan().toString()
        plans.append([plan.count(word) for word in ("Exchange", "Join", "FlatMapCoGroupsInArrow")])
    assert plans[0] == plans[1] and plans[0][2] > 0


def test_spearman_of_repeated_rows_and_gaps(spark):
    rows = [(1.0, 2.0)] * 500 + [(float(i), float(-i)) for i in range(60)] + [(None, 1.0), (1.0, float("nan")), (-0.0, 0.0)]
    table = spark.createDataFrame(rows, "a double, b double").repartition(3)
    cells = {(r.feature_a, r.feature_b): r.rho for r in C.spearman_matrix(table, ["a", "b"], cells=50).collect()}
    wanted = pd.DataFrame(rows, columns=["a", "b"]).dropna().corr("spearman").loc["a", "b"]
    assert cells["a", "b"] == pytest.approx(wanted)


def test_pearson_leaves_incomplete_rows_out(spark, numbers):
    table = spark.createDataFrame(numbers).withColumn(
        "b", F.when(F.rand(1) < 0.1, None).otherwise(F.col("b"))
    ).cache()
    wanted = table.dropna().toPandas().corr()
    got = as_frame(C.pearson_matrix(table, COLUMNS))
    np.testing.assert_allclose(got, wanted.loc[COLUMNS, COLUMNS].to_numpy(), atol=1e-9)
    ranks = as_frame(C.spearman_matrix(table, COLUMNS))
    wanted = table.dropna().toPandas().corr("spearman")
    np.testing.assert_allclose(ranks, wanted.loc[COLUMNS, COLUMNS].to_numpy(), atol=1e-9)


def test_perfect_pairs_count_as_high(spark):
    table = spark.range(50).selectExpr("id AS a", "id * 2 AS b", "-id AS c", "pow(id % 7, 2) AS d")
    pairs = C.high_correlation(C.pearson_matrix(table, ["a", "b", "c", "d"]))
    assert {(r.feature_a, r.feature_b) for r in pairs.collect()} == {
        ("a", "b"), ("a", "c"), ("b", "c"),
    }
    kept = C.drop_correlated(pairs, ["d", "c", "b", "a"])
    assert {r.feature: r.keeper for r in kept.collect()} == {"d": "d", "c": "c", "b": "c", "a": "c"}


def test_moments_by_hand(spark):
    rows = [("x", 1.0, 0.0), ("x", 3.0, 0.0), ("y", 5.0, 2.0)]
    table = spark.createDataFrame(rows, "attack string, u double, v double")
    stats = {(r.attack, r.feature): r for r in M.column_stats_by_tag(table, ["u", "v"]).collect()}
    u = stats["x", "u"]
    assert (u["mean"], u["variance"], u["min"], u["max"], u["count"], u["nonzeros"]) == (
        2.0, 2.0, 1.0, 3.0, 2, 2,
    )
    assert stats["x", "v"]["nonzeros"] == 0 and stats["y", "u"]["variance"] is None
    one = M.column_stats_for_tag(table, ["u"], "x").first()
    assert one["mean"] == 2.0 and one["count"] == 2


def test_chi_square_agrees_with_spark(spark):
    table = spark.range(2000).selectExpr(
        "CAST(id % 2 AS double) AS label", "CAST(id % 3 AS double) AS free",
        "CAST((id % 2) + (id % 5) AS double) AS bound", "0.0D AS flat",
        "CAST(id % 400 AS double) AS many",
    )
    names = ["free", "bound", "flat", "many"]
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(table)
    wanted = ChiSquareTest.test(vectors, "features", "label", flatten=True).collect()
    got = {r.feature: r for r in X.chi_square(table, names, "label").collect()}
    for row in wanted:
        ours = got[names[row.featureIndex]]
        assert ours.dof == row.degreesOfFreedom
        assert ours.statistic == pytest.approx(row.statistic, abs=1e-6)
        assert ours.p_value == pytest.approx(row.pValue, abs=1e-9)
    kept = X.select_by_pvalue(X.chi_square(table, names, "label"))
    assert {r.feature for r in kept.collect()} == {"bound", "many"}


def test_chi_square_has_no_category_limit(spark):
    table = spark.range(12_000).selectExpr("CAST(id % 2 AS double) AS label", "id AS x")
    row = X.chi_square(table, ["x"], "label").first()
    assert row.dof == 11_999 and row.statistic == pytest.approx(12_000)
    assert row.p_value == pytest.approx(0.4957, abs=1e-3)


def test_blocks_lie_in_small_row_groups(spark):
    """A writer doesn't hold all blocks of its task until the end, nor a reader a whole file."""
    names = [f"c{i}" for i in range(10)]
    rows = spark.range(0, 400_000, 1, 1).select(*[F.rand(i).alias(c) for i, c in enumerate(names)])
    blocks = C._blocks(C._vectors(rows, names), len(names), 1_000_000)
    files = [pq.ParquetFile(f.removeprefix("file:")) for f in blocks.inputFiles()]
    assert [(f.num_row_groups >= 2, f.metadata.num_rows) for f in files] == [(True, 4)]
