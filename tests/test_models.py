import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from connlens.operators import classifiers as K
from connlens.operators import evaluation as E
from connlens.operators import features as Q
from connlens.plans import modelling, roles
from connlens.sources import tables


@pytest.fixture(scope="module")
def sides(spark):
    rows = spark.range(3000).selectExpr(
        "id", "CAST(id * 7919 % 101 AS double) AS u", "CAST(id * 104729 % 53 AS double) AS v",
        "CASE WHEN id % 3 = 0 THEN 'red' WHEN id % 3 = 1 THEN 'blue' ELSE 'green' END AS colour",
    ).withColumn(
        "label", ((F.col("u") > 60) | ((F.col("colour") == "red") & (F.col("v") > 25))).cast("double")
    )
    train, test = Q.hash_split(rows, "id", 0.3, 11)
    return train.cache(), test.cache()


def score(model, side):
    return E.accuracy(K.predict(model, side)).first()[0]


@pytest.mark.parametrize(
    "fit, least",
    [(K.decision_tree, 0.98), (K.random_forest, 0.95), (K.gradient_boosting, 0.98),
     (K.linear_svm, 0.8)],
)
def test_models_beat_the_majority(sides, fit, least):
    train, test = sides
    model = fit(train, ["u", "v"], ["colour"])
    majority = E.accuracy(E.majority_class(train, test)).first()[0]
    assert score(model, test) > max(least, majority + 0.1)


def test_logistic(sides):
    train, test = sides
    model = K.logistic_regression(train, ["u", "v"], ["colour"], intercept=True)
    assert score(model, test) > 0.8
    plain = K.logistic_regression(train, ["u", "v"])
    weights = {r.feature: r.weight for r in K.coefficients(plain, ["u", "v"], train).collect()}
    assert weights["(intercept)"] == 0.0 and weights["u"] > 0


def test_split_is_complete_and_disjoint(sides):
    train, test = sides
    assert train.count() + test.count() == 3000
    assert train.join(test, "id").count() == 0


def test_unseen_category(spark, sides):
    train, test = sides
    model = K.decision_tree(train.filter("colour <> 'green'"), ["u", "v"], ["colour"])
    assert K.predict(model, test).count() == test.count()
    encoded = Q.encode_categories(test, ["colour"], fit_on=train.filter("colour <> 'green'"))
    numbers = {r.colour: r.colour_index for r in encoded.collect()}
    assert numbers == {"blue": 0.0, "red": 1.0, "green": 2.0}


def test_same_seed_same_forest(sides):
    train, test = sides
    rules = [
        K.random_forest(train, ["u", "v"], ["colour"], trees=3).stages[-1].toDebugString.split("\n")[1:]
        for _ in range(2)
    ]
    assert rules[0] == rules[1]


MODELS = {
    "tree": K.decision_tree,
    "deep tree": lambda *a: K.decision_tree(*a, depth=8),
    "forest": K.random_forest,
    "boosting": K.gradient_boosting,
    "svm": K.linear_svm,
    "logistic": K.logistic_regression,
    "logistic with intercept": lambda *a: K.logistic_regression(*a, intercept=True),
}


@pytest.mark.parametrize("name", MODELS)
@pytest.mark.parametrize("classes", [2, 4])
def test_expressions_equal_the_models(spark, sides, name, classes):
    if classes == 4 and name not in ("tree", "deep tree", "forest"):
        pytest.skip("two classes only")
    train, test = sides
    noisy = (F.col("label") + F.pmod(F.xxhash64("id"), F.lit(classes))) % classes
    train, test = (side.withColumn("label", noisy) for side in (train, test))
    model = MODELS[name](train.filter("colour <> 'green'"), ["u", "v"], ["colour"])
    odd = test.withColumn("colour", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("colour")))
    wanted = model.transform(odd).select("id", "prediction").collect()
    got = K.predict(model, odd, "id").select("id", "prediction").collect()
    assert len(wanted) == odd.count() and sorted(map(tuple, got)) == sorted(map(tuple, wanted))


def test_models_scored_together(sides):
    train, test = sides
    shared = K.tree_features(train, ["u", "v"], ["colour"])
    models = {
        "tree": K.decision_tree(train, ["u", "v"], ["colour"], stages=shared),
        "forest": K.random_forest(train, ["u", "v"], ["colour"], stages=shared),
        "svm": K.linear_svm(train, ["u", "v"], ["colour"]),
    }
    scored = K.predictions(models, test)
    for name, model in models.items():
        own = scored.filter(F.col("model") == name).select("label", "prediction").collect()
        assert sorted(map(tuple, own)) == sorted(map(tuple, K.predict(model, test).collect()))


def test_rules_recover_what_was_planted(spark):
    table = spark.range(4000).selectExpr(
        "CAST(id % 50 AS double) AS u", "CAST(id * 31 % 9 AS double) AS v", "id % 2 AS w",
        "CASE WHEN id % 50 > 30 THEN 1.0D WHEN id * 31 % 9 >= 7 THEN 2.0D ELSE 0.0D END AS label",
    )
    rules = K.tree_rules(K.decision_tree(table, ["u", "v", "w"]), table).collect()
    assert {(r.feature, r.threshold) for r in rules if r.feature} == {("u", 30.5), ("v", 6.5)}
    by_node = {r.node: r for r in rules}
    assert all(r.parent is None or by_node[r.parent].feature for r in rules)
    assert {r["class"] for r in rules if r.feature is None} == {0.0, 1.0, 2.0}


def test_more_categories_than_bins(spark):
    """200,000 categories train with the bins of a few; rare ones share the group of the unseen."""
    rows = spark.range(500_000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN concat('r', id) ELSE concat('c', id % 3000) END AS c", "id",
    ).withColumn("label", (F.col("c").startswith("c") & (F.crc32("c") % 3 == 0)).cast("double"))
    assert rows.select("c").distinct().count() > 200_000
    model = K.decision_tree(rows, ["id"], ["c"])
    assert model.stages[-1].getOrDefault("maxBins") == K.TREE_BINS
    assert score(model, rows) > 0.99
    groups = Q.category_groups(rows, "c", groups=8)
    assert groups.count() == 1500 and groups.select("group").distinct().count() <= 8


def test_groups_follow_the_label_rate(spark):
    rows = [(c, float(i < n)) for c, n in (("a", 90), ("b", 10), ("c", 50), ("d", 50)) for i in range(100)]
    rows += [("rare", 1.0)] * 3 + [(None, 1.0)] * 30
    table = spark.createDataFrame(rows, "c string, label double")
    found = {r.category: r.group for r in Q.category_groups(table, "c").collect()}
    assert found == {"b": 1, "c": 2, "d": 2, "a": 3}
    assert Q.category_groups(table.limit(0), "c").collect() == []


def test_metrics_equal_the_evaluator(spark):
    pairs = [(0, 0)] * 50 + [(0, 1)] * 7 + [(1, 1)] * 20 + [(1, 0)] * 9 + [(2, 0)] * 5 + [(3, 3)]
    scored = spark.createDataFrame([(float(a), float(b)) for a, b in pairs],
                                   "label double, prediction double")
    ours = E.classification_metrics(scored).first()
    for name, theirs in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall"), ("f1", "f1")):
        evaluator = MulticlassClassificationEvaluator(metricName=theirs)
        assert ours[name] == pytest.approx(evaluator.evaluate(scored))
    assert ours["n"] == len(pairs)


def test_text_ratios(spark):
    table = spark.createDataFrame([("a b. A!",), ("",)], "text string")
    first, empty = Q.text_ratios(table).collect()
    assert first.punctuation_ratio == pytest.approx(2 / 7)
    assert first.distinct_word_ratio == 1.0 and empty.punctuation_ratio == 0.0


def test_linear_models_keep_their_rows_once(sides, monkeypatch):
    """Training of a linear model keeps blocks of its own; points of trees are kept on disk, beside what training keeps."""
    kept, plain = [], K.kept_while

    def keep(df, level):
        kept.append((level.useMemory, level.useDisk))
        return plain(df, level)

    monkeypatch.setattr(K, "kept_while", keep)
    K.logistic_regression(sides[0], ["u", "v"])
    assert kept == []
    K.decision_tree(sides[0], ["u", "v"], ["colour"])
    assert kept == [(False, True)]


def test_rows_bound_what_a_task_of_training_reads(spark, data, sides, monkeypatch):
    """Partitions follow the number of rows, not the bytes that they are stored in, nor the number of files."""
    monkeypatch.setattr(modelling, "TASK_ROWS", 300)
    rows = modelling._labelled(spark, data)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 330 and len(sizes) >= sum(sizes) / 300

    seen, plain = [], Q.feature_stages

    def stages(df, *rest, **more):
        seen.append(max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()))
        return plain(df, *rest, **more)

    monkeypatch.setattr(K, "feature_stages", stages)
    monkeypatch.setattr(K, "kept_evenly", lambda df: tables.kept_evenly(df, 100))
    train = sides[0].coalesce(2).select("*")
    assert not train.storageLevel.useMemory
    K.logistic_regression(train, ["u", "v"])
    K.decision_tree(train, ["u", "v"], ["colour"])
    assert max(seen) <= 110


def test_sides_of_training_are_kept_on_disk_as_columns_of_the_table(spark, data, monkeypatch):
    """The same rows as the split of the records; each partition is bounded, nothing is kept in memory, nor after the block."""
    plain = [sorted(map(str, side.collect())) for side in modelling._sides(modelling._labelled(spark, data))]
    monkeypatch.setattr(modelling, "TASK_ROWS", 300)
    levels, keep = [], roles.kept

    def watched(df, level):
        levels.append((level.useMemory, level.useDisk, df.columns))
        return keep(df, level)

    monkeypatch.setattr(roles, "kept", watched)
    persistent = spark.sparkContext._jsc.getPersistentRDDs
    before = set(persistent())
    with modelling._kept_sides(spark, data) as sides:
        assert [sorted(map(str, side.collect())) for side in sides] == plain
        for side in sides:
            assert max(r["count"] for r in side.groupBy(F.spark_partition_id()).count().collect()) <= 330
        assert len(set(persistent()) - before) == 2
    assert levels == [(False, True, roles.COLUMNS)] * 2 and set(persistent()) <= before


@pytest.mark.parametrize("name", ["logistic_chi", "decision_tree", "decision_tree_multi", "linear_svm"])
def test_training_writes_no_wide_copies(spark, data, monkeypatch, name):
    """Only metrics, documents' ratios and category numbers are written; rows are not kept a second time before training."""
    widths, plain, again = [], modelling.cut_lineage, []

    def watched(df):
        widths.append(len(df.columns))
        return plain(df)

    monkeypatch.setattr(modelling, "cut_lineage", watched)
    evenly = K.kept_evenly

    def kept_again(df, *rest):
        again.append(df.columns)
        return evenly(df, *rest)

    monkeypatch.setattr(K, "kept_evenly", kept_again)
    assert modelling.QUERIES[name](spark, data).count() in (1, 2)
    assert widths and max(widths) <= 7
    assert all(len(columns) <= 4 for columns in again)


def test_tree_models_share_their_points(sides, monkeypatch):
    """Points are joined to their groups and kept once for several models, which are the same as without sharing."""
    train, _ = sides
    shared = K.tree_features(train, ["u", "v"], ["colour"])
    own = [fit(train, ["u", "v"], ["colour"], stages=shared) for fit in (K.decision_tree, K.gradient_boosting)]
    kept, plain = [], K.kept_while
    monkeypatch.setattr(K, "kept_while", lambda df, level: kept.append(level.useMemory) or plain(df, level))
    with K.tree_points(train, shared) as points:
        both = [fit(points, ["u", "v"], ["colour"], stages=shared) for fit in (K.decision_tree, K.gradient_boosting)]
    assert kept == [False]
    for one, other in zip(own, both):
        assert one.stages[-1].toDebugString.split("\n")[1:] == other.stages[-1].toDebugString.split("\n")[1:]
