"""Features, classifiers and their quality (registered queries).

The interaction label is planted (see ``roles``). ``quality`` is the label of supplied documents,
learnt from ratios of their text; documents with the same text stay on one side of the split.

Queries of models return what SQL can state about them: the held-out rows and their classes, the score of
always guessing the most frequent label, and whether the model beats it by a margin. ``model_metrics`` has
the metrics themselves, and the seconds that training took.
"""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from connlens.fields import CATEGORIES, FEATURE_GROUPS
from connlens.functions import binary_label, in_hash_sample
from connlens.operators import classifiers as K
from connlens.operators import evaluation as E
from connlens.operators import features as Q
from connlens.plans.roles import KEY, interactions, kept_interactions, over_interactions
from connlens.sources import cut_lineage, read_table
from connlens.sources.tables import TASK_ROWS

TEST_FRACTION = 0.2
SEED = 7
RATIOS = ["punctuation_ratio", "distinct_word_ratio"]
#: What the label is planted on.
PLANTED_NUMBERS, PLANTED_CATEGORIES = ["duration", "rerror_rate"], ["protocol_type"]
MAJORITY = "majority class"
#: By how much a model must beat the majority's accuracy.
TREE_MARGIN, FOREST_MARGIN, LINEAR_MARGIN, QUALITY_MARGIN = 0.3, 0.2, 0.1, 0.02


def _labelled(spark, folder):
    rows = interactions(spark, folder, task_rows=TASK_ROWS)
    return rows.withColumn("label", binary_label("attack"))


def _numbers(categories: list[str], group: str) -> list[str]:
    return [c for c in FEATURE_GROUPS[group] if c not in categories]


INDEXED_NUMBERS = _numbers(CATEGORIES, "all_indexed")
COMPARED_MARGINS = {
    "logistic, numeric": LINEAR_MARGIN,
    "logistic, uncorrelated": LINEAR_MARGIN,
    "logistic, chi_selected": LINEAR_MARGIN,
    "decision tree": TREE_MARGIN,
    "random forest": FOREST_MARGIN,
    "gradient boosting": TREE_MARGIN,
    "linear svm": LINEAR_MARGIN,
}


def _sides(rows):
    return Q.hash_split(rows, KEY, TEST_FRACTION, SEED)


@contextmanager
def _kept_sides(spark, folder):
    """(train, test) of the labelled rows until the block ends, from copies that take little disk and that every pass may read again."""
    with kept_interactions(spark, folder, _sides, TASK_ROWS) as sides:
        yield [side.withColumn("label", binary_label("attack")) for side in sides]


def _documents(spark, folder):
    labels = read_table(spark, folder, "labels").select("doc_id", "quality")
    ratios = Q.text_ratios(read_table(spark, folder, "documents")).select(
        "doc_id", "lang", *RATIOS, F.md5("text").alias("text_hash")
    )
    rows = ratios.join(labels, "doc_id").withColumn("label", F.col("quality").cast("double"))
    return Q.hash_split(rows, "text_hash", 0.5, SEED)


def _metrics(models, train, test):
    """Metrics of the models and of always guessing the most frequent label."""
    majority = E.majority_class(train, test)
    scored = K.predictions(models, test).unionByName(
        majority.select(F.lit(MAJORITY).alias("model"), "label", "prediction")
    )
    return E.model_comparison(scored)


def _checked(models, train, test, margins):
    """(model, n, majority_accuracy, margin, beaten): is the majority's accuracy beaten by the margin?"""
    metrics = cut_lineage(_metrics(models, train, test))  # one row per model
    majority = metrics.filter(F.col("model") == MAJORITY).select("accuracy").first()
    # Without held-out rows there is no majority to beat.
    base = F.lit(majority[0] if majority else None).cast("double")
    margin = F.element_at(F.create_map(*[F.lit(v) for pair in margins.items() for v in pair]), F.col("model"))
    return metrics.filter(F.col("model") != MAJORITY).select(
        "model",
        "n",
        F.round(base, 6).alias("majority_accuracy"),
        margin.alias("margin"),
        (F.col("accuracy") >= base + margin).alias("beaten"),
    )


def _logistic(group):
    def query(spark, folder):
        columns = FEATURE_GROUPS[group]
        with _kept_sides(spark, folder) as (train, test):
            models = {
                f"logistic, {group}": K.logistic_regression(train, columns, keep=False),
                f"logistic with intercept, {group}": K.logistic_regression(train, columns, intercept=True, keep=False),
            }
            return _checked(models, train, test, _logistic_margins(group))

    return query


def _logistic_margins(group):
    return {f"logistic, {group}": LINEAR_MARGIN, f"logistic with intercept, {group}": LINEAR_MARGIN}


def _assemble_vector(spark, folder):
    rows = interactions(spark, folder).select("service", "duration", "src_bytes", "urgent")
    vectors = Q.assemble_vector(rows, ["duration", "src_bytes", "urgent"])
    values = vector_to_array("features")
    return vectors.select("service", *[values[i].alias(f"x{i}") for i in range(3)])


def _labeled_points(spark, folder):
    points = Q.labeled_points(interactions(spark, folder), "chi_selected")
    values = vector_to_array("features")
    return points.select(
        "label", F.size(values).alias("width"), values[0].alias("first"), values[35].alias("last")
    )


def _encode_categories(spark, folder):
    """Categories of the records with a low tax; one label occurs only outside of them."""
    rows = interactions(spark, folder).select("service", "flag", "attack", "rerror_rate")
    known = rows.filter("rerror_rate <= 0.06")
    return Q.encode_categories(rows, ["service", "flag", "attack"], fit_on=known).drop(
        "rerror_rate"
    )


def _encode_label_multi(spark, folder):
    rows = interactions(spark, folder).select("attack", "duration")
    return Q.encode_label_multi(rows, fit_on=rows.filter("duration > 2"))


def _tree(spark, folder, label, margins):
    with _kept_sides(spark, folder) as (train, test):
        if label == "multi":
            rows = train.unionByName(test)
            train, test = (Q.encode_label_multi(side.drop("label"), fit_on=rows) for side in (train, test))
        model = K.decision_tree(train, INDEXED_NUMBERS, CATEGORIES, keep=False)
        return _checked(dict.fromkeys(margins, model), train, test, margins)


def _decision_tree(spark, folder):
    return _tree(spark, folder, "binary", {"decision tree": TREE_MARGIN})


def _decision_tree_multi(spark, folder):
    return _tree(spark, folder, "multi", {"decision tree, all labels": TREE_MARGIN})


def _tree_rules(spark, folder):
    """The splits of a tree over the fields that the label was planted on."""
    train, _ = map(cut_lineage, _sides(_labelled(spark, folder)))
    model = K.decision_tree(train, PLANTED_NUMBERS, PLANTED_CATEGORIES)
    rules = K.tree_rules(model, train).filter("feature IS NOT NULL")
    return rules.select("feature", F.round("threshold", 6).alias("threshold")).distinct()


def _two_tasks(name, fit, margin):
    def query(spark, folder):
        with _kept_sides(spark, folder) as (train, test):
            planted = _checked({name: fit(train, INDEXED_NUMBERS, CATEGORIES, keep=False)}, train, test, {name: margin})
        train, test = map(cut_lineage, _documents(spark, folder))
        quality = _checked({name: fit(train, RATIOS, ["lang"])}, train, test, {name: QUALITY_MARGIN})
        return planted.select(F.lit("planted").alias("task"), "*").union(
            quality.select(F.lit("document quality"), "*")
        )

    return query


def _predict(spark, folder):
    """Every row, held out or not, with its key and label; whether training saw it is marked."""
    train, _ = map(cut_lineage, _sides(_labelled(spark, folder)))
    model = K.decision_tree(train, PLANTED_NUMBERS, PLANTED_CATEGORIES)
    rows = _labelled(spark, folder)
    return K.predict(model, rows, KEY).withColumn(
        "held_out", in_hash_sample(KEY, TEST_FRACTION, SEED)
    )


def _align_predictions(spark, folder):
    rows = Q.encode_label_multi(_labelled(spark, folder).drop("label"))
    train, test = map(cut_lineage, _sides(rows))
    model = K.decision_tree(train, PLANTED_NUMBERS, PLANTED_CATEGORIES)
    return E.confusion(K.predict(model, test))


def _guessed(spark, folder):
    """Labels with a simple rule as their "prediction", for checking the metrics themselves."""
    guess = F.when(F.col("duration") > 40, 1.0).when(F.col("rerror_rate") > 0.05, 2.0).otherwise(0.0)
    true = (
        F.when(F.col("attack") == "normal.", 0.0)
        .when(F.col("attack") == "neptune.", 1.0)
        .when(F.col("attack") == "smurf.", 2.0)
        .otherwise(3.0)
    )
    return interactions(spark, folder).select(true.alias("label"), guess.alias("prediction"))


def _accuracy(spark, folder):
    return E.accuracy(_guessed(spark, folder)).select(F.round("accuracy", 6).alias("accuracy"))


def _classification_metrics(spark, folder):
    metrics = E.classification_metrics(_guessed(spark, folder))
    return metrics.select(*[F.round(c, 6).alias(c) for c in E.METRICS], "n")


def _all_models(rows):
    """(models, seconds): every model on the same kept rows; trees share their points, with their category groups."""
    shared = K.tree_features(rows, INDEXED_NUMBERS, CATEGORIES)
    with K.tree_points(rows, shared) as points:
        fits = {
            **{
                f"logistic, {group}": lambda g=group: K.logistic_regression(rows, FEATURE_GROUPS[g], keep=False)
                for group in ("numeric", "uncorrelated", "chi_selected")
            },
            "decision tree": lambda: K.decision_tree(points, INDEXED_NUMBERS, CATEGORIES, stages=shared),
            "random forest": lambda: K.random_forest(points, INDEXED_NUMBERS, CATEGORIES, stages=shared),
            "gradient boosting": lambda: K.gradient_boosting(points, INDEXED_NUMBERS, CATEGORIES, stages=shared),
            "linear svm": lambda: K.linear_svm(rows, INDEXED_NUMBERS, CATEGORIES, keep=False),
        }
        models, seconds = {}, {}
        for name, fit in fits.items():
            start = time.perf_counter()
            models[name] = fit()
            seconds[name] = time.perf_counter() - start
    return models, seconds


def _model_comparison(spark, folder):
    with _kept_sides(spark, folder) as (train, test):
        models, _ = _all_models(train)
        return _checked(models, train, test, COMPARED_MARGINS)


def _model_metrics(spark, folder):
    """The metrics of every model, with the seconds that its training and its scoring took."""
    with _kept_sides(spark, folder) as (train, test):
        models, seconds = _all_models(train)
        scoring = {}
        for name, model in models.items():
            start = time.perf_counter()
            K.predict(model, test).agg(F.sum("prediction")).first()
            scoring[name] = time.perf_counter() - start
        metrics = cut_lineage(_metrics(models, train, test))  # one row per model
    times = spark.createDataFrame(
        [(name, seconds[name], scoring[name]) for name in models],
        "model string, training_seconds double, scoring_seconds double",
    )
    return metrics.join(F.broadcast(times), "model", "left")


QUERIES = {
    "assemble_vector": _assemble_vector,
    "labeled_points": _labeled_points,
    "encode_categories": _encode_categories,
    "encode_label_multi": _encode_label_multi,
    "logistic_regression": _logistic("numeric"),
    "logistic_uncorrelated": _logistic("uncorrelated"),
    "logistic_chi": _logistic("chi_selected"),
    "decision_tree": _decision_tree,
    "decision_tree_multi": _decision_tree_multi,
    "tree_rules": _tree_rules,
    "random_forest": _two_tasks("random forest", K.random_forest, FOREST_MARGIN),
    "gradient_boosting": _two_tasks("gradient boosting", K.gradient_boosting, TREE_MARGIN),
    "linear_svm": _two_tasks("linear svm", K.linear_svm, LINEAR_MARGIN),
    "predict": _predict,
    "align_predictions": _align_predictions,
    "accuracy": _accuracy,
    "classification_metrics": _classification_metrics,
    "model_comparison": _model_comparison,
    "model_metrics": _model_metrics,
}

_GUESSED = (
    "guessed AS (SELECT CASE attack WHEN 'normal.' THEN 0 WHEN 'neptune.' THEN 1 "
    "WHEN 'smurf.' THEN 2 ELSE 3 END AS label, CASE WHEN duration > 40 THEN 1 "
    "WHEN rerror_rate > 0.05 THEN 2 ELSE 0 END AS prediction FROM interactions)"
)


def _index_sql(column: str, known: str) -> str:
    return (
        f"coalesce((SELECT k.i FROM {known} k WHERE k.v = r.{column}), "
        f"(SELECT count(*) FROM {known}))::DOUBLE"
    )


def _known_sql(name: str, column: str, where: str) -> str:
    return (
        f"{name} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i "
        f"FROM (SELECT DISTINCT {column} AS v FROM interactions WHERE {where}))"
    )


_LOW_TAX = "rerror_rate <= 0.06"
_BINARY = "CASE WHEN attack = 'normal.' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END"


def _held_sql(key: str, fraction: float) -> str:
    return f"substr(md5(concat('{SEED}:', {key})), 1, 8) < '{round(fraction * 16**8):08x}'"


def _checked_sql(sides: str, margins: dict[str, float]) -> str:
    """One row per model over ``sides`` (label, test): held-out rows, and how often the commonest label is right."""
    models = " UNION ALL ".join(f"SELECT '{m}' AS model, {v}::DOUBLE AS margin" for m, v in margins.items())
    return (
        f"SELECT model, n, round(hits / n::DOUBLE, 6) AS majority_accuracy, margin, true AS beaten FROM ({models}), "
        f"(SELECT count(*) AS n, count(*) FILTER (WHERE label = (SELECT label FROM {sides} WHERE NOT test "
        f"GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)) AS hits FROM {sides} WHERE test)"
    )


def _planted_sql(margins: dict[str, float], label: str = _BINARY) -> str:
    sides = f"sides AS (SELECT {label} AS label, {_held_sql(KEY, TEST_FRACTION)} AS test FROM interactions)"
    return over_interactions(f"WITH {sides} {_checked_sql('sides', margins)}")


def _two_tasks_sql(model: str, margin: float) -> str:
    return over_interactions(
        f"WITH sides AS (SELECT {_BINARY} AS label, {_held_sql(KEY, TEST_FRACTION)} AS test FROM interactions), "
        f"texts AS (SELECT quality AS label, {_held_sql('md5(text)', 0.5)} AS test FROM documents JOIN labels USING (doc_id)) "
        f"SELECT 'planted' AS task, * FROM ({_checked_sql('sides', {model: margin})}) UNION ALL "
        f"SELECT 'document quality' AS task, * FROM ({_checked_sql('texts', {model: QUALITY_MARGIN})})"
    )


def _between_sql(column: str, low: str) -> str:
    """The middle between the largest value that meets a condition and the smallest that does not."""
    return (
        f"SELECT '{column}' AS feature, round((max({column}) FILTER (WHERE {low}) "
        f"+ min({column}) FILTER (WHERE NOT ({low}))) / 2.0::DOUBLE, 6) AS threshold FROM train"
    )


_NUMBERED = (
    f"numbered AS (SELECT (dense_rank() OVER (ORDER BY attack) - 1)::DOUBLE AS label, "
    f"{_held_sql(KEY, TEST_FRACTION)} AS test FROM interactions)"
)

ORACLES = {
    "assemble_vector": over_interactions(
        "SELECT service, duration::DOUBLE AS x0, src_bytes::DOUBLE AS x1, urgent::DOUBLE AS x2 "
        "FROM interactions"
    ),
    "labeled_points": over_interactions(
        "SELECT CASE WHEN attack = 'normal.' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label, "
        '36 AS width, duration::DOUBLE AS "first", dst_host_srv_rerror_rate AS "last" '
        "FROM interactions"
    ),
    "encode_categories": over_interactions(
        f"WITH {_known_sql('services', 'service', _LOW_TAX)}, "
        f"{_known_sql('flags', 'flag', _LOW_TAX)}, {_known_sql('attacks', 'attack', _LOW_TAX)} "
        f"SELECT service, flag, attack, {_index_sql('service', 'services')} AS service_index, "
        f"{_index_sql('flag', 'flags')} AS flag_index, "
        f"{_index_sql('attack', 'attacks')} AS attack_index FROM interactions r"
    ),
    "encode_label_multi": over_interactions(
        f"WITH {_known_sql('attacks', 'attack', 'duration > 2')} "
        f"SELECT attack, duration, {_index_sql('attack', 'attacks')} AS label FROM interactions r"
    ),
    "accuracy": over_interactions(
        f"WITH {_GUESSED} SELECT round(avg((label = prediction)::INTEGER), 6) AS accuracy "
        "FROM guessed"
    ),
    "classification_metrics": over_interactions(
        f"WITH {_GUESSED}, classes AS (SELECT label AS c, count(*)::DOUBLE AS actual FROM guessed "
        "GROUP BY label), predicted AS (SELECT prediction AS c, count(*)::DOUBLE AS n FROM guessed "
        "GROUP BY prediction), hits AS (SELECT label AS c, count(*)::DOUBLE AS n FROM guessed "
        "WHERE label = prediction GROUP BY label), per_class AS (SELECT a.c, a.actual, "
        "coalesce(h.n / p.n, 0) AS prec, coalesce(h.n, 0) / a.actual AS rec FROM classes a "
        "LEFT JOIN predicted p ON a.c = p.c LEFT JOIN hits h ON a.c = h.c) "
        "SELECT round(sum(actual * rec) / sum(actual), 6) AS accuracy, "
        "round(sum(actual * prec) / sum(actual), 6) AS weighted_precision, "
        "round(sum(actual * rec) / sum(actual), 6) AS weighted_recall, "
        "round(sum(actual * CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) "
        "ELSE 0 END) / sum(actual), 6) AS f1, CAST(sum(actual) AS BIGINT) AS n FROM per_class"
    ),
    "logistic_regression": _planted_sql(_logistic_margins("numeric")),
    "logistic_uncorrelated": _planted_sql(_logistic_margins("uncorrelated")),
    "logistic_chi": _planted_sql(_logistic_margins("chi_selected")),
    "decision_tree": _planted_sql({"decision tree": TREE_MARGIN}),
    "decision_tree_multi": _planted_sql({"decision tree, all labels": TREE_MARGIN}, "attack"),
    "random_forest": _two_tasks_sql("random forest", FOREST_MARGIN),
    "gradient_boosting": _two_tasks_sql("gradient boosting", TREE_MARGIN),
    "linear_svm": _two_tasks_sql("linear svm", LINEAR_MARGIN),
    "model_comparison": _planted_sql(COMPARED_MARGINS),
    # The label's own rule: thresholds lie in the middle between the values on both sides.
    "tree_rules": over_interactions(
        f"WITH train AS (SELECT * FROM interactions WHERE NOT {_held_sql(KEY, TEST_FRACTION)}) "
        + " UNION ALL ".join(
            [
                _between_sql("rerror_rate", "rerror_rate <= 0.06"),
                _between_sql("duration", "duration <= 30"),
                _between_sql("duration", "duration < 3"),
                "SELECT 'protocol_type_group' AS feature, 1.5::DOUBLE AS threshold",
            ]
        )
    ),
    # A tree that has found the rule is right on every row, held out or not.
    "predict": over_interactions(
        f"SELECT {KEY}, {_BINARY} AS label, {_BINARY} AS prediction, "
        f"{_held_sql(KEY, TEST_FRACTION)} AS held_out FROM interactions"
    ),
    "align_predictions": over_interactions(
        f"WITH {_NUMBERED} SELECT label, label AS prediction, count(*) AS n FROM numbered WHERE test GROUP BY label"
    ),
}
