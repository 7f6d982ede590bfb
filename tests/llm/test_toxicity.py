"""The factorization machine: held-out accuracy, pairs of terms, odd rows."""

import math
import random
import zlib

from cases import WORDS, frame

from connlens.llm import toxicity

LABELS = "doc_id long, toxic int, quality int, text string"
DOCS = "doc_id long, text string, label int, score string"


def folds(ids):
    return [zlib.crc32(str(i).encode()) % 5 == 0 for i in ids]


def wrong(spark, texts, labels, model):
    docs = spark.createDataFrame([(i, t, 0, "s") for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    held = [i for i, h in enumerate(folds(range(len(texts)))) if h]
    assert [i for i in sorted(got) if got[i]["held_out"]] == held
    return sum((got[i]["score"] >= 0.5) != bool(labels[i]) for i in held) / len(held)


def test_pairs_that_no_sum_of_weights_tells_apart(spark):
    rng, texts, labels = random.Random(2), [], []
    for _ in range(600):
        first, second = rng.choice("ab"), rng.choice("cd")
        # Each of the four words is toxic half of the time: only pairs tell.
        labels.append(int((first == "a") == (second == "c")))
        noise = rng.sample(WORDS, 3)
        texts.append(" ".join([*noise, first * 9, second * 9]))
    docs = spark.createDataFrame([(i, t, 0, "s") for i, t in enumerate(texts)], DOCS)
    known = spark.createDataFrame([(i, y, 0, "x") for i, y in enumerate(labels)], LABELS)
    model = toxicity.trained(toxicity.training_rows(docs, known))
    assert wrong(spark, texts, labels, model) < 0.05


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.judged(docs, labels)
    assert got.count() == docs.count()
    rows = got.filter("held_out").join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.95 * len(rows)
    english = [r for r in rows if r["lang"] == "en"]
    assert all(r["predicted"] == r["toxic"] for r in english) and sum(r["toxic"] for r in english) > 2


def test_odd_rows(spark):
    docs = frame(spark)
    known = [(i, i % 2, 0, "t") for i in range(60)] + [(None, 1, 0, "t"), (5, None, 0, "t"), (6, 0, 0, "t"), (6, 1, 0, "t")]
    got = toxicity.judged(docs, spark.createDataFrame(known, LABELS)).collect()
    assert len(got) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False, False]
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[0] == by_id[1] == by_id[2]  # null, empty and blank texts


def test_labels_that_teach_nothing(spark):
    docs = frame(spark)
    for known, score in (([], 0.0), ([(1, 1, 0, "t"), (2, 1, 0, "t")], 1.0), ([(None, 1, 0, "t"), (3, None, 0, "t")], 0.0)):
        got = toxicity.judged(docs, spark.createDataFrame(known, LABELS)).collect()
        assert len(got) == docs.count() and {r["score"] for r in got} == {score}
    empty = toxicity.judged(docs.limit(0), spark.createDataFrame([(1, 1, 0, "t"), (2, 0, 0, "t")], LABELS))
    assert empty.count() == 0


def test_labels_of_the_fold_and_other_columns_do_not_enter(spark):
    docs = spark.createDataFrame([(i, f"{WORDS[i % 20]} {WORDS[i // 7 % 20]}", 0, "s") for i in range(100)], DOCS)
    ys = [(i, int(i % 20 < 4), 0, "x") for i in range(100)]
    flipped = [(i, 1 - y if h else y, 1, "z") for (i, y, _, _), h in zip(ys, folds(range(100)), strict=True)]
    a, b = (sorted(map(tuple, toxicity.judged(docs, spark.createDataFrame(k, LABELS)).collect())) for k in (ys, flipped))
    assert all(math.isclose(x[2], y[2], rel_tol=1e-6) for x, y in zip(a, b, strict=True))


def test_a_bound_on_the_training_rows(spark):
    docs = spark.createDataFrame([(i, WORDS[i % 20], 0, "s") for i in range(2000)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(2000)], LABELS)
    assert 150 < toxicity.training_rows(docs, labels, 200).count() < 260
