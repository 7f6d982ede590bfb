"""Rows that every operator must bear: nulls, empty and long texts, ties, repeats, clashing column names."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau upsilon".split()
#: Extra columns bear names that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, node long, cells string"


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return [rng.choice(WORDS) + str(rng.randint(0, 400)) for _ in range(n)]


def documents() -> list[tuple]:
    shared, base = " ".join(words(1, 60)), words(2, 300)
    near = [list(base) for _ in range(4)]
    for i, row in enumerate(near):
        row[7 * i + 3] = f"edited{i}"
    texts = [
        None, "", "   \n\t ", "one", "two words", shared, shared + " tail", "Head " + shared,
        " ".join(words(3, 120)) + "\n" + shared, " ".join(words(4, 5000)), "same same same " * 40, "A # line\nA # line\nother\n" * 30,
        *(" ".join(r) for r in near), " ".join(base), " ".join(base), "É ü 漢字 " * 30, "x\u00a0y\x1cz " * 60,
    ]
    texts += [" ".join(words(100 + i, 80 + i)) for i in range(40)]
    rows = [
        (i, t, ("en", "de", None)[i % 3], ("b", "a", None, "a", "a")[i % 5], len(t or ""), -1, "k", 5, "c") for i, t in enumerate(texts)
    ]
    return [*rows, rows[5], rows[5], (None, shared, "en", "a", 0, 0, None, None, None), (None, None, None, None, None, None, None, None, None)]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(5)


def plain(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.select(*columns).collect()), key=repr)
