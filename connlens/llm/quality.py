"""Quality rules whose cutoffs are certified on labelled documents.

Counts. All counts of a document come from array functions over its own words and lines; no text is shuffled or exploded.

Rules. A rule rejects a document if a count lies beyond a cutoff, per thousand words: symbols, words in repeated windows, repeated
lines, characters (long and short words). For each stratum and rule, the labelled good documents that pass the base rules
are a holdout: of `n`, a cutoff rejects `k`. It may be used if the exact binomial test refutes a share of `risk` or more:
P(Binomial(n, risk) <= k) <= level. Cutoffs are tested from the mildest on and the first that fails ends the row, so that cutoffs
need no correction; strata times rules do (Bonferroni): level = error / (strata * rules). With probability 1 - error, no stratum
loses more than rules * risk of its good documents. A rule without a certified cutoff rejects nothing, as for strata without labels.

Counts of labelled documents by (stratum, rule, cutoff) are sums that are combined before the shuffle; all labelled rows count.
The table of cutoffs has one row per stratum; it is broadcast after its rows were counted, otherwise joined.

Defined results: a null text has no words, hence fails the base rules; a null stratum is a stratum of its own; a document counts as
good if it has labels and all of them are good, null labels aside; repeated rows are judged each; an empty table gives an empty
table, an empty table of labels keeps all that the base rules keep.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.llm.common import BLANKS, WORD, broadcast_if_small, with_suffix, written

#: rule -> (count, +1: rejects above the cutoff, -1: below; cutoffs per thousand words, mildest first)
RULES = {
    "symbols": ("n_symbols", 1, (1000, 500, 400, 300, 250, 200, 150, 120, 100, 80, 60, 50, 40, 30, 20, 10)),
    "repeats": ("n_repeat_words", 1, (450, 400, 350, 300, 250, 200, 150, 120, 100, 80, 60, 40, 20, 10)),
    "lines": ("n_dup_lines", 1, (200, 150, 100, 80, 60, 50, 40, 30, 20, 15, 10, 8, 6, 4, 3, 2, 1)),
    "long_words": ("word_chars", 1, (20000, 15000, 12000, 10000, 9000, 8500, 8000, 7500, 7000)),
    "short_words": ("word_chars", -1, (1500, 2000, 2500, 2800, 3000, 3200, 3500, 3800, 4000)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Risk:
    """risk: share of good documents that one rule may reject in a stratum; error: chance that some promise fails."""

    risk: float = 0.002
    error: float = 0.05


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the five counts and base_failed."""
    own = {k: with_suffix(docs.columns, f"quality_{k}") for k in ("words", "windows", "starts", "lines")}
    words, windows, starts, lines = (F.col(own[k]) for k in ("words", "windows", "starts", "lines"))
    whole = F.coalesce(F.col(text), F.lit(""))
    base = docs.columns
    # Each array is a column of its own that the next step names more than once, so that it is computed once a row.
    out = docs.withColumn(own["words"], F.filter(F.split(whole, BLANKS + "+"), lambda w: w != ""))
    out = out.withColumn(own["lines"], F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD)))
    n = F.size(words)
    places = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    window = F.transform(places, lambda i: F.struct(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("t"), i.alias("i")))
    out = out.withColumn(own["windows"], F.array_sort(window))
    m = F.size(windows)
    at = F.when(m >= 2, F.sequence(F.lit(0), m - 1)).otherwise(F.array().cast("array<int>"))
    same = lambda a, b: F.coalesce(F.get(windows, a)["t"] == F.get(windows, b)["t"], F.lit(False))
    repeated = F.transform(F.filter(at, lambda k: same(k, k - 1) | same(k, k + 1)), lambda k: F.get(windows, k)["i"])
    out = out.withColumn(own["starts"], F.array_sort(repeated))
    steps = F.when(F.size(starts) >= 2, F.sequence(F.lit(0), F.size(starts) - 2)).otherwise(F.array().cast("array<int>"))
    covered = F.aggregate(steps, F.lit(0), lambda s, k: s + F.least(F.get(starts, k + 1) - F.get(starts, k), F.lit(3)))
    counts = [
        n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        (F.when(F.size(starts) > 0, covered + 3).otherwise(0)).cast("long").alias("n_repeat_words"),
    ]
    out = out.select(*(f"`{c}`" for c in base if c not in COUNTS), *counts)
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _ln_factorial(n: Column) -> Column:
    x = n.cast("double")
    stirling = x * F.log(x) - x + 0.5 * F.log(2 * F.pi() * x) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(stirling)


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """P(Binomial(n, risk) <= k) for k < n * risk, else 1 (no share below risk can be shown then).

    The terms from k downwards fall faster than a geometric row; those beyond 40 standard deviations add nothing to a double.
    """
    log_term = (
        _ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k) + k * float(math.log(risk)) + (n - k) * float(math.log(1 - risk))
    )
    steps = F.least(k, F.ceil(40 * F.sqrt(n * risk)) + 100)
    # In the row, term i - 1 is term i times i * (1 - risk) / ((n - i + 1) * risk).
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(acc: Column, j: Column) -> Column:
        i = (k - j + 1).cast("double")
        term = acc["term"] * i * (1 - risk) / ((n - i + 1) * risk)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    row = F.when(steps >= 1, F.sequence(F.lit(1).cast("long"), steps.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(row, start, step, lambda acc: acc["sum"])
    return F.when(k < n * risk, F.exp(log_term) * total).otherwise(F.lit(1.0))


def _beyond(rule: str, counts: str = "") -> list[Column]:
    """For each cutoff of the rule, whether a document lies beyond it."""
    name, sign, cutoffs = RULES[rule]
    value = 1000 * F.col(counts + name)
    return [(value > c * F.col("n_words")) if sign > 0 else (value < c * F.col("n_words")) for c in cutoffs]


def cutoffs(counted: DataFrame, labels: DataFrame, stratum: str, doc_id: str = "doc_id", promise: Risk | None = None) -> DataFrame:
    """stratum_key and, for each rule, the number of cutoffs that are certified (0: the rule isn't used)."""
    promise = promise or Risk()
    good = labels.filter("quality IS NOT NULL").groupBy(F.col("doc_id").alias("good_id")).agg(F.min("quality").alias("quality"))
    good = good.filter("quality = 1").select("good_id")
    held = counted.filter(~F.col("base_failed")).join(good, F.col(doc_id) == F.col("good_id"), "left_semi")
    sums = [F.count_if(b).alias(f"{r}_{j}") for r in RULES for j, b in enumerate(_beyond(r))]
    table = held.groupBy(F.col(stratum).alias("stratum_key")).agg(F.count(F.lit(1)).alias("n"), *sums)
    table = written(table, "quality-holdout")
    level = promise.error / max(1, table.count() * len(RULES))
    # One row per stratum, rule and cutoff, so that the test is one expression.
    cells = [
        F.struct(F.lit(rule).alias("rule"), F.lit(j).alias("j"), F.col(f"{rule}_{j}").alias("k"))
        for rule, (_, _, row) in RULES.items()
        for j in range(len(row))
    ]
    tests = table.select("stratum_key", "n", F.explode(F.array(*cells)).alias("cell")).select("stratum_key", "n", "cell.*")
    tests = tests.withColumn("failed", binomial_tail(F.col("k"), F.col("n"), promise.risk) > level)
    # The number of cutoffs before the first that fails.
    certified = [
        F.coalesce(F.min(F.when(F.col("failed") & (F.col("rule") == rule), F.col("j"))), F.lit(len(row))).cast("int").alias(rule)
        for rule, (_, _, row) in RULES.items()
    ]
    return written(tests.groupBy("stratum_key", "n").agg(*certified), "quality-cutoffs")


def _verdict(counted: DataFrame, table: DataFrame, stratum: str) -> DataFrame:
    """`counted` with kept: the base rules and each rule's strictest certified cutoff."""
    names = {r: with_suffix(counted.columns, f"cutoff_{r}") for r in (*RULES, "stratum_key")}
    table = table.select(*(F.col(r).alias(n) for r, n in names.items()))
    joined = counted.join(broadcast_if_small(table), F.col(stratum).eqNullSafe(F.col(names["stratum_key"])), "left")
    rejected = F.lit(False)
    for rule in RULES:
        cut = F.array(*_beyond(rule))
        rejected = rejected | F.coalesce(F.get(cut, F.col(names[rule]) - 1), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected).drop(*names.values())


def judged(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", doc_id: str = "doc_id", promise: Risk | None = None) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    keys = docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).alias("stratum"), F.col(text).alias("text"))
    counted = written(with_counts(keys).drop("text"), "quality-counts")
    table = cutoffs(counted, labels, "stratum", promise=promise)
    return _verdict(counted, table, "stratum").select("doc_id", *COUNTS, "base_failed", "kept")


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", doc_id: str = "doc_id", promise: Risk | None = None) -> DataFrame:
    """The rows of `docs` that are kept, with their columns. Documents are written once with their counts, then filtered."""
    names = {c: f"doc_{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    counted = written(with_counts(plain, names[text]), "quality-documents")
    table = cutoffs(counted, labels, names[stratum], names[doc_id], promise)
    kept = _verdict(counted, table, names[stratum]).filter("kept")
    return kept.select(*(F.col(n).alias(c) for c, n in names.items()))


def _sql_beyond(rule: str) -> str:
    """For each cutoff of the rule, whether a document lies beyond it, as a list."""
    name, sign, cuts = RULES[rule]
    return "[" + ", ".join(f"1000 * {name} {'>' if sign > 0 else '<'} {c} * n_words" for c in cuts) + "]"


def oracle(promise: Risk | None = None) -> str:
    """The same result in SQL, over documents and labels."""
    p = promise or Risk()
    cells = ", ".join(
        f"{{'rule': '{rule}', 'j': {j}, 'k': count(*) FILTER (WHERE ({_sql_beyond(rule)})[{j + 1}])}}"
        for rule, (_, _, cuts) in RULES.items()
        for j in range(len(cuts))
    )
    certified = ", ".join(
        f"coalesce(min(j) FILTER (WHERE failed AND rule = '{rule}'), {len(cuts)}) AS {rule}" for rule, (_, _, cuts) in RULES.items()
    )
    rejected = " OR ".join(f"coalesce(({_sql_beyond(rule)})[cut.{rule}], false)" for rule in RULES)
    log_term = f"lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p.risk}::DOUBLE) + (n - i) * ln({1 - p.risk!r}::DOUBLE)"
    return rf"""
WITH docs AS (
    SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
), places AS (
    SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS p FROM docs
), windows AS (
    SELECT doc_id, p, w || ' ' || lead(w) OVER own || ' ' || lead(w, 2) OVER own AS key
    FROM places WINDOW own AS (PARTITION BY doc_id ORDER BY p)
), starts AS (
    SELECT doc_id, p FROM windows WHERE key IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, key) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT p + k) AS n FROM starts, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), lined AS (
    SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM docs
), counts AS (
    SELECT doc_id, lang, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM lined LEFT JOIN covered USING (doc_id)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
), good AS (
    SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
), held AS (
    SELECT lang, count(*) AS n, [{cells}] AS cells FROM judged SEMI JOIN good USING (doc_id) WHERE NOT base_failed GROUP BY lang
), tests AS (
    SELECT lang, cell.rule AS rule, cell.j AS j,
           NOT (cell.k < n * {p.risk}::DOUBLE AND list_sum(list_transform(range(0, cell.k + 1), lambda i: exp({log_term})))
                <= {p.error}::DOUBLE / ((SELECT count(*) FROM held) * {len(RULES)})) AS failed
    FROM (SELECT lang, n, unnest(cells) AS cell FROM held)
), cut AS (
    SELECT lang, {certified} FROM tests GROUP BY lang
)
SELECT doc_id, {", ".join(COUNTS)}, base_failed, NOT base_failed AND NOT ({rejected}) AS kept
FROM judged LEFT JOIN cut ON judged.lang IS NOT DISTINCT FROM cut.lang
"""


ORACLE = oracle()
