"""URL filters: fixed rules, then a ratio of two character models.

Rules name a host and a path; the longest that fits decides. URLs that a rule decides are also the labelled examples of accepted and
rejected URLs. From 13 in 16 of them (by digest of host and path) two variable-order Markov models are counted, one for
each class: P(character | context) at order k is Witten-Bell smoothed with order k - 1, down to equal chances. Contexts have up to
`order` characters and count if they were met `seen` times in the training URLs, so that the models grow with the input: no
context that repeats is left out, however rare it is. All training URLs are counted; nothing is sampled.

Scoring looks up each different (context, character) of all URLs once, then each URL its own. Tables are broadcast only if they have
at most `BROADCAST_ROWS` rows; larger ones join by shuffle, where Spark divides the partitions of frequent contexts.

A URL's score is the mean over its characters of the log ratio under the longest kept context. Scores of the others calibrate
the limit: the lowest score above which at most `loss` of its accepted URLs lie. URLs without a rule are blocked above it.
Ratios are rounded to millionths, so that sums don't depend on their order.

Defined results: a null url, or one without "://", has an empty host and path and is scored as such; rows that repeat are judged
each; without examples of both classes every URL that no rule decides is allowed; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.llm.common import LOWER, UPPER, broadcast_if_small, lower_ascii, written

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Characters of the models: letters of either case are one, digits are one, others are one.
ALPHABET = LOWER + "0./-_:~$"
START, END = "^", "$"


@dataclass(frozen=True)
class Model:
    order: int = 4
    seen: int = 2  # a context met less often is not kept
    held_out: int = 3  # sixteenths of the labelled URLs, for the limit
    loss: float = 0.01


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """`pages` with host and path."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))


def _fits(host: str, path: str) -> Column:
    return ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)


def _by_rule(rules: tuple[tuple[str, str, str], ...], value: str) -> Column:
    chosen = F.lit(None).cast("string")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        chosen = F.when(_fits(host, path), F.lit(verdict if value == "verdict" else host + path)).otherwise(chosen)
    return chosen


def _symbols() -> Column:
    """Host and path in the alphabet, with an end."""
    text = F.translate(F.concat("host", "path"), UPPER + "123456789", LOWER + "0" * 9)
    return F.concat(F.regexp_replace(text, "[^a-z0./_:-]", "~"), F.lit(END))


def _grams(texts: DataFrame, order: int, *keep: str) -> DataFrame:
    """One row per character of `symbols`: the character, and the `order` characters before it."""
    places = F.explode(F.sequence(F.lit(1), F.length("symbols")))
    padded = F.concat(F.lit(START * order), F.col("symbols"))
    rows = texts.select(*keep, padded.alias("padded"), places.alias("place"))
    return rows.select(
        *keep, "place", F.expr(f"substring(padded, place + {order}, 1)").alias("char"), F.expr(f"substring(padded, place, {order})").alias("context")
    )


def fitted(training: DataFrame, model: Model) -> list[DataFrame]:
    """For each order from 0, rows (context, char, ratio): log P(rejected) - log P(accepted) in millionths, kept contexts complete.

    `training` has symbols and rejected (boolean).
    """
    counts = _grams(training, model.order, "rejected").groupBy("context", "char").agg(
        F.count_if("rejected").alias("n1"), F.count_if(~F.col("rejected")).alias("n0")
    )
    counts = written(counts, "url-grams")
    alphabet = F.explode(F.array(*map(F.lit, ALPHABET))).alias("char")
    lower, out = None, []
    for k in range(model.order + 1):
        grams = counts.groupBy(F.expr(f"right(context, {k})").alias("context"), "char").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        held = grams.groupBy("context").agg(
            *(F.sum(f"n{c}").alias(f"all{c}") for c in (0, 1)), *(F.count_if(F.col(f"n{c}") > 0).alias(f"kinds{c}") for c in (0, 1))
        )
        held = held.filter(F.col("all0") + F.col("all1") >= model.seen)
        cells = held.select("*", alphabet).join(grams, ["context", "char"], "left")
        if lower is None:
            cells = cells.select("*", *(F.lit(1.0 / len(ALPHABET)).alias(f"low{c}") for c in (0, 1)))
        else:
            below = lower.select(F.col("context").alias("shorter"), "char", F.col("p0").alias("low0"), F.col("p1").alias("low1"))
            cells = cells.withColumn("shorter", F.expr(f"right(context, {k - 1})")).join(below, ["shorter", "char"])
        smooth = [
            ((F.coalesce(f"n{c}", F.lit(0)) + F.col(f"kinds{c}") * F.col(f"low{c}")) / (F.col(f"all{c}") + F.col(f"kinds{c}"))).alias(f"p{c}")
            if k == 0
            else F.when(F.col(f"all{c}") > 0, (F.coalesce(f"n{c}", F.lit(0)) + F.col(f"kinds{c}") * F.col(f"low{c}")) / (F.col(f"all{c}") + F.col(f"kinds{c}")))
            .otherwise(F.col(f"low{c}"))
            .alias(f"p{c}")
            for c in (0, 1)
        ]
        lower = written(cells.select("context", "char", *smooth), "url-model")
        out.append(lower.select("context", "char", F.round(1e6 * (F.log("p1") - F.log("p0"))).cast("long").alias("ratio")))
    return out


def scored(pages: DataFrame, tables: list[DataFrame], *keep: str) -> DataFrame:
    """`keep`, and score: the mean log ratio of the characters, in millionths. `pages` has symbols; rows that repeat stay."""
    grams = _grams(pages, len(tables) - 1).select("context", "char").distinct()
    found = F.lit(None).cast("long")
    for k, table in enumerate(tables):
        name = f"ratio{k}"
        table = table.select(F.col("context").alias(f"context{k}"), F.col("char").alias(f"char{k}"), F.col("ratio").alias(name))
        fits = (F.expr(f"right(context, {k})") == F.col(f"context{k}")) & (F.col("char") == F.col(f"char{k}"))
        grams = grams.join(broadcast_if_small(table), fits, "left")
        found = F.coalesce(F.col(name), found)
    ratios = written(grams.select("context", "char", F.coalesce(found, F.lit(0)).alias("ratio")), "url-ratios")
    rows = _grams(pages, len(tables) - 1, *keep).join(broadcast_if_small(ratios), ["context", "char"])
    # Sums are made in each task first, so that one row per page is shuffled where the ratios are broadcast.
    sums = rows.groupBy(*keep).agg(
        F.sum("ratio").alias("sum"), F.count(F.lit(1)).alias("chars"), F.count_if(F.col("place") == 1).alias("copies")
    )
    sums = sums.withColumn("score", F.col("sum") / F.col("chars"))
    return sums.select(*keep, "score", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")


def _limit(held: DataFrame, loss: float) -> float | None:
    """The score, in bins of a thousandth, above which at most `loss` of the accepted lie. Scores have at most 40,001 bins."""
    bin_ = F.ceil(F.least(F.greatest(F.col("score"), F.lit(-20e6)), F.lit(20e6)) / 1000)
    bins = sorted(map(tuple, held.filter("NOT rejected").groupBy(bin_.alias("bin")).count().collect()), reverse=True)
    allowed, above = loss * sum(n for _, n in bins), 0
    for bin_, n in bins:
        above += n
        if above > allowed:
            return bin_ * 1000.0
    return None


def judged(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, model: Model | None = None, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """page_id, host, path, rule, verdict and score (in nats per character; positive: like blocked URLs) of every page."""
    model = model or Model()
    parts = with_parts(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")))
    parts = parts.select("page_id", "host", "path", _by_rule(rules, "rule").alias("rule"), _by_rule(rules, "verdict").alias("decided"))
    parts = written(parts.withColumn("symbols", _symbols()).withColumn("rejected", F.col("decided") == "block"), "url-parts")
    held_out = F.substring(F.md5("symbols"), 1, 1) < f"{model.held_out:x}"
    labelled = parts.filter("rejected IS NOT NULL")
    training = labelled.filter(~held_out)
    classes = training.groupBy("rejected").count().count()
    if classes < 2:
        score, limit = parts.withColumn("score", F.lit(0.0)), None
    else:
        keep = ("page_id", "host", "path", "rule", "decided", "rejected", "symbols")
        score = written(scored(parts, fitted(training, model), *keep), "url-scores")
        limit = _limit(score.filter("rejected IS NOT NULL").filter(held_out), model.loss)
    learned = F.lit("allow") if limit is None else F.when(F.col("score") > limit, "block").otherwise("allow")
    return score.select("page_id", "host", "path", "rule", F.coalesce("decided", learned).alias("verdict"), (F.col("score") / 1e6).alias("score"))


def _sql_rule(value: str) -> str:
    cases = []
    for verdict, host, path in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits = f"(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}')"
        cases.append(f"WHEN {fits} THEN '{verdict if value == 'verdict' else host + path}'")
    return f"CASE {' '.join(cases)} END"


def _sql_order(k: int, model: Model) -> str:
    """Common tables of one order: counts of kept contexts, and chances of all characters in them."""
    low = f"1.0::DOUBLE / {len(ALPHABET)}" if k == 0 else "low.p{0}"
    chance = "CASE WHEN h.all{0} > 0 THEN (coalesce(g.n{0}, 0) + h.kinds{0} * " + low + ") / (h.all{0} + h.kinds{0}) ELSE " + low + " END AS p{0}"
    below = "" if k == 0 else f"JOIN model{k - 1} low ON low.context = right(h.context, {k - 1}) AND low.char = h.char"
    return f"""grams{k} AS (
    SELECT right(context, {k}) AS context, char, sum(n0)::BIGINT AS n0, sum(n1)::BIGINT AS n1 FROM counts GROUP BY ALL
), held{k} AS (
    SELECT context, sum(n0)::BIGINT AS all0, sum(n1)::BIGINT AS all1, count(*) FILTER (WHERE n0 > 0) AS kinds0, count(*) FILTER (WHERE n1 > 0) AS kinds1
    FROM grams{k} GROUP BY context HAVING all0 + all1 >= {model.seen}
), model{k} AS MATERIALIZED (
    SELECT h.context, h.char, {chance.format(0)}, {chance.format(1)}
    FROM (SELECT *, unnest(string_split('{ALPHABET}', '')) AS char FROM held{k}) h
    LEFT JOIN grams{k} g ON g.context = h.context AND g.char = h.char {below}
)"""


def oracle(model: Model | None = None) -> str:
    """The same result in SQL, over pages."""
    m = model or Model()
    orders = range(m.order + 1)
    digits, lower = "0" * 9, LOWER
    found = "coalesce(" + ", ".join(f"round(1e6 * (ln(m{k}.p1) - ln(m{k}.p0)))::BIGINT" for k in reversed(orders)) + ", 0)"
    joins = " ".join(f"LEFT JOIN model{k} m{k} ON m{k}.context = right(c.context, {k}) AND m{k}.char = c.char" for k in orders)
    return rf"""
WITH rest AS (
    SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{lower}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
), parts AS MATERIALIZED (
    SELECT page_id, host, path, {_sql_rule("rule")} AS rule, {_sql_rule("verdict")} AS decided, row_number() OVER () AS row,
           regexp_replace(translate(host || path, '{UPPER}123456789', '{lower}{digits}'), '[^a-z0./_:-]', '~', 'g') || '{END}' AS symbols
    FROM split
), chars AS MATERIALIZED (
    SELECT row, substr('{START * m.order}' || symbols, place + {m.order}, 1) AS char, substr('{START * m.order}' || symbols, place, {m.order}) AS context
    FROM (SELECT row, symbols, unnest(range(1, length(symbols) + 1)) AS place FROM parts)
), counts AS MATERIALIZED (
    SELECT context, char, count(*) FILTER (WHERE decided = 'block') AS n1, count(*) FILTER (WHERE decided = 'allow') AS n0
    FROM chars JOIN parts USING (row) WHERE decided IS NOT NULL AND substr(md5(symbols), 1, 1) >= '{m.held_out:x}' GROUP BY ALL
), {", ".join(_sql_order(k, m) for k in orders)}, scores AS MATERIALIZED (
    SELECT c.row, sum({found})::BIGINT / count(*) AS score FROM chars c {joins} GROUP BY c.row
), bins AS (
    SELECT ceil(least(greatest(score, -20e6), 20e6) / 1000) AS bin, count(*) AS n FROM scores JOIN parts USING (row)
    WHERE decided = 'allow' AND substr(md5(symbols), 1, 1) < '{m.held_out:x}' GROUP BY 1
), above AS (
    SELECT bin, sum(n) OVER (ORDER BY bin DESC) AS above, sum(n) OVER () AS total FROM bins
), edge AS (
    SELECT max(bin) FILTER (WHERE above > {m.loss}::DOUBLE * total) * 1000 AS score FROM above
), classes AS (
    SELECT count(*) FILTER (WHERE n0 > 0) > 0 AND count(*) FILTER (WHERE n1 > 0) > 0 AS enough FROM counts
)
SELECT page_id, host, path, rule,
       coalesce(decided, CASE WHEN enough AND edge.score IS NOT NULL AND s.score > edge.score THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN enough THEN s.score / 1e6 ELSE 0.0::DOUBLE END AS score
FROM parts JOIN scores s USING (row), edge, classes
"""


ORACLE = oracle()
