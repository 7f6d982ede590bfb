"""Mixing sources to target weights: capped water-filling, then seeded repetitions of documents.

Targets. Sources in code point order (null last) take the weights in turn and share `share` times the size of all documents. A
source's target stops at `max_epochs` times its own size; the excess goes to the others by weight until none is above. Each round
of this is one aggregation over the table of sources, and one row of sums comes to the driver.

Repetitions. A source's target is so many whole passes and a rest. All documents take the whole passes; those whose seeded digest
lies below the source's cutoff take one more. The cutoff is where the sizes of documents in digest order reach the rest, found in
256 ranges of digests and then in 256 ranges of the one that crosses it: sums by range, never a sort of a source's documents.
A range on the border is taken if that comes nearer to the target.

Sizes are counted once and written with the keys to the shared folder; no text is shuffled. Reruns give the same rows, as digests
depend on the seed, doc_id and text alone. Rows that share an id but not the text have digests of their own.

Defined results: a null text has size 0 and takes 0 words; an empty source has target 0; a null source is a source of its own;
rows that repeat doc_id and text are counted each, and are taken alike; an empty table gives an empty table. Extra columns are kept by
`mixed` and ignored by `takes`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from connlens.llm.common import WORD, broadcast_if_small, with_suffix, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = WEIGHTS
    share: float = SHARE
    max_epochs: int = MAX_EPOCHS
    seed: str = SEED


def _key(source: Column) -> Column:
    """In the order of sources, null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def _digest(doc_id: Column, text: Column, seed: str) -> Column:
    name = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), F.coalesce(text, F.lit("")))), 1, 4)


def _ranked(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Sources with their weight: ranked within ranges, whose sizes are added up (one number per range)."""
    placed = sources.repartitionByRange("key").sortWithinPartitions("key")
    row = F.monotonically_increasing_id()
    placed = written(placed.select("*", F.shiftright(row, 33).alias("part"), row.bitwiseAND((1 << 33) - 1).alias("place")), "mix-sources")
    before, total = {}, 0
    for part, n in sorted(map(tuple, placed.groupBy("part").count().collect())):
        before[part], total = total, total + n
    start = F.element_at(F.create_map(*(F.lit(x) for pair in before.items() for x in pair)), F.col("part")) if before else F.lit(0)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((start + F.col("place")) % len(weights) + 1).cast("int"))
    return placed.select("key", "source_size", weight.cast("double").alias("weight"))


def targets(sized: DataFrame, mix: Mix) -> DataFrame:
    """key, source_size, target of every source; `sized` has key and size."""
    sources = _ranked(sized.groupBy("key").agg(F.sum("size").alias("source_size")), mix.weights)
    cap = F.col("source_size") * float(mix.max_epochs)
    level, known = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level > cap
        total, capped, weight, n = sources.agg(
            F.sum("source_size"), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)
        ).first()
        if n == known or not weight:
            break
        level, known = (mix.share * (total or 0) - (capped or 0.0)) / weight, n
    target = F.least(F.col("weight") * (level or 0.0), cap)
    return sources.select("key", "source_size", target.alias("target"))


def _crossing(ranges: DataFrame, name: str) -> DataFrame:
    """Of each source, the range in which the sizes up to here reach `need`, and what is needed within it."""
    upto = F.sum("size").over(Window.partitionBy("key").orderBy(name).rowsBetween(Window.unboundedPreceding, 0))
    found = ranges.withColumn("upto", upto).filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("size") < F.col("need")))
    return found.withColumn("need", F.col("need") - F.col("upto") + F.col("size"))


def cutoffs(sized: DataFrame, mix: Mix) -> DataFrame:
    """key, source_size, target, whole passes, and the digest below which documents take one more (`last` itself if `with_last`)."""
    goal = targets(sized, mix)
    # At most 65,536 ranges a source, summed before they are shuffled.
    ranges = written(sized.groupBy("key", "digest").agg(F.sum("size").alias("size")).filter("size > 0"), "mix-ranges")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = written(
        goal.withColumn("whole", whole.cast("long")).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets"
    )
    need = goal.filter("need > 0").select("key", "need")
    first = F.substring("digest", 1, 2)
    coarse = ranges.groupBy("key", first.alias("first")).agg(F.sum("size").alias("size")).join(need, "key")
    coarse = _crossing(coarse, "first").select("key", "first", "need")
    fine = ranges.withColumn("first", first).join(coarse, ["key", "first"])
    fine = _crossing(fine, "digest")
    last = fine.select("key", F.col("digest").alias("last"), (2 * F.col("need") > F.col("size")).alias("with_last"))
    return written(goal.drop("need").join(last, "key", "left"), "mix-cutoffs")


def _repeats() -> Column:
    more = (F.col("digest") < F.col("last")) | ((F.col("digest") == F.col("last")) & F.col("with_last"))
    return F.col("whole") + F.coalesce(more, F.lit(False)).cast("long")


def _sized(docs: DataFrame, mix: Mix, text: str, source: str, doc_id: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    columns = [F.col(doc_id).alias("doc_id"), _key(F.col(source)).alias("key"), size.alias("size")]
    return written(docs.select(*columns, _digest(F.col(doc_id), F.col(text), mix.seed).alias("digest")), "mix-sizes")


def takes(docs: DataFrame, mix: Mix | None = None, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, source_size, target, taken (words) and repeats of every document."""
    mix = mix or Mix()
    sized = _sized(docs, mix, text, source, doc_id)
    joined = sized.join(broadcast_if_small(cutoffs(sized, mix)), "key").withColumn("repeats", _repeats())
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"), "repeats")


def mixed(docs: DataFrame, mix: Mix | None = None, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken, with its columns."""
    mix = mix or Mix()
    names = docs.columns
    own = {k: with_suffix(names, f"mix_{k}") for k in ("key", "digest", "source_size", "target", "whole", "last", "with_last", "turn")}
    cut = broadcast_if_small(cutoffs(_sized(docs, mix, text, source, doc_id), mix))
    cut = cut.select(*(F.col(c).alias(own[c]) for c in cut.columns))
    more = (F.col(own["digest"]) < F.col(own["last"])) | ((F.col(own["digest"]) == F.col(own["last"])) & F.col(own["with_last"]))
    times = F.col(own["whole"]) + F.coalesce(more, F.lit(False)).cast("long")
    keyed = docs.withColumn(own["key"], _key(F.col(source))).withColumn(own["digest"], _digest(F.col(doc_id), F.col(text), mix.seed))
    joined = keyed.join(cut, own["key"]).filter(times > 0)
    return joined.withColumn(own["turn"], F.explode(F.sequence(F.lit(1).cast("long"), times))).select(*(f"`{n}`" for n in names))


ORACLE = r"""
WITH sized AS (
    SELECT doc_id, coalesce('0' || source, '1') AS key, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')), 1, 4) AS digest
    FROM documents
), sources AS (
    SELECT key, source_size, ([3.0::DOUBLE, 1.0, 2.0])[((row_number() OVER (ORDER BY key)) - 1) % 3 + 1] AS weight
    FROM (SELECT key, sum(size)::BIGINT AS source_size FROM sized GROUP BY key)
), levels AS (
    SELECT key, source_size, weight,
           (1.5::DOUBLE * sum(source_size) OVER ()
            - coalesce(sum(2 * source_size) OVER (ORDER BY source_size / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY source_size / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources
), chosen AS (
    SELECT min_by(level, source_size / weight) AS level FROM levels WHERE level * weight <= 2 * source_size
), goals AS (
    SELECT key, source_size, least(weight * level, 2.0::DOUBLE * source_size) AS target,
           CASE WHEN source_size > 0 THEN floor(least(weight * level, 2.0::DOUBLE * source_size) / source_size) ELSE 0 END AS whole
    FROM sources, chosen
), ranges AS (
    SELECT key, digest, sum(size)::BIGINT AS size, sum(sum(size)) OVER (PARTITION BY key ORDER BY digest) AS upto
    FROM sized GROUP BY key, digest
), cuts AS (
    SELECT key, max(digest) AS last
    FROM ranges JOIN goals USING (key)
    WHERE size > 0 AND 2 * upto - size < 2 * (target - whole * source_size)
    GROUP BY key
)
SELECT doc_id, size, source_size, target, (size * (whole + (digest <= coalesce(last, ''))::INTEGER))::BIGINT AS taken,
       (whole + (digest <= coalesce(last, ''))::INTEGER)::BIGINT AS repeats
FROM sized JOIN goals USING (key) LEFT JOIN cuts USING (key)
"""
