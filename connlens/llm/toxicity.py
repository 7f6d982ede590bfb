"""Toxicity of whole texts: a factorization machine over hashed terms, trained on the labelled documents.

Terms of a text are its distinct words (runs of letters, lower-cased) and the beginnings of its words of PREFIXES letters, hashed into
2**BITS buckets. A text's score is the logistic function of a weight per term and, for every pair of its terms, the inner product of
their factors: an insult may weigh more beside the mention of a group than either does alone, which no sum of weights expresses. The sum
over pairs takes one pass over the terms: half of (sum of factors)**2 less the sum of (factors)**2.

- **Training** takes the labelled rows whose doc_id is not held out (crc32 of the decimal doc_id divisible by FOLDS), TRAINING_ROWS of
  them at most: beyond that a share by a digest of doc_id. That is the bound of everything that training gathers; the labels
  of the sample are broadcast, its texts stay on the executors. Of the terms found in LEAST_DOCUMENTS of its texts or more, those whose
  presence goes most with or against the label (chi-square) have a weight: VOCABULARY terms, and no more than there are texts, since more
  would be learnt by heart. `pyspark.ml` fits the machine over the partitioned sample.
- **Scoring** is one pass over all texts in Arrow batches, without a shuffle; a task holds the model (VOCABULARY * (1 + FACTORS) numbers)
  and one batch. Only `text` enters a score.

Defined results: a null text is an empty one, and scores what the machine gives without terms. Several labels of a doc_id count as toxic if one
is; several texts of it train as the first in string order; null labels and null doc_ids train nothing. A null doc_id is not held out.
Rows are returned as they are, repeated ones too. If the training labels are all alike, or there are none, every score is their share of toxic
rows (0 without any). Other columns of any name are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.llm.common import written

FOLDS = 5
TRAINING_ROWS = 20_000
BITS = 20
PREFIXES = (4, 5, 6)
VOCABULARY = 1 << 12
LEAST_DOCUMENTS = 3
FACTORS = 4
ROUNDS = 100
STEP = 0.05
SHRINK = 1e-5
SEED = 13
#: Words whose buckets a worker remembers.
REMEMBERED = 50_000

_WORD = re.compile(r"[^\W\d_]+")
_SCORED = "doc_id long, held_out boolean, score double"


@dataclass(frozen=True)
class Machine:
    """Weights and factors by bucket; buckets outside the vocabulary are absent."""

    bias: float
    places: dict[int, int]
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, places: np.ndarray) -> float:
        """Before the logistic function, for the places of a text's distinct terms."""
        v = self.factors[places]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum())
        return self.bias + float(self.weights[places].sum()) + pairs


def buckets(word: str) -> list[int]:
    """Buckets of a word's terms; a beginning is told from the word of the same letters."""
    terms = [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) >= n)]
    return [zlib.crc32(t.encode("utf-8", "surrogatepass")) >> 32 - BITS for t in terms]


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted({str(b) for w in words(t.as_py()) for b in buckets(w)}) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.string()))], names=["label", "terms"])


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """(label, terms) of the labelled texts that training takes."""
    known = labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("double")).alias("label"))
    share = min(1.0, rows / max(1, known.count()))
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(share * (1 << 40)))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return written(texts.select("label", "text").mapInArrow(_terms, "label double, terms array<string>"), "toxicity-terms")


def trained(rows: DataFrame, factors: int = FACTORS, rounds: int = ROUNDS) -> Machine | float:
    """The machine, or the share of toxic rows where there is nothing to tell apart."""
    n, toxic = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or toxic in (0, n):
        return float(toxic or 0) / max(1, n)
    # Chi-square of a term's presence against the label, without the factors that all terms share.
    k, m = F.col("toxic"), F.col("n")
    odds = (k * (n - toxic - m + k) - (m - k) * (toxic - k)) ** 2 / (m * (n - m + 0.5))
    counts = rows.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic"))
    common = counts.filter(F.col("n") >= LEAST_DOCUMENTS).orderBy(odds.desc(), "term").limit(min(VOCABULARY, n))
    vocabulary = [r["term"] for r in common.select("term").collect()]
    if not vocabulary:
        return float(toxic) / n
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, "terms", "features").setBinary(True)
    points = vectors.transform(rows).select("label", "features").repartition(rows.sparkSession.sparkContext.defaultParallelism)
    machine = FMClassifier(
        factorSize=factors, maxIter=rounds, stepSize=STEP, regParam=SHRINK, initStd=0.01, seed=SEED, tol=1e-6
    ).fit(points)
    places = {int(bucket): i for i, bucket in enumerate(vocabulary)}
    return Machine(float(machine.intercept), places, machine.linear.toArray(), machine.factors.toArray())


def scored(docs: DataFrame, model: Machine | float) -> DataFrame:
    """doc_id, held_out, score of every row."""
    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    if isinstance(model, float):
        return rows.select("doc_id", "held_out", F.lit(model).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # VOCABULARY * (1 + FACTORS) numbers at most

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = shared.value, {}
        for batch in batches:
            margins = []
            for text in batch.column("text"):
                found = set()
                for word in words(text.as_py()):
                    places = known.get(word)
                    if places is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[word] = places = tuple(machine.places[b] for b in buckets(word) if b in machine.places)
                    found.update(places)
                margins.append(machine.margin(np.fromiter(sorted(found), np.int64, len(found))))
            scores = 1 / (1 + np.exp(-np.clip(np.array(margins), -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores)], names=["doc_id", "held_out", "score"])

    return rows.mapInArrow(score, _SCORED)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = trained(training_rows(docs, labels))
    return scored(docs, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
