"""Feature vectors, category numbers and held-out splits."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from connlens.fields import FEATURE_GROUPS, LABEL, NORMAL
from connlens.functions import binary_label, in_hash_sample
from connlens.sources.storage import cut_lineage, new_scratch_path, write_result

# Rows of one category in one join key; categories with more are joined by a small table of their own, the
# MOST_HEAVY largest of them. Those left out of it have less than a 10,000th of the rows each.
BLOCK_ROWS = 1_000_000
MOST_HEAVY = 10_000
# Category groups of a column, and what a group is made of.
GROUPS = 32
RATE_STEPS = 10_000
LEAST_ROWS = 20


def hash_split(
    df: DataFrame, key: str | Column, test_fraction: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key: rows with equal keys stay on the same side."""
    held_out = in_hash_sample(key, test_fraction, seed)
    return df.filter(~held_out), df.filter(held_out)


def assemble_vector(df: DataFrame, columns: list[str], name: str = "features") -> DataFrame:
    """Add one vector column made of numeric columns."""
    return VectorAssembler(inputCols=columns, outputCol=name).transform(df)


def labeled_points(
    df: DataFrame, group: str = "numeric", tag: str = LABEL, normal: str = NORMAL
) -> DataFrame:
    """(label 0/1, features) for one of the named feature groups that hold numbers only."""
    columns = FEATURE_GROUPS[group]
    rows = df.select(*columns, binary_label(tag, normal).alias("label"))
    return assemble_vector(rows, columns).select("label", "features")


def index_name(column: str) -> str:
    return f"{column}_index"


def fit_categories(df: DataFrame, columns: list[str]) -> StringIndexerModel:
    """Number the categories of each column in alphabetical order, as a stage of a model.

    A category not seen here gets the number after the last, also as part of the declared range,
    so that later training on such a row does not fail. The fitted stage holds the categories, so
    it suits columns whose categories are few beside the rows; ``encode_categories`` has no such
    need.
    """
    return StringIndexer(
        inputCols=columns,
        outputCols=[index_name(c) for c in columns],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    ).fit(df)


def encode_categories(
    df: DataFrame, columns: list[str], fit_on: DataFrame | None = None, block: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``<column>_index`` for each column, with the categories of ``fit_on``.

    Categories are numbered in alphabetical order, from 0; one that ``fit_on`` lacks, or none, gets
    the number after the last. The numbers are a table that is joined, so that any number of
    categories will do, and any share of the rows in one of them (see ``with_lookup``).
    """
    source = df if fit_on is None else fit_on
    for column in columns:
        numbers, size = category_numbers(source, column)
        numbers = numbers.withColumnRenamed("number", "_number")
        numbers = write_result(numbers, new_scratch_path(df.sparkSession, "numbers"))
        df = with_lookup(df, column, numbers, block)
        index = F.coalesce("_number", F.lit(size)).cast("double")
        df = df.withColumn(index_name(column), index).drop("_number")
    return df


def with_lookup(df: DataFrame, column: str, table: DataFrame, block: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with the columns of ``table`` (category, ...) for the category of each row, or nulls.

    ``table`` should be written, so that Spark knows its size and may send a small one to all tasks.
    Frequency decides how a row finds its entry. Categories that more than ``block`` rows of ``df`` have
    are counted and the entries of the largest, found or not, broadcast: MOST_HEAVY at most. All others are
    joined by exchange; rows without a category, and those that have their entry already, are
    dealt to that exchange evenly, so that no task gets more than ``block`` rows, or a 10,000th, of one key.
    """
    others = [c for c in table.columns if c != "category"]
    counts = df.groupBy(F.col(column).alias("category")).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.filter(F.col("category").isNotNull() & (F.col("_n") > block))
    heavy = counts.orderBy(F.desc("_n"), "category").limit(MOST_HEAVY).join(table, "category", "left")
    heavy = heavy.select(
        F.col("category").alias("_heavy"), F.struct(*others).alias("_found")
    )
    rest = table.select(
        F.col("category").alias("_rest"), F.lit(0).alias("_salt"), F.struct(*others).alias("_met")
    )
    known = df.join(F.broadcast(heavy), df[column] == F.col("_heavy"), "left")
    done = F.col("_heavy").isNotNull() | F.col(column).isNull()
    known = known.withColumns(
        {
            "_key": F.when(~done, F.col(column)),
            "_place": F.when(done, F.pmod(F.monotonically_increasing_id(), F.lit(1 << 30)).cast("int")).otherwise(0),
        }
    )
    same = (F.col("_key") == F.col("_rest")) & (F.col("_place") == F.col("_salt"))
    found = F.when(F.col("_heavy").isNotNull(), F.col("_found")).otherwise(F.col("_met"))
    joined = known.join(rest, same, "left").withColumn("_entry", found)
    return joined.select(*df.columns, *[F.col("_entry")[c].alias(c) for c in others])


def group_name(column: str) -> str:
    return f"{column}_group"


def category_groups(
    df: DataFrame, column: str, label: str = "label", groups: int = GROUPS, least: int = LEAST_ROWS
) -> DataFrame:
    """(category, group): categories of like label rates, in rising order of the rate, from 1.

    One grouped pass gives rows and label rate of every category. Rates are counted in RATE_STEPS steps; the
    steps are cut, in order, to at most ``groups`` groups of about equally many rows. For two classes
    no other order of the categories gives a better cut. With more classes the rate is that of the
    mean class number. A category with fewer than ``least`` rows says nothing about its rate: it has no
    entry, like one that was never seen.
    """
    label = F.col(label).cast("double")
    low, high = df.agg(F.min(label), F.max(label)).first()
    span = (high - low) if low is not None and high > low else 1.0
    step = F.floor((F.avg(label) - F.lit(low or 0.0)) / span * (RATE_STEPS - 1)).cast("int")
    rates = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("category")).agg(
        F.count(F.lit(1)).alias("n"), step.alias("step")
    )
    rates = rates.filter(F.col("n") >= least)
    steps = rates.groupBy("step").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("categories"))
    # RATE_STEPS rows at most: one task orders them, and they can be broadcast.
    order, every = W.orderBy("step"), W.partitionBy()
    before = F.sum("n").over(order) - F.col("n")
    whole = F.sum("n").over(every)
    cut = F.when(F.count(F.lit(1)).over(every) <= groups, F.row_number().over(order)).otherwise(
        F.floor(before * groups / whole).cast("int") + 1
    )
    return rates.join(F.broadcast(steps.select("step", cut.alias("group"))), "step").select("category", "group")


def category_numbers(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """(category, number) of a column in alphabetical order, and how many there are.

    The distinct values are range-partitioned and written, so that a number is the size of the
    ranges before plus the place in the own range.
    """
    values = df.select(F.col(column).alias("category")).filter("category IS NOT NULL").distinct()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = cut_lineage(
        values.repartitionByRange(parts, "category").sortWithinPartitions("category")
    ).withColumns(
        {
            "_part": F.spark_partition_id(),
            "_place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1),
        }
    )
    before, total = [], 0
    for part, size in sorted(map(tuple, ordered.groupBy("_part").count().collect())):
        before += [F.lit(part), F.lit(total)]
        total += size
    start = F.element_at(F.create_map(*before), F.col("_part")) if before else F.lit(0)
    return ordered.select("category", (start + F.col("_place")).alias("number")), total


def encode_label_multi(
    df: DataFrame, tag: str = LABEL, fit_on: DataFrame | None = None, name: str = "label"
) -> DataFrame:
    """Add the label as one of n class numbers; a label not seen in ``fit_on`` gets n."""
    return encode_categories(df, [tag], fit_on).withColumnRenamed(index_name(tag), name)


class CategoryGroups(Transformer):
    """A fitted stage that adds ``<column>_group`` for each column; 0 for a category without a group."""

    def __init__(self, tables: dict[str, DataFrame]) -> None:
        super().__init__()
        self.tables = tables

    def _transform(self, df: DataFrame) -> DataFrame:
        for column, table in self.tables.items():
            df = with_lookup(df, column, table.withColumnRenamed("group", "_group"))
            df = df.withColumn(group_name(column), F.coalesce("_group", F.lit(0)).cast("double"))
            df = df.drop("_group")
        return df


def feature_stages(
    df: DataFrame, categories: list[str], numbers: list[str], one_hot: bool, groups: int = GROUPS
) -> PipelineModel:
    """Fitted stages that build ``features``.

    For trees, categories become groups in the order of their label rate: any number of categories
    fits into the same number of bins. For linear models each category becomes a column of its own.
    """
    if not categories:
        return PipelineModel([VectorAssembler(inputCols=numbers, outputCol="features")])
    if not one_hot:
        tables = {c: category_groups(df, c, groups=groups) for c in categories}
        tables = {c: write_result(t, new_scratch_path(df.sparkSession, "groups")) for c, t in tables.items()}
        names = [group_name(c) for c in categories]
        return PipelineModel(
            [CategoryGroups(tables), VectorAssembler(inputCols=names + numbers, outputCol="features")]
        )
    indexer = fit_categories(df, categories)
    names, hot = [index_name(c) for c in categories], [f"{c}_hot" for c in categories]
    encoder = OneHotEncoder(inputCols=names, outputCols=hot, handleInvalid="keep").fit(indexer.transform(df))
    return PipelineModel([indexer, encoder, VectorAssembler(inputCols=hot + numbers, outputCol="features")])


def text_ratios(df: DataFrame, text: str = "text") -> DataFrame:
    """Add punctuation per character and distinct words per word, over the whole text."""
    words = F.split(F.lower(F.trim(text)), r"\s+")
    marks = F.length(F.regexp_replace(text, r"[^\p{Punct}]", ""))
    return df.withColumns(
        {
            "punctuation_ratio": marks / F.greatest(F.length(text), F.lit(1)),
            "distinct_word_ratio": F.size(F.array_distinct(words)) / F.size(words),
        }
    )
