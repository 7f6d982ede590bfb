"""Correlation matrices as long tables, and what follows from them.

Both matrices need one cross-product sum per pair of columns. Each task adds up the d x d sums of
its own rows with one matrix product per Arrow batch; Spark then adds the d x d results of the
tasks. For rank correlation the ranks come from value counts, never from a sort of all rows, so
a value that fills a third of a column is one row of the count table. Rows travel in blocks: a block
asks once for the rank of each value that it holds, in any column, and gets all answers back at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from connlens.sources.storage import cut_lineage, new_scratch_path, write_result
from connlens.sources.tables import spread_if_few

# Values in one block of rows (8 bytes each).
BLOCK_CELLS = 1_000_000

_SUMS = "a int, b int, total double"
_BLOCKS = "block long, distinct binary, starts array<int>, width int, places binary"
_BLOCK = pa.schema(
    [("block", pa.int64()), ("distinct", pa.binary()), ("starts", pa.list_(pa.int32())), ("width", pa.int32()), ("places", pa.binary())]
)
_ASKED = "block long, feature int, value double, place int, n long"
# Row groups of a few blocks, whose size the writer looks at after each of them.
_SMALL_GROUPS = {
    "parquet.block.size": 16 << 20,
    "parquet.enable.dictionary": "false",
    **{f"parquet.{part}.size.row.check.{end}": 1 for part in ("block", "page") for end in ("min", "max")},
}


def _vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of each row as one array ``x``, each row with weight 1.

    Rows with a null or NaN are left out later, by the tasks: as a filter here, the condition
    would be derived anew for every combination of columns by the optimizer.
    """
    values = F.array(*[F.col(c).cast("double") for c in columns])
    rows = spread_if_few(df.select(*columns))
    return rows.select(values.alias("x"), F.lit(1.0).alias("weight"))


def _matrix(sums: DataFrame, columns: list[str]) -> DataFrame:
    """(feature_a, feature_b, rho) for all ordered pairs; null where a column is constant.

    The sums are those of ``_cross_sums``: the entries with the constant column give the number of
    rows and, per column, the distance of the mean from the centre.
    """
    size = len(columns)
    shift = sums.filter((F.col("b") == size) & (F.col("a") < size)).select(
        F.col("a").alias("i"), F.col("total").alias("shift")
    )
    squares = sums.filter((F.col("a") == F.col("b")) & (F.col("a") < size)).select(
        F.col("a").alias("i"), F.col("total").alias("squares")
    )
    rows = sums.filter(F.col("a") == size).select(F.col("total").alias("n"))
    one = shift.join(squares, "i").withColumn("n", rows.scalar())
    spread = F.col("squares") - F.try_divide(F.col("shift") ** 2, F.col("n"))
    # What rounding leaves of the spread of a constant column is not a spread.
    one = one.select("i", "shift", "n", F.when(spread > F.col("squares") * 1e-14, spread).alias("s"))
    left = one.toDF("a", "shift_a", "n", "s_a")
    right = one.drop("n").toDF("b", "shift_b", "s_b")
    product = F.col("total") - F.try_divide(F.col("shift_a") * F.col("shift_b"), F.col("n"))
    rho = F.try_divide(product, F.sqrt("s_a") * F.sqrt("s_b"))
    rho = F.when(F.col("a") == F.col("b"), F.when(F.col("s_a").isNotNull(), 1.0)).when(
        rho.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), rho))
    )
    half = sums.join(left, "a").join(right, "b").withColumn("rho", rho)
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    names = F.array(*[F.lit(c) for c in columns])
    return half.select(F.inline(both), "rho").select(
        F.get(names, F.col("a")).alias("feature_a"),
        F.get(names, F.col("b")).alias("feature_b"),
        "rho",
    )


def _cross_sums(rows: DataFrame, centre: list[float]) -> DataFrame:
    """Sum over the rows of weight * (x_a - centre_a) * (x_b - centre_b) for every a <= b.

    A constant 1 stands behind the columns, so that the sums also hold counts and plain sums.
    """
    size = len(centre)
    middle = np.array(centre)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size + 1, size + 1))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            x = x.reshape(batch.num_rows, size)
            complete = ~np.isnan(x).any(axis=1)  # nulls arrive as NaN
            x = x[complete]
            weight = batch.column("weight").to_numpy(zero_copy_only=False)[complete]
            x = np.column_stack([x - middle, np.ones(len(x))])
            sums += x.T @ (x * weight[:, None])
        a, b = np.triu_indices(size + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(sums[a, b])],
            names=["a", "b", "total"],
        )

    return (
        rows.mapInArrow(partial, _SUMS).groupBy("a", "b").agg(F.sum("total").alias("total"))
    )


def pearson_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of all pairs of columns; null where a column is constant.

    Rows with a null or NaN in any of the columns are left out of every pair; for pairs of their
    own complete rows, ask for two columns at a time. A table without complete rows has null cells
    only.
    """
    numbers = [F.col(c).cast("double") for c in columns]
    means = df.agg(*[F.avg(F.when(~F.isnan(v), v)) for v in numbers]).first()
    return _matrix(_cross_sums(_vectors(df, columns), [m or 0.0 for m in means]), columns)


def _blocks(rows: DataFrame, size: int, cells: int) -> DataFrame:
    """(block, distinct, starts, width, places): the complete rows in blocks of ``cells`` numbers at most, written once.

    A block holds the distinct values of its columns one after the other, where each column begins there, and for each number its
    place among the values of its column, in ``width`` bytes. All later steps read the written blocks, so that
    they agree on them when executors are lost.
    """
    most = max(1, cells // size)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            x = x[~np.isnan(x).any(axis=1)] + 0.0  # -0.0 and 0.0 are one value
            while n + len(x) >= most:
                yield _packed(number, np.concatenate([*held, x[: most - n]]))
                x, number, held, n = x[most - n :], number + 1, [], 0
            held.append(x)
            n += len(x)
        if n:
            yield _packed(number, np.concatenate(held))

    blocks = rows.select("x").mapInArrow(pack, _BLOCKS)
    # A parquet writer would hold a hundred blocks before it looks at their size, and a reader then all of them.
    return write_result(blocks, new_scratch_path(rows.sparkSession, "blocks"), options=_SMALL_GROUPS)


def _packed(number: int, x: np.ndarray) -> pa.RecordBatch:
    found = [np.unique(column, return_inverse=True) for column in x.T]
    starts = np.cumsum([0, *(len(values) for values, _ in found)]).tolist()
    width = 2 if len(x) <= 1 << 16 else 4
    places = b"".join(place.astype(f"u{width}").tobytes() for _, place in found)
    distinct = np.concatenate([values for values, _ in found]).tobytes()
    row = {"block": number, "distinct": distinct, "starts": starts, "width": width, "places": places}
    return pa.RecordBatch.from_pylist([row], schema=_BLOCK)


def _unpacked(blocks: pa.RecordBatch | pa.Table, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Of block ``i``: where its columns begin among the distinct values, and one row of places for each column."""
    starts, data, width = (blocks.column(c)[i].as_py() for c in ("starts", "places", "width"))
    return np.array(starts), np.frombuffer(data, f"u{width}").reshape(len(starts) - 1, -1)


def _asked(blocks: DataFrame) -> DataFrame:
    """(block, feature, value, place, n): the distinct values of each column of each block, ``place`` over all its columns."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                starts, places = _unpacked(batch, i)
                number, values = batch.column("block")[i].as_py(), np.frombuffer(batch.column("distinct")[i].as_py())
                many = np.diff(starts)
                n = [np.bincount(p, minlength=w) for p, w in zip(places, many, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(values), number)),
                        pa.array(np.repeat(np.arange(len(many), dtype=np.int32), many)),
                        pa.array(values),
                        pa.array(np.arange(len(values), dtype=np.int32)),
                        pa.array(np.concatenate(n).astype(np.int64)),
                    ],
                    names=["block", "feature", "value", "place", "n"],
                )

    return blocks.mapInArrow(ask, _ASKED)


def value_ranks(asked: DataFrame) -> DataFrame:
    """(feature, value, n, rank): number of rows and average rank of each distinct value.

    The distinct values are range-partitioned and written, so that their partition is a fixed range
    of values: rows before a value are those of the ranges before plus those before it inside its
    own range.
    """
    counts = asked.groupBy("feature", "value").agg(F.sum("n").alias("n"))
    parts = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = cut_lineage(
        counts.repartitionByRange(parts, "feature", "value")
    ).withColumn("part", F.spark_partition_id())
    # At most one row per range and column: safe to broadcast and to order in one task.
    ranges = ordered.groupBy("feature", "part").agg(F.sum("n").alias("_size"))
    before = F.sum("_size").over(W.partitionBy("feature").orderBy("part")) - F.col("_size")
    ranges = ranges.select("feature", "part", before.alias("_before"))
    upto = F.sum("n").over(W.partitionBy("feature", "part").orderBy("value"))
    return (
        ordered.withColumn("_upto", upto)
        .join(F.broadcast(ranges), ["feature", "part"])
        .select(
            "feature",
            "value",
            "n",
            (F.col("_before") + F.col("_upto") - (F.col("n") - 1) / 2).alias("rank"),
        )
    )


def _ranked_sums(blocks: DataFrame, answers: DataFrame, size: int, centre: float) -> DataFrame:
    """The cross-product sums of the ranks: ``answers`` has the rank of every place of every block."""

    def sums(key, block: pa.Table, answer: pa.Table) -> pa.Table:
        starts, places = _unpacked(block, 0)
        ranks = np.empty(starts[-1])
        ranks[answer.column("place").to_numpy()] = answer.column("rank").to_numpy()
        x = np.column_stack([ranks[start:end][p] for start, end, p in zip(starts, starts[1:], places)])
        x = np.column_stack([x - centre, np.ones(len(x))])
        total = x.T @ x
        a, b = np.triu_indices(size + 1)
        return pa.table({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "total": total[a, b]})

    pairs = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(sums, _SUMS)
    # A table without complete rows has sums of zero.
    side = size + 1
    none = blocks.sparkSession.range(side * side).selectExpr(
        f"CAST(id DIV {side} AS int) AS a", f"CAST(id % {side} AS int) AS b", "0.0D AS total"
    )
    return pairs.union(none.filter("a <= b")).groupBy("a", "b").agg(F.sum("total").alias("total"))


def spearman_matrix(df: DataFrame, columns: list[str], cells: int = BLOCK_CELLS) -> DataFrame:
    """Rank correlation of all pairs of columns; equal values share their average rank.

    Rows with a null or NaN in any of the columns are left out of every pair. A table without
    complete rows has null cells only.

    The rows are cut to blocks of ``cells`` values. One exchange takes the distinct values of the
    blocks to the table of ranks, a second one the ranks to the blocks, for all columns together. A
    value is asked for once by each block that holds it, however many rows it has.
    """
    size = len(columns)
    blocks = _blocks(_vectors(df, columns), size, cells)
    asked = _asked(blocks)
    ranks = write_result(value_ranks(asked), new_scratch_path(df.sparkSession, "ranks"))
    total = ranks.filter("feature = 0").agg(F.sum("n")).first()[0] or 0
    answers = asked.join(ranks.select("feature", "value", "rank"), ["feature", "value"]).select(
        "block", "place", "rank"
    )
    return _matrix(_ranked_sums(blocks, answers, size, (total + 1) / 2), columns)


def high_correlation(matrix: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs of different variables with a correlation beyond the threshold, each pair once."""
    return matrix.filter(
        (F.col("feature_a") < F.col("feature_b")) & (F.abs("rho") > threshold)
    )


def correlated_variables(pairs: DataFrame) -> DataFrame:
    """Variables that occur in at least one pair."""
    return pairs.select(F.explode(F.array("feature_a", "feature_b")).alias("feature")).distinct()


def drop_correlated(pairs: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, keeper, kept): the first variable of each correlated group is kept.

    A group is everything connected by pairs. The pair table has one row per pair of columns at
    most, so the grouping itself is done on the driver.
    """
    keeper = {c: c for c in columns}

    def first(name: str) -> str:
        while keeper[name] != name:
            name = keeper[name]
        return name

    for pair in pairs.select("feature_a", "feature_b").collect():
        ends = sorted((first(pair[0]), first(pair[1])), key=columns.index)
        keeper[ends[1]] = ends[0]
    rows = [(c, first(c), first(c) == c) for c in columns]
    return pairs.sparkSession.createDataFrame(
        rows, "feature string, keeper string, kept boolean"
    )
