"""Chi-square tests of independence between discrete features and a label."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def contingency(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(feature, value, label, n) for every value that occurs, from one pass over the rows."""
    values = F.array(*[F.col(c).cast("double") for c in features])
    names = F.array(*[F.lit(c) for c in features])
    return (
        df.select(F.posexplode(values).alias("_feature", "value"), F.col(label).alias("label"))
        .groupBy("_feature", "value", "label")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.get(names, F.col("_feature")).alias("feature"), "value", "label", "n")
    )


def p_value(statistic: Column, dof: Column) -> Column:
    """P-value of a chi-square statistic, for the few rows of a result table.

    Everything the tasks need is inside, so they do not have to import this package.
    """

    def upper_tail(statistic: float, dof: int) -> float:
        """P(X >= statistic) for a chi-square variable: the regularized upper gamma function."""
        a, x = dof / 2.0, statistic / 2.0
        if dof <= 0 or x <= 0:
            return 1.0
        if not math.isfinite(x):
            return 0.0 if x > 0 else math.nan
        front = math.exp(a * math.log(x) - x - math.lgamma(a))
        if x < a + 1:
            term = total = 1 / a
            n = a
            while term > total * 1e-16:
                n += 1
                term *= x / n
                total += term
            return max(0.0, 1.0 - front * total)
        # Continued fraction, evaluated by the modified Lentz method.
        tiny = 1e-300
        b = x + 1 - a
        c, d = 1 / tiny, 1 / b
        result = d
        step, i = 0.0, 0
        while abs(step - 1) > 1e-15:  # about sqrt(a) steps; a statistic that is no number ends it
            i += 1
            factor = i * (a - i)
            b += 2
            d = 1 / (factor * d + b or tiny)
            c = b + factor / c or tiny
            step = c * d
            result *= step
        return front * result

    @F.pandas_udf("double")
    def tails(statistics: pd.Series, dofs: pd.Series) -> pd.Series:
        return pd.Series([upper_tail(s, int(k)) for s, k in zip(statistics, dofs)])

    return tails(statistic, dof)


def chi_square(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(feature, statistic, dof, p_value): Pearson's test of each feature against the label.

    Works for any number of distinct values; only one row per feature reaches the p-value
    function.
    """
    cells = contingency(df, features, label).dropna(subset=["value", "label"])
    of_value = F.sum("n").over(W.partitionBy("feature", "value"))  # one row per label at most
    per_label = cells.groupBy("feature", "label").agg(F.sum("n").alias("label_n"))
    sizes = per_label.groupBy("feature").agg(
        F.sum("label_n").alias("total"), F.count(F.lit(1)).alias("labels")
    )
    expected = F.col("value_n") * (F.col("label_n") / F.col("total"))
    sums = (
        cells.withColumn("value_n", of_value)
        .join(per_label, ["feature", "label"])
        .join(sizes, "feature")
        .withColumn("expected", expected)
        .groupBy("feature")
        .agg(
            F.sum((F.col("n") - F.col("expected")) ** 2 / F.col("expected")).alias("seen"),
            F.sum("expected").alias("expected"),
            F.sum(F.col("n") / F.col("value_n")).alias("values"),
            F.first("total").alias("total"),
            F.first("labels").alias("labels"),
        )
    )
    # Cells that never occur add their expected count: all rows minus the expectations seen.
    unseen = F.greatest(F.lit(0.0), F.col("total") - F.col("expected"))
    dof = (F.round("values").cast("long") - 1) * (F.col("labels") - 1)
    tested = sums.select(
        "feature",
        F.when(dof > 0, F.col("seen") + unseen).otherwise(0.0).alias("statistic"),
        dof.alias("dof"),
    )
    return tested.withColumn("p_value", p_value(F.col("statistic"), F.col("dof")))


def select_by_pvalue(tested: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Features whose relation to the label is significant; constant ones have p-value 1."""
    return tested.filter(F.col("p_value") < alpha)
