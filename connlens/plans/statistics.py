"""Descriptive statistics, correlation and chi-square tests (registered queries)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from connlens.fields import FEATURE_GROUPS
from connlens.functions import binary_label
from connlens.operators import chisquare as X
from connlens.operators import correlation as C
from connlens.operators import moments as M
from connlens.plans.roles import interactions, over_interactions

NUMERIC = FEATURE_GROUPS["numeric"]
DISCRETE = FEATURE_GROUPS["categorical_like"]
THRESHOLD = 0.8


def _rows(spark, folder):
    return interactions(spark, folder)


def _wide_rows(spark, folder):
    return interactions(spark, folder, heavy=True)


def _rounded(name: str) -> Column:
    """Nine decimals, or whole numbers where the double has no such digits."""
    value = F.col(name)
    return F.when(F.abs(value) < 1000, F.round(value, 9)).otherwise(F.round(value)).alias(name)


def _rounded_sql(value: str, name: str) -> str:
    return f"CASE WHEN abs({value}) < 1000 THEN round({value}, 9) ELSE round({value}) END AS {name}"


def _shown(stats, *keys):
    return stats.select(
        *keys,
        "feature",
        *[_rounded(c) for c in ("mean", "variance", "std")],
        "min",
        "max",
        "count",
        "nonzeros",
    )


def _describe_columns(spark, folder):
    stats = M.describe_columns(_rows(spark, folder), ["duration", "src_bytes", "urgent"])
    return stats.select("feature", "count", _rounded("mean"), _rounded("stddev"), "min", "max")


def _column_stats(spark, folder):
    return _shown(M.column_stats(_wide_rows(spark, folder), NUMERIC))


def _column_stats_for_tag(spark, folder):
    return _shown(M.column_stats_for_tag(_wide_rows(spark, folder), NUMERIC, "normal."))


def _column_stats_by_tag(spark, folder):
    return _shown(M.column_stats_by_tag(_wide_rows(spark, folder), NUMERIC), "attack")


def _variable_stats(variable):
    def query(spark, folder):
        stats = M.variable_stats(_rows(spark, folder), variable)
        return stats.select("attack", _rounded("mean"), _rounded("std"), "min", "max", "count")

    return query


def _rho() -> Column:
    rho = F.when(F.abs("rho") >= 5e-7, F.round("rho", 6)).when(F.col("rho").isNotNull(), F.lit(0.0))
    return rho.alias("rho")


def _spearman_matrix(spark, folder):
    matrix = C.spearman_matrix(_rows(spark, folder), NUMERIC)
    return matrix.select("feature_a", "feature_b", _rho())


def _pearson_matrix(spark, folder):
    matrix = C.pearson_matrix(_rows(spark, folder), NUMERIC)
    return matrix.select("feature_a", "feature_b", _rho())


def _high_correlation(spark, folder):
    pairs = C.high_correlation(C.spearman_matrix(_rows(spark, folder), NUMERIC), THRESHOLD)
    return pairs.select("feature_a", "feature_b", _rho())


def _correlated_variables(spark, folder):
    pairs = C.high_correlation(C.spearman_matrix(_rows(spark, folder), NUMERIC), THRESHOLD)
    return C.correlated_variables(pairs)


def _drop_correlated(spark, folder):
    pairs = C.high_correlation(C.spearman_matrix(_rows(spark, folder), NUMERIC), THRESHOLD)
    return C.drop_correlated(pairs, NUMERIC)


def _tested(spark, folder):
    rows = _rows(spark, folder).select(*DISCRETE, binary_label("attack").alias("label"))
    return X.chi_square(rows, DISCRETE, "label")


def _chi_square(spark, folder):
    return _tested(spark, folder).select("feature", F.round("statistic", 4).alias("statistic"), "dof")


def _contingency(spark, folder):
    rows = _rows(spark, folder).select(*DISCRETE, binary_label("attack").alias("label"))
    return X.contingency(rows, DISCRETE, "label")


def _select_by_pvalue(spark, folder):
    chosen = X.select_by_pvalue(_tested(spark, folder), 0.05)
    return chosen.select("feature", "dof", F.round("p_value", 6).alias("p_value"))


QUERIES = {
    "describe_columns": _describe_columns,
    "column_stats": _column_stats,
    "column_stats_for_tag": _column_stats_for_tag,
    "column_stats_by_tag": _column_stats_by_tag,
    "variable_stats": _variable_stats("src_bytes"),
    "variable_stats_duration": _variable_stats("duration"),
    "spearman_matrix": _spearman_matrix,
    "pearson_matrix": _pearson_matrix,
    "high_correlation": _high_correlation,
    "correlated_variables": _correlated_variables,
    "drop_correlated": _drop_correlated,
    "chi_square": _chi_square,
    "contingency": _contingency,
    "select_by_pvalue": _select_by_pvalue,
}


def _stats_sql(columns: list[str], keys: str = "", where: str = "") -> str:
    group = f"GROUP BY {keys}" if keys else ""
    prefix = f"{keys}, " if keys else ""
    parts = [
        f"SELECT {prefix}'{c}' AS feature, "
        + _rounded_sql(f'avg("{c}")', "mean")
        + ", "
        + _rounded_sql(f'var_samp("{c}")', "variance")
        + ", "
        + _rounded_sql(f'stddev_samp("{c}")', "std")
        + f', CAST(min("{c}") AS DOUBLE) AS "min", CAST(max("{c}") AS DOUBLE) AS "max", '
        f'count("{c}") AS "count", count(*) FILTER (WHERE "{c}" <> 0) AS nonzeros '
        f"FROM interactions {where} {group}"
        for c in columns
    ]
    return over_interactions(" UNION ALL ".join(parts))


def _variable_sql(variable: str) -> str:
    return over_interactions(
        f"SELECT attack, {_rounded_sql(f'avg({variable})', 'mean')}, "
        f"{_rounded_sql(f'stddev_samp({variable})', 'std')}, "
        f'CAST(min({variable}) AS DOUBLE) AS "min", CAST(max({variable}) AS DOUBLE) AS "max", '
        f'count({variable}) AS "count" FROM interactions GROUP BY attack'
    )


def _structs(pairs, value) -> str:
    return ", ".join(
        f"{{'feature_a': '{a}', 'feature_b': '{b}', 'rho': {value(a, b)}}}" for a, b in pairs
    )


def _matrix_sql(ranked: bool) -> str:
    """All ordered pairs: one correlation per unordered pair, then both directions."""
    source = "interactions"
    ranks = ""
    if ranked:
        columns = ", ".join(
            f'rank() OVER (ORDER BY "{c}") + (count(*) OVER (PARTITION BY "{c}") - 1) / 2.0::DOUBLE '
            f'AS "{c}"'
            for c in NUMERIC
        )
        ranks, source = f"WITH ranks AS MATERIALIZED (SELECT {columns} FROM interactions), ", "ranks"
    else:
        ranks = "WITH "
    pairs = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i:]]
    cells = _structs(
        pairs,
        lambda a, b: (
            f'CASE WHEN min("{a}") = max("{a}") OR min("{b}") = max("{b}") THEN NULL '
            + ("ELSE 1.0::DOUBLE END" if a == b else f'ELSE corr("{a}", "{b}") END')
        ),
    )
    return over_interactions(
        f"{ranks}half AS MATERIALIZED "
        f"(SELECT unnest([{cells}], recursive := true) FROM {source}), "
        "cells AS (SELECT feature_a, feature_b, "
        "CASE WHEN abs(rho) >= 5e-7 THEN round(rho, 6) WHEN rho IS NOT NULL THEN 0.0::DOUBLE END "
        "AS rho FROM half), "
        "matrix AS (SELECT feature_a, feature_b, rho FROM cells UNION ALL "
        "SELECT feature_b, feature_a, rho FROM cells WHERE feature_a <> feature_b) "
    )


_HIGH = (
    f"SELECT feature_a, feature_b, rho FROM matrix WHERE feature_a < feature_b "
    f"AND abs(rho) > {THRESHOLD}"
)
_GROUPS = (
    f", pairs AS ({_HIGH}), links AS (SELECT feature_a AS a, feature_b AS b FROM pairs "
    "UNION SELECT feature_b, feature_a FROM pairs), "
    "places AS (SELECT unnest(["
    + ", ".join(f"'{c}'" for c in NUMERIC)
    + f"]) AS feature, unnest(range({len(NUMERIC)})) AS place), "
)
_CELLS = (
    "cells AS (SELECT feature, value, label, count(*) AS n FROM (SELECT "
    "CASE WHEN attack = 'normal.' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label, "
    "unnest([{names}]) AS feature, unnest([{values}]) AS value FROM interactions) "
    "GROUP BY feature, value, label)"
)


def _cells_sql(columns: list[str]) -> str:
    return _CELLS.format(
        names=", ".join(f"'{c}'" for c in columns),
        values=", ".join(f'"{c}"::DOUBLE' for c in columns),
    )


_TESTED = (
        f"WITH {_cells_sql(DISCRETE)}, "
        "by_value AS (SELECT feature, value, sum(n)::DOUBLE AS value_n FROM cells GROUP BY ALL), "
        "by_label AS (SELECT feature, label, sum(n)::DOUBLE AS label_n FROM cells GROUP BY ALL), "
        "sizes AS (SELECT feature, sum(n)::DOUBLE AS total, count(DISTINCT value) AS vs, "
        "count(DISTINCT label) AS ls FROM cells GROUP BY feature), "
        "grid AS (SELECT v.feature, s.vs, s.ls, v.value_n * l.label_n / s.total AS e, "
        "coalesce(c.n, 0) AS n FROM by_value v JOIN by_label l ON v.feature = l.feature "
        "JOIN sizes s ON v.feature = s.feature LEFT JOIN cells c ON c.feature = v.feature "
        "AND c.value = v.value AND c.label = l.label), "
        "tested AS (SELECT feature, CASE WHEN max(vs) > 1 THEN sum((n - e) * (n - e) / e) "
        "ELSE 0.0::DOUBLE END AS statistic, (max(vs) - 1) * (max(ls) - 1) AS dof "
        "FROM grid GROUP BY feature) "
)


ORACLES = {
    "describe_columns": over_interactions(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, count({c}) AS \"count\", "
            + _rounded_sql(f"avg({c})", "mean")
            + ", "
            + _rounded_sql(f"stddev_samp({c})", "stddev")
            + f', CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max" '
            "FROM interactions"
            for c in ("duration", "src_bytes", "urgent")
        )
    ),
    "column_stats": _stats_sql(NUMERIC),
    "column_stats_for_tag": _stats_sql(NUMERIC, where="WHERE attack = 'normal.'"),
    "column_stats_by_tag": _stats_sql(NUMERIC, keys="attack"),
    "variable_stats": _variable_sql("src_bytes"),
    "variable_stats_duration": _variable_sql("duration"),
    "spearman_matrix": _matrix_sql(True) + "SELECT feature_a, feature_b, rho FROM matrix",
    "pearson_matrix": _matrix_sql(False) + "SELECT feature_a, feature_b, rho FROM matrix",
    "high_correlation": _matrix_sql(True) + _HIGH,
    "correlated_variables": (
        _matrix_sql(True).rstrip()
        + f", pairs AS ({_HIGH}) SELECT feature_a AS feature FROM pairs UNION SELECT feature_b FROM pairs"
    ),
    "drop_correlated": (
        (_matrix_sql(True).rstrip() + _GROUPS).replace("WITH interactions", "WITH RECURSIVE interactions", 1)
        + "reach AS (SELECT feature AS a, feature AS b FROM places UNION "
        "SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a), "
        "firsts AS (SELECT r.a AS feature, min(p.place) AS place FROM reach r "
        "JOIN places p ON r.b = p.feature GROUP BY r.a) "
        "SELECT f.feature, p.feature AS keeper, f.feature = p.feature AS kept "
        "FROM firsts f JOIN places p ON f.place = p.place"
    ),
    "chi_square": over_interactions(_TESTED + "SELECT feature, round(statistic, 4) AS statistic, dof FROM tested"),
    # P(X < x) for a chi-square variable is a sum of Poisson terms that begins at half the dof.
    "select_by_pvalue": over_interactions(
        _TESTED.rstrip()
        + ", terms AS (SELECT feature, dof, statistic, unnest(range(0, "
        "ceil(statistic / 2 + 40 * sqrt(statistic / 2 + 1) + 200)::BIGINT)) AS k "
        "FROM tested WHERE dof > 0 AND statistic > 0), "
        "tails AS (SELECT feature, dof, greatest(0.0::DOUBLE, 1 - sum(exp(-statistic / 2 "
        "+ (dof / 2 + k) * ln(statistic / 2) - lgamma(dof / 2 + k + 1)))) AS p FROM terms "
        "GROUP BY feature, dof) "
        "SELECT feature, dof, round(p, 6) AS p_value FROM tails WHERE p < 0.05"
    ),
    "contingency": over_interactions(
        f"WITH {_cells_sql(DISCRETE)} "
        "SELECT feature, value, label, n FROM cells"
    ),
}
