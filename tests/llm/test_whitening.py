"""Whitening against numpy's eigenvectors, and its parts against exact arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from connlens.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, whitened string, x int"


def table(spark, vectors):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "w", 1) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def by_numpy(vectors, k):
    x = np.floor(256 * np.array(vectors, float))
    fit = np.unique(x, axis=0)
    values, parts = np.linalg.eigh(np.atleast_2d(np.cov(fit.T, bias=True)))
    values, parts = values[::-1][:k], parts[:, ::-1][:, :k]
    return len(fit), (x - fit.mean(axis=0)) @ parts / np.sqrt(values), values / np.trace(np.atleast_2d(np.cov(fit.T, bias=True)))


def check(spark, vectors, k=4):
    got = whitening.whitened(table(spark, vectors)).toPandas()
    n, white, explained = by_numpy(vectors, k)
    assert set(got.n) == {n} and len(got) == len(vectors) * k
    found = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(np.abs(found), np.abs(white), atol=1e-9)
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-9)
    assert got.identity_error.max() < 1e-9
    x = np.floor(256 * np.array(vectors, float)).astype(int)
    fit = np.unique(x, axis=0).astype(object)
    wanted = ((n * x.astype(object) - fit.sum(axis=0)) ** 2).sum(axis=1)
    assert got.groupby("vec_id").deviation.first().astype(object).map(int).tolist() == wanted.tolist()
    return got


def test_as_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))).tolist()
    check(spark, [*vectors, *vectors[:40], vectors[0], vectors[0]])  # repeated rows count once in the fit


def test_large_entries_are_exact(spark):
    rng = np.random.default_rng(4)
    check(spark, (np.round(rng.normal(size=(200, 5)) * 2.0**30) / 256).tolist())


def test_one_dimension(spark):
    check(spark, [[0.5], [1.0], [2.0], [-3.0]], k=1)


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(size=(50, 5)).tolist()
    odd = [None, [], [1.0, None, 0, 0, 0], [math.nan] * 5, [math.inf, 0, 0, 0, 0], [1.0, 2.0]]
    got = whitening.whitened(table(spark, [*good, *odd])).toPandas()
    assert sorted(set(got.vec_id)) == list(range(50))
    assert whitening.whitened(table(spark, [])).count() == 0
    assert whitening.whitened(table(spark, [[1.0, 2.0]] * 9)).count() == 0  # no variance


def test_equal_and_missing_variances(spark):
    # Four equal variances in six dimensions, two without any.
    vectors = [[s if i == j else 0.0 for i in range(4)] + [1.0, 1.0] for j in range(4) for s in (1.0, -1.0)]
    got = whitening.whitened(table(spark, vectors)).toPandas()
    assert sorted(set(got.component)) == [1, 2, 3, 4] and got.identity_error.max() < 1e-9
    assert np.allclose(got.explained, 0.25)
    few = whitening.whitened(table(spark, [[1.0, 0.0], [2.0, 0.0]])).toPandas()
    assert set(few.component) == {1}


@pytest.mark.parametrize("values", [[9, 3, 1, 0, 0], [5, 5, 5, 2, 2, 0], [7, 7, 7], [4]])
def test_roots_with_multiplicity(values):
    poly = [1]
    for v in values:
        poly = [a - v * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    found = [Fraction(r, 1 << bits) for r, bits, many in whitening.largest_roots(poly, 4) for _ in range(many)]
    wanted = [v for v in sorted(values, reverse=True) if v]
    assert len(found) >= min(4, len(wanted))
    assert all(abs(f - w) < Fraction(1, 1 << 200) for f, w in zip(found, wanted, strict=False))


def test_polynomial_by_primes(spark):
    rng = np.random.default_rng(6)
    a = rng.integers(-50, 50, (30, 7))
    matrix = (a.T @ a).tolist()
    poly = whitening.characteristic_polynomial(spark, matrix)
    assert poly[-1] == 1 and poly[-2] == -sum(matrix[i][i] for i in range(7))
    # Cayley and Hamilton: the matrix is a root of its own polynomial.
    power, total = np.eye(7, dtype=object), np.zeros((7, 7), object)
    for c in poly:
        total, power = total + c * power, power @ np.array(matrix, object)
    assert not total.any()


def test_products_of_many_limbs():
    rng = np.random.default_rng(7)
    x = rng.integers(-(2**62), 2**62, (50, 4))
    wanted = x.T.astype(object) @ x.astype(object)
    assert (sum(m.astype(object) * (1 << s) for s, m in whitening.exact_products(x).items()) == wanted).all()
