"""Whitening of embeddings on exact sums: each vector on its first principal components, scaled to unit variance.

An entry c becomes the whole number x = floor(256 * c). Every distinct x vector counts once: these n vectors are the fit list, S their
sums by dimension. The integer scatter matrix M = n * sum(x x') - S S' is n * n times their covariance, without rounding.

- **Sums.** Each task multiplies its vectors in blocks, cut into limbs so short that a product of doubles is exact; Spark adds the
  d * d whole numbers of the tasks. What reaches the driver has the size of a d * d matrix, whatever the number of vectors.
- **Characteristic polynomial.** Rows of primes are spread over tasks; each reduces M modulo its prime to Hessenberg form and returns
  the d + 1 coefficients of its characteristic polynomial. Chinese remaindering joins them; enough primes are taken that
  their product exceeds twice the largest coefficient that a matrix of this trace can have.
- **Roots.** All roots are real, so that the sign changes of the coefficients of p(t + a) count the roots above a exactly. Bisection
  by this count isolates the largest roots, with their multiplicity; a single root is then refined by the sign of p alone, to PRECISION bits.
- **Components.** Inverse iteration in decimal arithmetic of DIGITS digits finds the null space of M - root; a root that
  occurs m times gives m orthogonal components. The sign is fixed: the entry of largest size is positive.

Defined results: rows whose vector is null, empty, holds null or non-finite entries, or has another length than most vectors of the table
(of equally frequent lengths the longest) are dropped. An entry beyond the range of long is cut to it. Repeated vectors, also those
that differ by less than the step of 1/256, count once in the fit and each give rows. Components of variance zero are left out, since nothing
can scale them: a table of one distinct vector, or none, gives no rows. A null vec_id is a row like any other; other columns are ignored.
`deviation` is decimal(38,0), null where even that is too short.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from connlens.llm.common import written

#: Entries are rounded down to whole multiples of 1 / STEPS.
STEPS = 256
COMPONENTS = 4
#: Bits of a limb and rows of a block: a block's sum of products of two limbs stays below 2**53.
LIMB, BLOCK = 19, 8192
#: Bits to which a root is known, beside those before the binary point; decimal digits of the inverse iteration.
PRECISION, DIGITS = 256, 80
#: Primes per task of the polynomial.
PRIMES_A_TASK = 8

_SUMS = "a int, b int, shift int, total decimal(38,0)"
_WHITE = "vec_id long, deviation decimal(38,0), whitened array<double>"


@dataclass(frozen=True)
class Fit:
    """What whitening needs: n, the sums S, the matrix M, and per component the root of M and a unit vector."""

    n: int
    sums: list[int]
    roots: list[float]
    vectors: np.ndarray
    explained: list[float]


def stepped(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * STEPS) + 0)
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(math.inf)))
    rows = vectors.filter(fine & (F.size("embedding") > 0))
    lengths = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    length = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).select("d").scalar()
    return rows.filter(F.size("embedding") == length).select(F.col("vec_id").cast("long"), whole.alias("x"))


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Doubles l0, l1, ... with x = l0 + l1 * 2**LIMB + ..., each of less than LIMB + 1 bits."""
    limbs = []
    while True:
        high = x >> LIMB
        if ((high == 0) | (high == -1)).all():
            return [*limbs, x.astype(np.float64)]
        limbs.append((x & ((1 << LIMB) - 1)).astype(np.float64))
        x = high


def exact_products(x: np.ndarray) -> dict[int, np.ndarray]:
    """{shift: whole matrix}: x' x is the sum of the matrices times 2**shift. x: whole numbers, BLOCK rows at most."""
    limbs, found = _limbs(x), {}
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            shift = (i + j) * LIMB
            found[shift] = found.get(shift, 0) + (a.T @ b).astype(np.int64)
    return found


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        column = batch.column("x")
        if not len(column):
            continue
        x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)
        x = np.column_stack([x, np.ones(len(x), np.int64)])
        for start in range(0, len(x), BLOCK):
            for shift, total in exact_products(x[start : start + BLOCK]).items():
                totals[shift] = totals.get(shift, 0) + total.astype(object)
    for shift, total in totals.items():
        a, b = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array([shift] * len(a), pa.int32()),
             pa.array([decimal.Decimal(int(t)) for t in total[a, b]], pa.decimal128(38, 0))],
            names=["a", "b", "shift", "total"],
        )


def scatter(distinct: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """n, S and M of the fit list, exactly."""
    sums = distinct.select("x").mapInArrow(_sums, _SUMS).groupBy("a", "b", "shift").agg(F.sum("total").alias("total"))
    cells: dict[tuple[int, int], int] = {}
    for a, b, shift, total in sums.collect():  # (d + 1)**2 / 2 cells, a few shifts each
        cells[a, b] = cells.get((a, b), 0) + (int(total) << shift)
    if not cells:
        return 0, [], []
    d = max(a for a, _ in cells)
    n, s = cells[d, d], [cells[a, d] for a in range(d)]
    return n, s, [[n * cells[min(a, b), max(a, b)] - s[a] * s[b] for b in range(d)] for a in range(d)]


def primes_below(limit: int) -> Iterator[int]:
    """Primes in falling order, by trial division with small primes and Miller-Rabin for 32 bits."""
    small = [2, 3, 5, 7]  # decides every number below 3,215,031,751

    def prime(p: int) -> bool:
        if any(p % q == 0 for q in (3, 5, 7, 11, 13)):
            return False
        r = ((p - 1) & -(p - 1)).bit_length() - 1
        for a in small:
            x = pow(a, (p - 1) >> r, p)
            if x in (1, p - 1):
                continue
            for _ in range(r - 1):
                x = x * x % p
                if x == p - 1:
                    break
            else:
                return False
        return True

    p = limit - 1 | 1
    while p > 13:
        if p < limit and prime(p):
            yield p
        p -= 2


def polynomial_mod(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(t - matrix) modulo p, lowest power first: similarity to Hessenberg form, then its recurrence."""
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(h)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        i = k + int(below[0])
        if i != k:
            h[[k, i]] = h[[i, k]]
            h[:, [k, i]] = h[:, [i, k]]
        factors = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factors[:, None] * h[k] % p) % p
        # Column operations one product at a time: a sum of products of 31 bits would overflow.
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factors % p).sum(axis=1)) % p
    minors = [np.zeros(d + 1, np.int64) for _ in range(d + 1)]
    minors[0][0] = 1
    for m in range(1, d + 1):
        new = np.roll(minors[m - 1], 1)
        new[0] = 0
        new = (new - h[m - 1, m - 1] * minors[m - 1] % p) % p
        chain = 1
        for i in range(m - 1, 0, -1):
            chain = chain * int(h[i, i - 1]) % p
            if not chain:
                break
            new = (new - int(h[i - 1, m - 1]) * chain % p * minors[i - 1] % p) % p
        minors[m] = new
    return [int(c) for c in minors[d]]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(t - matrix), lowest power first, of a positive semidefinite whole matrix: one prime per row, remaindered."""
    d, trace = len(matrix), sum(row[i] for i, row in enumerate(matrix))
    # The coefficients are sums of products of eigenvalues, at most binomial(d, k) * (trace / d)**k in size.
    bound = max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    primes, product = [], 1
    for p in primes_below(1 << 31):
        if product > 2 * bound:
            break
        primes.append(p)
        product *= p
    shared = spark.sparkContext.broadcast(matrix)  # d * d numbers

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("p").to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int64()), pa.array([polynomial_mod(shared.value, p)], pa.list_(pa.int64()))], names=["p", "c"]
                )

    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(-(-len(primes) // PRIMES_A_TASK))
    found = [0] * (d + 1)
    for p, residues in rows.mapInArrow(reduced, "p long, c array<long>").collect():  # as many rows as primes
        rest = product // p
        weight = rest * pow(rest, -1, p)
        found = [(c + r * weight) % product for c, r in zip(found, residues, strict=True)]
    shared.unpersist()
    return [c - product if 2 * c > product else c for c in found]


def roots_above(poly: list[int], at: int, bits: int) -> int:
    """How many roots, with multiplicity, exceed at / 2**bits, if all are real: sign changes of the shifted coefficients."""
    c = [v << bits * (len(poly) - 1 - i) for i, v in enumerate(poly)]  # of p(t / 2**bits), times a power of 2
    for low in range(len(c) - 1):
        for i in range(len(c) - 2, low - 1, -1):
            c[i] += at * c[i + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(poly: list[int], at: int, bits: int) -> int:
    value = 0
    for i, c in enumerate(reversed(poly)):
        value = value * at + (c << bits * i)
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], wanted: int, precision: int = PRECISION) -> list[tuple[int, int, int]]:
    """(r, bits, multiplicity): the largest positive roots r / 2**bits until `wanted` are found, of a polynomial with real roots only."""
    found: list[tuple[int, int, int]] = []
    top = 1 << max(1, (abs(poly[-2]).bit_length() if len(poly) > 1 else 1) + 1)  # beyond the sum of all roots
    positive = roots_above(poly, 0, 0)
    seen, high, bits = 0, top, 0
    while seen < min(wanted, positive):
        low, inside, stop = 0, positive - seen, bits + precision
        # (low, high] holds the largest root that is not found yet, `inside` roots in all, and none that was found before.
        while bits < stop:
            if inside == 1 and (not _sign(poly, high, bits) or _sign(poly, low, bits)):
                break
            if high - low == 1:
                low, high, bits = low << 1, high << 1, bits + 1
            middle = (low + high) >> 1
            above = roots_above(poly, middle, bits) - seen
            if above > 0:
                low, inside = middle, above
            else:
                high = middle
        sign = _sign(poly, high, bits)
        while inside == 1 and sign and bits < stop:
            if high - low == 1:
                low, high, bits = low << 1, high << 1, bits + 1
            middle = (low + high) >> 1
            at_middle = _sign(poly, middle, bits)
            if at_middle == sign:
                high = middle
            elif at_middle:
                low = middle
            else:  # the root itself
                high = middle
                break
        found.append((high, bits, inside))
        seen += inside
        # The next root is low at most. Bounds of few bits are dealt with faster: the first that parts it from those found.
        high, bits = next(((low >> bits - b, b) for b in range(0, bits, 16) if roots_above(poly, low >> bits - b, b) == seen), (low, bits))
    return found


def null_vectors(matrix: list[list[int]], root: tuple[int, int, int], digits: int = DIGITS) -> list[list[decimal.Decimal]]:
    """Unit vectors of the null space of matrix - root, as many as the root's multiplicity, by inverse iteration."""
    d, (r, bits, many) = len(matrix), root
    with decimal.localcontext() as context:
        context.prec, context.Emax, context.Emin = digits, decimal.MAX_EMAX, decimal.MIN_EMIN
        value = decimal.Decimal(r) / (decimal.Decimal(2) ** bits)
        a = [[decimal.Decimal(v) - (value if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
        scale = max(abs(v) for row in a for v in row) or decimal.Decimal(1)
        tiny = scale * decimal.Decimal(10) ** (5 - digits)
        order, lower = list(range(d)), [[decimal.Decimal(0)] * d for _ in range(d)]
        for k in range(d):
            best = max(range(k, d), key=lambda i: abs(a[i][k]))
            for rows in (a, lower, order):
                rows[k], rows[best] = rows[best], rows[k]
            if abs(a[k][k]) < tiny:
                a[k][k] = tiny  # the matrix is singular but for rounding
            for i in range(k + 1, d):
                if a[i][k]:
                    factor = a[i][k] / a[k][k]
                    lower[i][k] = factor
                    a[i] = [*a[i][: k + 1], *(x - factor * y for x, y in zip(a[i][k + 1 :], a[k][k + 1 :], strict=True))]

        def solved(v: list[decimal.Decimal]) -> list[decimal.Decimal]:
            y = [v[i] for i in order]
            for i in range(d):
                y[i] -= sum(lower[i][j] * y[j] for j in range(i))
            for i in reversed(range(d)):
                y[i] = (y[i] - sum(a[i][j] * y[j] for j in range(i + 1, d))) / a[i][i]
            return y

        found: list[list[decimal.Decimal]] = []

        def unit(v: list[decimal.Decimal]) -> list[decimal.Decimal]:
            for _ in range(2):
                for u in found:
                    part = sum(x * y for x, y in zip(u, v, strict=True))
                    v = [y - part * x for x, y in zip(u, v, strict=True)]
                size = sum(x * x for x in v).sqrt()
                v = [x / size for x in v]
            return v

        for k in range(many):
            # Start vectors in general position: powers of different numbers modulo a prime.
            v = unit([decimal.Decimal(pow(k + 2, i + 1, 10007) + 1) for i in range(d)])
            for _ in range(4):
                v = unit(solved(v))
            found.append(v if max(v, key=abs) > 0 else [-x for x in v])
        return found


def fitted(distinct: DataFrame, components: int = COMPONENTS) -> Fit:
    n, sums, matrix = scatter(distinct)
    trace = sum(row[i] for i, row in enumerate(matrix))
    if not trace:
        return Fit(n, sums, [], np.zeros((len(sums), 0)), [])
    poly = characteristic_polynomial(distinct.sparkSession, matrix)
    roots, vectors, explained = [], [], []
    for root in largest_roots(poly, components):
        value = root[0] / (1 << root[1])  # true division of whole numbers is rounded once
        for vector in null_vectors(matrix, root):
            roots.append(value)
            vectors.append([float(v) for v in vector])
            explained.append(root[0] / (trace << root[1]))
    return Fit(n, sums, roots[:components], np.array(vectors[:components]).T, explained[:components])


def projected(rows: DataFrame, fit: Fit) -> DataFrame:
    """(vec_id, deviation, whitened) of every row; whitened: one value per component."""
    n, sums, limit = fit.n, fit.sums, 10**38
    # The root of M is n * n times the variance, as (n * x - S) is n times the deviation: the factors n cancel.
    directions = fit.vectors / np.sqrt(np.array(fit.roots))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = np.array(sums, object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            most = n * max(int(x.max()), -int(x.min())) + max(map(abs, sums))
            # In 64 bits where the sum of squares fits, in whole numbers of any size elsewhere.
            away = n * x - s.astype(np.int64) if most * most * len(sums) < 1 << 63 else n * x.astype(object) - s
            squares = [decimal.Decimal(int(v)) if v < limit else None for v in (away * away).sum(axis=1)]
            white = away.astype(np.float64) @ directions
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(squares, pa.decimal128(38, 0)), pa.array(list(white))],
                names=["vec_id", "deviation", "whitened"],
            )

    return rows.mapInArrow(project, _WHITE)


def identity_error(distinct: DataFrame, fit: Fit) -> float:
    """Largest entry of the covariance of the whitened fit list, less the identity. `covar_pop` centres before it multiplies."""
    white, k = projected(distinct.select(F.lit(None).cast("long").alias("vec_id"), "x"), fit), len(fit.roots)
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    cells = [F.covar_pop(F.get("whitened", F.lit(a)), F.get("whitened", F.lit(b))) - float(a == b) for a, b in pairs]
    return max(white.agg(*[F.abs(c).alias(f"c{i}") for i, c in enumerate(cells)]).first())


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: see the module."""
    rows = stepped(vectors)
    distinct = written(rows.select("x").distinct(), "whitening-fit")
    fit = fitted(distinct, components)
    if fit.roots:
        rows, error = projected(rows, fit), identity_error(distinct, fit)
    else:
        rows, error = vectors.sparkSession.createDataFrame([], _WHITE), 0.0
    explained = F.array(*[F.lit(v) for v in fit.explained]).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("_at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
