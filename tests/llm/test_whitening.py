"""Whitening against numpy and exact fractions on small tables with odd rows."""

import collections
import math
from fractions import Fraction

import numpy as np
import pytest

from pagelens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, vector string, n long, component int, place int"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, "x", 1, 2, 3) for i, v in rows], schema).repartition(3)


def vectors(n, d, seed=3, scale=0.2):
    rng = np.random.default_rng(seed)
    return (rng.normal(0, scale, (n, d)) * np.linspace(1, 2, d)).astype("float32")


def compare(spark, rows, kept, most=32, schema=SCHEMA):
    """``kept`` are the rows that take part."""
    got = whitening.whiten(table(spark, rows, schema), most=most).selectExpr("*", "string(vec_id) AS key").toPandas()
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in kept], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = ((n * x - sums) / n).astype("float64")
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(most, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == n * k and set(got.n) == {n}
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    expected = collections.Counter((None if i is None else str(i), int(d)) for (i, _), d in zip(kept, deviation))
    first = got[got.component == 1]
    assert collections.Counter(zip(first.key, first.deviation)) == expected
    for c in range(1, k + 1):
        mine = got[got.component == c]
        assert np.allclose(mine.explained, values[c - 1] / values.sum(), rtol=1e-9)
        other = np.sort(centred @ basis[:, c - 1] / math.sqrt(values[c - 1]))
        white = np.sort(mine.whitened)
        assert min(np.abs(white - other).max(), np.abs(white - np.sort(-other)).max()) < 1e-6
    return got


def test_random_vectors(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(150, 12))]
    compare(spark, rows, rows)
    compare(spark, rows, rows, most=3)


def test_odd_rows(spark):
    good = [(i, v.tolist()) for i, v in enumerate(vectors(40, 4))]
    good += [(3, good[3][1]), (3, good[7][1]), (None, good[9][1]), (None, good[9][1]), (9007199254740993, good[1][1])]
    bad = [(50, None), (51, []), (52, [1.0, None, 0.0, 0.0]), (53, [float("nan")] * 4), (54, [0.0, float("inf"), 0.0, 0.0]),
           (55, [0.1] * 3), (56, [0.1] * 5), (57, [3e38, 0.0, 0.0, 0.0]), (None, None)]
    compare(spark, good + bad, good)


def test_dependent_components_and_large_values(spark):
    base = vectors(60, 5)
    base[:, 3] = base[:, 0]
    base[:, 4] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    assert set(compare(spark, rows, rows).component) == {1, 2, 3}
    wide = SCHEMA.replace("array<float>", "array<double>")
    rows = [(i, [float(c) * 2 ** 30 for c in v]) for i, v in enumerate(vectors(30, 3))]
    got = whitening.whiten(table(spark, rows, wide))
    found = {r.vec_id: r.deviation for r in got.collect()}
    x = np.array([[math.floor(64 * c) for c in v] for _, v in rows], object)
    exact = ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert found == {i: int(d) if d < 1 << 63 else None for i, d in enumerate(exact)}


def test_equal_eigenvalues(spark):
    """A cross: every direction has the same variance, so any orthonormal basis will do."""
    rows = [(2 * i + s, [(1.0 if s else -1.0) if j == i else 0.0 for j in range(4)]) for i in range(4) for s in range(2)]
    got = whitening.whiten(table(spark, rows)).toPandas()
    assert len(got) == 8 * 4 and got.identity_error.iloc[0] < 1e-12 and np.allclose(got.explained, 0.25)


def test_close_eigenvalues_are_told_apart():
    """Roots that differ in the 30th digit, and their vectors, which double precision cannot tell."""
    big = 10 ** 30
    matrix = np.array([[big, 1, 0], [1, big, 0], [0, 0, big // 3]], object)
    polynomial = [-(big * big - 1) * (big // 3), (big * big - 1) + 2 * big * (big // 3), -(2 * big + big // 3), 1]
    roots = whitening.largest_roots(polynomial, 3)
    assert [(r >> whitening.FRACTION, times) for r, times in roots] == [(big + 1, 1), (big - 1, 1), (big // 3, 1)]
    first = whitening.null_vectors(matrix, *roots[0])[0]
    assert np.allclose(np.abs(first), [math.sqrt(0.5), math.sqrt(0.5), 0], atol=1e-15) and first[0] * first[1] > 0


@pytest.mark.parametrize("d", [1, 2, 3, 7])
def test_characteristic_polynomial(spark, d):
    a = np.random.default_rng(d).integers(-9, 10, (d + 2, d)).astype(object)
    matrix = a.T @ a
    found = whitening.characteristic_polynomial(spark, matrix)
    assert found[-1] == 1 and found[d - 1] == -int(matrix.trace())
    for x in range(-2, 3):  # Against the determinant by elimination with fractions.
        rows = [[Fraction(int(x * (i == j) - matrix[i, j])) for j in range(d)] for i in range(d)]
        determinant = Fraction(1)
        for k in range(d):
            pivot = next((i for i in range(k, d) if rows[i][k]), None)
            if pivot is None:
                determinant = Fraction(0)
                break
            if pivot != k:
                rows[k], rows[pivot], determinant = rows[pivot], rows[k], -determinant
            determinant *= rows[k][k]
            for i in range(k + 1, d):
                factor = rows[i][k] / rows[k][k]
                rows[i] = [u - factor * v for u, v in zip(rows[i], rows[k])]
        assert determinant == whitening.value_at(found, x)


def test_no_variance_and_empty_tables(spark):
    assert whitening.whiten(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0])]).limit(0)).collect() == []
