from fractions import Fraction

import numpy as np
import pytest

from paperloom.llm.whitening import (
    characteristic_polynomial, exact_products, is_prime, largest_roots, polynomial_modulo, primes_for, roots_above, whiten,
)


def leverrier(matrix):
    """Characteristic polynomial by traces of exact products, constant term first."""
    dim = len(matrix)
    a = [[Fraction(v) for v in row] for row in matrix]
    m = [[Fraction(0)] * dim for _ in range(dim)]
    coefficients = [Fraction(1)]
    for k in range(1, dim + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(dim)) + (coefficients[-1] if i == j else 0) for j in range(dim)] for i in range(dim)]
        product = [[sum(a[i][t] * m[t][j] for t in range(dim)) for j in range(dim)] for i in range(dim)]
        coefficients.append(-sum(product[i][i] for i in range(dim)) / k)
    return [int(c) for c in reversed(coefficients)]


def semidefinite(dim, rank, seed=0, size=50):
    b = np.random.default_rng(seed).integers(-size, size, (dim, rank)).astype(object)
    return [[int(v) for v in row] for row in b @ b.T]


@pytest.mark.parametrize("dim,rank", [(1, 1), (2, 2), (7, 7), (7, 3), (12, 12), (5, 0)])
def test_polynomial_is_exact(spark, dim, rank):
    matrix = semidefinite(dim, rank) if rank else [[0] * dim for _ in range(dim)]
    assert characteristic_polynomial(spark, matrix) == leverrier(matrix)


def test_hessenberg_needs_pivots():
    matrix = [[2, 0, 0, 1], [0, 3, 0, 0], [0, 0, 2, 0], [1, 0, 0, 2]]
    p = primes_for(10)[0]
    assert polynomial_modulo(matrix, p) == [c % p for c in leverrier(matrix)]


def test_roots_are_counted_and_located():
    poly = [0, 0, -6, 11, -6, 1]  # x^2 (x-1)(x-2)(x-3)
    assert [roots_above(poly, x) for x in (-1, 0, 1, 2, 3)] == [5, 3, 2, 1, 0]
    double = leverrier([[4, 0, 0], [0, 4, 0], [0, 0, 1]])
    found, places = largest_roots(double, 3)
    assert [(r / 2**places, n) for r, n in found] == [(4.0, 2), (1.0, 1)]
    assert is_prime(2147483647) and not is_prime(2147483645)


def test_sums_of_large_entries_stay_exact():
    rows = np.array([[1, 2**61], [3, -(2**61)], [5, 7]], "int64")
    wide = rows.astype(object)
    assert (exact_products(rows) == wide.T @ wide).all()


def check(found, vectors, limit=32):
    x = np.floor(64 * np.asarray(vectors, "float64")) + 1_000_000
    n, dim = x.shape
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    got = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    wanted = centred @ axes[:, : got.shape[1]] / np.sqrt(values[: got.shape[1]])
    np.testing.assert_allclose(np.abs(got), np.abs(wanted), atol=1e-8)
    first = found.drop_duplicates("component").sort_values("component")
    np.testing.assert_allclose(first["explained"], values[: got.shape[1]] / values.sum(), rtol=1e-9)
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, x.sum(axis=0).astype(int).tolist())) for row in x]
    assert found.drop_duplicates("vec_id")["deviation"].tolist() == exact
    assert (found["identity_error"] < 1e-9).all() and (found["n"] == n).all()


def test_whitening_equals_plain_eigenvectors(spark):
    vectors = np.random.default_rng(3).normal(size=(300, 40)) @ np.diag(np.linspace(0.2, 3, 40))
    rows = spark.createDataFrame([(i, v.tolist(), 1.0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, v double")
    found = whiten(rows).toPandas().sort_values(["vec_id", "component"])
    assert found["component"].max() == 32
    check(found, vectors)


def test_equal_eigenvalues_and_missing_rank(spark):
    # a square in two dimensions, a third one that never changes, a fourth that follows the first
    corners = [(a, b, 5.0, a) for a in (-1.0, 1.0) for b in (-np.sqrt(2) * 1.0, np.sqrt(2) * 1.0)]
    rows = spark.createDataFrame([(i, list(map(float, c))) for i, c in enumerate(corners)], "vec_id long, embedding array<double>")
    found = whiten(rows).toPandas()
    assert found["component"].max() == 2 and (found["identity_error"] < 1e-9).all()
    same = spark.createDataFrame([(i, [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(4)], "vec_id long, embedding array<double>")
    assert whiten(same).toPandas()["component"].tolist() == [1] * 4
    square = spark.createDataFrame([(i, [float(i & 1), float(i >> 1)]) for i in range(4)], "vec_id long, embedding array<double>")
    found = whiten(square).toPandas()
    assert found["component"].max() == 2 and np.allclose(found["explained"], 0.5) and (found["identity_error"] < 1e-12).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    schema = "vec_id long, embedding array<double>, n int, component string, whitened int"
    held = [[1.0, 2.0], [2.0, 2.5], [0.5, -1.0], [0.5, -1.0]]
    odd = [None, [], [1.0, None], [nan, 1.0], [inf, 0.0]]
    rows = [(i, v, 7, "c", 3) for i, v in enumerate(held)] + [(90, v, 7, "c", 3) for v in odd]
    rows += [(None, [1.5, 0.0], 7, "c", 3), (50, [1.0, 2.0, 3.0], 7, "c", 3), (51, [1e300, 0.0, -1e300], 7, "c", 3)]
    found = whiten(spark.createDataFrame(rows, schema)).toPandas()
    two = found[found["n"] == 5]
    assert len(two) == 10 and two["vec_id"].isna().sum() == 2 and two["component"].max() == 2
    three = found[found["n"] == 2]
    assert three["vec_id"].tolist() == [50, 51] and three["deviation"].isna().all()
    assert whiten(spark.createDataFrame(rows[:1], schema)).count() == 0
    assert whiten(spark.createDataFrame([], schema)).count() == 0
