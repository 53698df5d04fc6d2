"""Whitening against a plain eigendecomposition, on vectors that are null, broken, equal, few or repeated."""

from fractions import Fraction

import numpy as np
import pytest

from gleanwork.llm import whitening


def random_vectors(seed, n, d, spread=None):
    random = np.random.default_rng(seed)
    turn = np.linalg.qr(random.standard_normal((d, d)))[0]
    return random.standard_normal((n, d)) * (np.linspace(1, 0.05, d) if spread is None else np.array(spread)) @ turn


def table(spark, vectors, extra=()):
    rows = [(i, [float(c) for c in v], i) for i, v in enumerate(vectors)] + list(extra)
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, whitened bigint")


def plain(vectors):
    """(whole numbers, n, sums, eigenvalues falling, eigenvectors, trace) by exact means and a dense solver."""
    x = np.floor(np.array(vectors) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    y = np.array([[float(Fraction(int(v)) - Fraction(s, n)) for v, s in zip(row, sums, strict=True)] for row in x])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    return x, y, sums, values[::-1], vectors[:, ::-1], np.trace(y.T @ y / n)


def test_components_equal_a_dense_eigensolver(spark):
    vectors = random_vectors(1, 120, 12)
    broken = [(1000, None, 0), (1001, [1.0] * 11 + [float("nan")], 0), (1002, [1.0] * 11 + [float("inf")], 0), (1003, [1.0] * 11 + [None], 0), (1004, [2.0] * 5, 0), (1005, [], 0)]
    got = whitening.whitened_components(table(spark, vectors, broken), vector="embedding").collect()
    x, y, sums, values, units, trace = plain(vectors)
    assert len(got) == 120 * 8
    byrow = {(r["vec_id"], r["component"]): r for r in got}
    assert {r["vec_id"] for r in got} == set(range(120)) and {r["n"] for r in got} == {120}
    for k in range(8):
        want = y @ units[:, k] / np.sqrt(values[k])
        have = np.array([byrow[i, k + 1]["whitened"] for i in range(120)])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-10
        assert byrow[0, k + 1]["explained"] == pytest.approx(values[k] / trace, rel=1e-12)
    for i in range(120):
        assert byrow[i, 1]["deviation"] == sum((120 * int(v) - s) ** 2 for v, s in zip(x[i], sums, strict=True))
    assert all(r["identity_error"] < 1e-12 for r in got)


@pytest.mark.parametrize(
    "values",
    [
        [1.0] * 20, [1, 1, 1, 1, 1, 1, 0.5, 0.5, 0.5, 0.5], [3, 3 - 1e-9, 3 - 2e-9, 1, 1, 1e-3, 1e-3, 1e-9, 1e-9, 1e-14],
        [1], [2, 1], [1, 0, 0, 0], [0.9**k for k in range(64)], [0.99**k for k in range(64)], [10.0**-k for k in range(16)],
        [1000] + [1 + k * 1e-4 for k in range(30)], [1 - 1e-7 * k for k in range(40)],
    ],
)
def test_intervals_miss_no_eigenvalue(spark, values):
    d = len(values)
    turn = np.linalg.qr(np.random.default_rng(3).standard_normal((d, d)))[0]
    matrix = turn * np.array(values, float) @ turn.T
    matrix = (matrix + matrix.T) / 2
    want = np.linalg.eigvalsh(matrix)[::-1]
    got, vectors = whitening.largest_components(spark, matrix, 8)
    some = min(8, int((want > whitening.NO_VARIANCE * want.sum()).sum()))
    assert len(got) == some
    assert np.abs(got - want[:some]).max() < 1e-13 * want.sum()
    assert np.abs(vectors.T @ vectors - np.eye(some)).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * got, axis=0).max() < 1e-12 * want.sum()


def test_inertia_counts_equal_the_spectrum():
    random = np.random.default_rng(5)
    for d in (1, 2, 3, 17):
        matrix = random.standard_normal((d, d))
        matrix = matrix + matrix.T
        spectrum = np.linalg.eigvalsh(matrix)
        form = whitening.tridiagonal(matrix)
        for shift in [-100, 0, *(spectrum + 1e-9), *(spectrum - 1e-9), 100]:
            assert whitening.count_above(form, shift) == (spectrum > shift).sum()


def test_projection_keeps_what_lies_inside():
    values = np.array([5, 4.5, 4.4, 1, 0.5, 0.1])
    turn = np.linalg.qr(np.random.default_rng(2).standard_normal((6, 6)))[0]
    matrix = turn * values @ turn.T
    share = turn.T @ whitening.project(matrix, 4.0, 6.0, turn)
    assert np.abs(np.diag(share)[:3] - 1).max() < 0.05 and np.abs(np.diag(share)[3:]).max() < 1e-4
    with pytest.raises(ArithmeticError):
        whitening.solve_interval(matrix, 4.0, 6.0, 2)


def test_an_interval_with_a_wrong_count_is_noticed(spark, monkeypatch):
    monkeypatch.setattr(whitening, "solve_interval", lambda m, low, high, count: (np.empty(0), np.empty((len(m), 0))))
    monkeypatch.setattr(whitening, "_solved", lambda m: lambda batches: iter(()))
    with pytest.raises(ArithmeticError, match="missing"):
        whitening.largest_components(spark, np.diag([3.0, 2.0, 1.0]), 2)


def test_few_equal_and_repeated_vectors(spark):
    one = [0.25, 0.5, -0.125]
    assert whitening.whitened_components(table(spark, []), vector="embedding").isEmpty()
    assert whitening.whitened_components(table(spark, [one]), vector="embedding").isEmpty()
    assert whitening.whitened_components(table(spark, [one, one, one]), vector="embedding").isEmpty()
    assert whitening.whitened_components(table(spark, [], [(1, None, 0), (2, [], 0)]), vector="embedding").isEmpty()
    pair = whitening.whitened_components(table(spark, [one, [0.5, 0.5, 0.5]], [(None, [0.5] * 3, 0), (1, [0.5] * 3, 0)]), vector="embedding").collect()
    assert [r["component"] for r in pair] == [1] * 4 and {r["n"] for r in pair} == {4}
    assert sorted(r["vec_id"] for r in pair if r["vec_id"] is not None) == [0, 1, 1]
    assert pair[0]["identity_error"] < 1e-12 and pair[0]["explained"] == pytest.approx(1)


def test_large_entries_and_deviations_beyond_a_long(spark):
    got = whitening.whitened_components(table(spark, [[1e300, 0.0], [-1e300, 0.0], [0.0, 1.0]]), vector="embedding").collect()
    assert {r["vec_id"]: r["deviation"] for r in got} == {0: None, 1: None, 2: 2048 * 2048} and all(np.isfinite(r["whitened"]) for r in got)


def test_float_entries_are_scaled_as_doubles(spark):
    rows = table(spark, random_vectors(9, 50, 5)).selectExpr("vec_id", "cast(embedding as array<float>) AS embedding")
    got = {(r["vec_id"], r["component"]): r["whitened"] for r in whitening.whitened_components(rows, vector="embedding").collect()}
    _, y, _, values, units, _ = plain([r["embedding"] for r in rows.orderBy("vec_id").collect()])
    for k in range(5):
        want = y @ units[:, k] / np.sqrt(values[k])
        have = np.array([got[i, k + 1] for i in range(50)])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-10
