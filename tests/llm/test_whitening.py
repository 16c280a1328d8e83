"""Whitening against numpy and exact small cases."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tallyloom.llm import whitening as w


def _moments(x):
    return len(x), [int(c) for c in x.sum(0)], [[int(c) for c in row] for row in x.T @ x]


def _polynomial(matrix):
    """det(t - A) over rationals, by the traces of powers."""
    d, out, m = len(matrix), [Fraction(1)], [[Fraction(0)] * len(matrix) for _ in matrix]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][l] * (m[l][j] + (out[-1] if l == j else 0)) for l in range(d)) for j in range(d)] for i in range(d)]
        out.append(-Fraction(sum(m[i][i] for i in range(d)), k))
    return [int(c) for c in reversed(out)]


MATRICES = {
    "random": w.scatter(*_moments(np.random.RandomState(3).randint(-90, 90, (40, 6)))),
    "rank 2": w.scatter(*_moments(np.random.RandomState(4).randint(-9, 9, (3, 5)))),
    "zero": [[0] * 3 for _ in range(3)],
    "equal roots": [[5, 0, 0, 0], [0, 5, 0, 0], [0, 0, 2, 0], [0, 0, 0, 2]],
    "close roots": [[10**12, 0, 1], [0, 10**12 + 1, 0], [1, 0, 10**12 + 3]],
    "late pivots": [[2, 0, 0, 1], [0, 3, 1, 0], [0, 1, 3, 0], [1, 0, 0, 2]],
    "one": [[7]],
}


@pytest.mark.parametrize("name", MATRICES)
def test_polynomial_roots_and_components_are_exact(spark, name):
    a = MATRICES[name]
    f = w.characteristic_polynomial(spark, a)
    assert f == _polynomial(a)
    values, vectors = w.eigen(spark, a, 32)
    want = [e for e in np.linalg.eigvalsh(np.array(a, float))[::-1] if e > 1e-6]
    np.testing.assert_allclose([float(v) for v in values], want, rtol=1e-12)
    if len(values):
        np.testing.assert_allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-14)
        residue = np.array(a, float) @ vectors.T - vectors.T * [float(v) for v in values]
        assert np.abs(residue).max() <= 1e-14 * max(1, np.abs(a).max())


def test_repeated_roots_come_apart_by_multiplicity():
    f = [1]
    for root, times in ((3, 1), (5, 2), (8, 3)):
        for _ in range(times):
            f = [a - root * b for a, b in zip([0, *f], [*f, 0], strict=True)]
    found = {}
    for part, k in w.square_free_parts([0, 0, *f]):
        for low, high, b in w.isolated_roots(part):
            a, at = w.refined(part, low, high, b, 64)
            found[round(a / 2**at)] = k
    assert found == {3: 1, 5: 2, 8: 3}


def test_sums_of_products_are_exact_at_any_size():
    r = np.random.RandomState(5)
    for top in (3, 1 << 20, 1 << 40, (1 << 62) + 5):
        y = np.array([[r.randint(-1000, 1000) * (top // 1000 + 1) + j for j in range(3)] for _ in range(70)], object)
        y = np.clip(y, -(2**62), 2**62).astype(np.int64)
        want = y.astype(object).T @ y.astype(object)
        assert (w._products(y) == want).all()
        cells = {}
        for cell, limb, part in w._limbs(4, int(want[0, 1])):
            cells[limb] = part
        assert sum(p << (30 * k) for k, p in cells.items()) == want[0, 1]


def _brute(rows):
    """(deviation, covariance of x) of plain lists."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    return [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x], np.cov(np.array(x, float).T, bias=True)


def test_query_columns_equal_brute_force(spark):
    r = np.random.RandomState(6)
    vectors = [[float(np.float32(c)) for c in r.randn(5) * [1, 3, 0.2, 1, 0]] for _ in range(60)]
    vectors += vectors[:4]
    bad = [None, [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0]]
    rows = [(i if i % 7 else None, v, "mine", i) for i, v in enumerate(vectors + bad)]
    df = spark.createDataFrame(rows, "vec_id long, v array<float>, whitened string, `a.b` int").repartition(3)
    model = w.fit(df, "v")
    out = w.components(df, model, "v", ["vec_id", "a.b"]).collect()
    assert len(out) == 64 * 4  # one direction has no variance
    deviations, covariance = _brute(vectors)
    assert {(x["a.b"], x["deviation"]) for x in out} == set(enumerate(deviations))
    got = np.zeros((64, 4))
    for x in out:
        got[x["a.b"], x["component"] - 1] = x["whitened"]
    np.testing.assert_allclose(np.cov(got.T, bias=True), np.eye(4), atol=1e-11)
    values = np.linalg.eigvalsh(covariance)[::-1][:4]
    np.testing.assert_allclose(model.eigenvalues, values, rtol=1e-12)
    share = {x["component"]: x["explained"] for x in out}
    np.testing.assert_allclose([share[k] for k in (1, 2, 3, 4)], values / np.trace(covariance), rtol=1e-12)
    assert {x["n"] for x in out} == {64} and max(x["identity_error"] for x in out) < 1e-10
    assert len({x["identity_error"] for x in out}) == 1


def test_odd_tables(spark):
    kind = "vec_id long, v array<double>"
    for rows in ([], [(1, None)], [(1, [2.5, 1.0])], [(1, [2.5]), (2, [2.5])], [(1, []), (2, [])]):
        df = spark.createDataFrame(rows, kind)
        assert w.components(df, w.fit(df, "v"), "v", ["vec_id"]).collect() == []
    uneven = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, [])], kind)
    assert w.fit(uneven, "v").n == 3
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], kind)
    model = w.fit(huge, "v")
    got = w.components(huge, model, "v", ["vec_id"]).collect()
    assert len(got) == 6 and got[0]["identity_error"] < 1e-4
    assert {x["deviation"] for x in got if x["vec_id"] == 1} == {None}  # doesn't fit a long
    clash = spark.createDataFrame([(1, [1.0, 2.0], 7), (2, [2.0, 0.5], 8)], "vec_id long, v array<double>, Deviation int")
    whitened = w.whiten(clash, w.fit(clash, "v"), "v")
    assert whitened.columns == ["vec_id", "v", "deviation", "whitened"]
