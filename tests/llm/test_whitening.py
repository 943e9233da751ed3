"""Whitening against exact fractions and double-precision numpy, clustered eigenvalues included."""

import math
from fractions import Fraction

import numpy as np
import pytest

from bantin.llm import whitening as W


def integers(vectors):
    return [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]


def brute(vectors, components=16):
    """n, sums, falling eigenvalues, trace and vectors of the distinct integer vectors."""
    fit = sorted({tuple(x) for x in integers(vectors)})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    z = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(x, sums)] for x in fit])
    v = z.T @ z / n
    values, vectors_ = np.linalg.eigh(v)
    return n, sums, values[::-1][:components], np.trace(v), vectors_[:, ::-1][:, :components]


def test_like_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 20)) * np.linspace(0.2, 2, 20)).astype(np.float32)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)] + [(1000, vectors[5].tolist(), "y"), (1001, vectors[5].tolist(), "z")]
    found = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string").repartition(6)).collect()
    n, sums, values, trace, basis = brute(vectors)
    assert len(found) == 302 * 16 and {r.n for r in found} == {n}
    got = {(r.vec_id, r.component): r for r in found}
    for i, x in enumerate(integers(vectors)):
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        assert {int(got[i, c].deviation) for c in range(1, 17)} == {deviation}
    x = np.array(integers(vectors), float) - np.array(sums) / n
    for c in range(16):
        want = x @ basis[:, c] / math.sqrt(values[c])
        have = np.array([got[i, c + 1].whitened for i in range(300)])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-9
        assert abs(got[0, c + 1].explained / (values[c] / trace) - 1) < 1e-10
        assert got[1000, c + 1].whitened == got[1001, c + 1].whitened == got[5, c + 1].whitened
    assert 0 <= found[0].identity_error < 1e-10


def exact_residual(a, values, x):
    """Largest entry of A x - x diag(values), in fractions."""
    f = np.vectorize(lambda v: Fraction(float(v)) + Fraction(float(v - type(v)(float(v)))), otypes=[object])
    a, x, values = f(a), f(x), f(values)
    return float(np.abs(a @ x - x * values[None, :]).max()), float(np.abs(x.T @ x - np.eye(len(a), dtype=int)).max())


@pytest.mark.parametrize("gaps", [[1e-1] * 7, [1e-6] * 7, [1e-9, 1e-9, 0.3, 1e-12, 0.2, 1e-3, 1e-13], [0, 0, 0.5, 1e-8, 0, 0.1, 0.1]])
def test_clustered_eigenvalues_are_told_apart(gaps):
    rng = np.random.default_rng(1)
    wanted = np.cumsum([1.0, *gaps]).astype(np.longdouble)
    q = np.linalg.qr(rng.normal(size=(8, 8)))[0].astype(np.longdouble)
    for _ in range(3):  # orthogonal beyond double precision
        q = q + q @ (np.eye(8) - q.T @ q) / 2
    a = (q * wanted[None, :]) @ q.T
    values, x = W.eigenvectors((a + a.T) / 2)
    residual, turned = exact_residual((a + a.T) / 2, values, x)
    assert residual < 1e-17 and turned < 1e-17
    assert np.abs(values[::-1] - wanted).max() < 1e-17
    for k in range(8):
        alone = (k == 0 or gaps[k - 1] >= 1e-9) and (k == 7 or gaps[k] >= 1e-9)
        if alone:  # the vector itself is right, not only its space
            assert 1 - abs(float(x[:, 7 - k] @ q[:, k])) < 1e-15


def test_odd_rows(spark, rows):
    schema = "vec_id long, embedding array<double>, x long, i int"
    good = [(1, [0.5, 0.25], 0, 0), (2, [0.5, 0.75], 0, 0), (2, [0.5, 0.75], 0, 0), (None, [1.5, 0.25], 0, 0), (7, [-3.0, 9.0], None, None)]
    odd = [(3, None, 1, 1), (4, [None, 1.0], 1, 1), (5, [float("nan"), 1.0], 1, 1), (6, [float("inf"), 1.0], 1, 1), (8, [], 1, 1), (9, [1.0], 1, 1)]
    found = W.whiten(spark.createDataFrame(good + odd, schema))
    assert sorted((r.vec_id or -1, r.component) for r in found.collect()) == sorted((i, c) for i in (1, 2, 2, -1, 7) for c in (1, 2))
    assert {r.n for r in found.collect()} == {4}


def test_no_variance_gives_no_components(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        assert W.whiten(spark.createDataFrame(rows, schema)).collect() == []
    line = W.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(5)], schema)).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12


def test_squares_beyond_64_bits():
    assert W._squares(np.array([[3 << 40, 5]])) == [(3 << 40) ** 2 + 25]
    z = np.array([[1 << 30, 3], [-(1 << 30), 1]])
    assert W._exact_products(z)[0, 0] == 1 << 61 and W._exact_products(z)[0, 1] == 1 << 31
