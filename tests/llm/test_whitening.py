"""Whitening against numpy's eigenvectors of the whole covariance."""

from __future__ import annotations

import numpy as np
import pytest

from tablesmith.llm import whitening as wt

SCHEMA = "vec_id long, embedding array<float>, n string, x int, component int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "n", 1, 2) for i, v in enumerate(vectors)], SCHEMA)


def result(spark, vectors, **settings):
    rows = wt.whole_vectors(table(spark, vectors))
    model = wt.fit(rows, wt.Settings(**settings))
    return model, wt.whitened(rows, model).collect()


def checked_against_numpy(model, rows, vectors):
    dims = max(len(v) for v in vectors)
    x = {i: np.floor(np.array([*v, *[0.0] * (dims - len(v))]) * 256) + 0 for i, v in enumerate(vectors)}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors_ = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(dims, dims))
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    k = len(model.eigenvalues)
    assert np.allclose(model.eigenvalues, values[:k], rtol=1e-10) and model.identity_error < 1e-9
    assert len(rows) == len(x) * k
    gaps = np.diff(values[: k + 1]) if dims > k else np.diff(np.append(values[:k], -1))
    for r in rows:
        assert r.n == n and r.deviation == int(((n * x[r.vec_id] - sums) ** 2).sum())
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9
        j = r.component - 1
        if abs(gaps[j]) > 1e-6 * values[0] and (j == 0 or abs(gaps[j - 1]) > 1e-6 * values[0]):
            expected = (x[r.vec_id] - sums / n) @ vectors_[:, j] / np.sqrt(values[j])
            assert abs(abs(r.whitened) - abs(expected)) < 1e-7


def test_random_vectors_with_copies(spark):
    draw = np.random.default_rng(5)
    vectors = (draw.standard_normal((300, 10)) * np.linspace(2, 0.3, 10)).astype(np.float32).tolist()
    vectors += [vectors[0]] * 150
    model, rows = result(spark, vectors)
    assert model.n == 300
    checked_against_numpy(model, rows, vectors)


def test_equal_eigenvalues(spark):
    # Plus and minus each axis: all eigenvalues are one number.
    vectors = [(np.eye(6)[i] * s).tolist() for i in range(6) for s in (1, -1)]
    model, rows = result(spark, vectors)
    assert len(model.eigenvalues) == 4
    checked_against_numpy(model, rows, vectors)
    # Twice the largest, then smaller ones.
    vectors = [(np.eye(5)[i] * s * w).tolist() for i, w in enumerate([2, 2, 1, 0.5, 0.5]) for s in (1, -1)]
    model, rows = result(spark, vectors, components=2)
    checked_against_numpy(model, rows, vectors)


def test_fewer_vectors_than_components(spark):
    vectors = [[1.0, 2.0, 3.0, 4.0, 5.0], [0.0, 1.0, 0.5, 2.0, 1.0], [1.0, 0.0, 0.0, 0.0, 7.0]]
    model, rows = result(spark, vectors)
    assert len(model.eigenvalues) == 2
    checked_against_numpy(model, rows, vectors)


def test_dropped_and_odd_rows(spark):
    whole = [[1.0, 2.0], [0.5, -0.0], [-1.0, 0.25]]
    odd = [None, [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0], [3e38, 0.0]]
    rows = wt.whole_vectors(table(spark, whole + odd))
    assert sorted(r.vec_id for r in rows.collect()) == [0, 1, 2]
    # An empty and a shorter vector count as ending in zeros.
    ragged = [[1.0, 2.0, 0.5], [], [0.5], [2.0, 1.0, -1.0]]
    model, found = result(spark, ragged)
    assert {r.vec_id for r in found} == {0, 1, 2, 3}
    checked_against_numpy(model, found, ragged)


def test_nothing_to_whiten(spark):
    for vectors in ([], [[1.0, 2.0]] * 5, [[], []]):
        model, rows = result(spark, vectors)
        assert rows == [] and len(model.eigenvalues) == 0


def test_deviation_beyond_a_long_fails():
    model = wt.Whitening(10, (0, 0), np.zeros((0, 2)), np.zeros(0), 0.0, 0.0)
    with pytest.raises(OverflowError):
        wt._deviations(np.array([[1 << 40, 1]]), model)
