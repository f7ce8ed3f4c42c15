"""Whitening against numpy's eigenvalues of the exact covariance."""

from fractions import Fraction

import numpy as np
import pytest

from panelspark.llm import whitening as W

TYPES = "vec_id long, embedding array<float>, deviation string"


def plain(vectors, scale=W.SCALE, offset=W.OFFSET):
    """(x, sums, covariance) with fractions."""
    x = [[int(np.floor(scale * float(c))) + offset for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    z = [[n * r[i] - sums[i] for i in range(d)] for r in x]
    v = [[float(Fraction(sum(r[i] * r[j] for r in z), n**3)) for j in range(d)] for i in range(d)]
    return x, sums, np.array(v)


@pytest.mark.parametrize("d, rank", [(1, 1), (2, 2), (7, 7), (8, 3), (40, 40), (33, 12)])
def test_eigenvalues_and_components(d, rank):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(rank, d)) * np.logspace(0, 3, rank)[:, None]
    v = a.T @ a
    factor, order = W.pivoted_cholesky(v)
    assert factor.shape == (d, rank) and np.allclose(np.triu(factor, 1), 0)
    assert np.allclose(factor @ factor.T, v[np.ix_(order, order)], rtol=1e-12, atol=1e-9)
    values, axes = W.principal(v)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:rank], rtol=1e-9)
    assert np.allclose(axes.T @ axes, np.eye(rank), atol=1e-13)
    assert np.allclose(v @ axes, axes * values, atol=1e-12 * values[0])


def test_no_variance():
    values, axes = W.principal(np.zeros((4, 4)))
    assert len(values) == 0 and axes.shape == (4, 0)


def check(rows, vectors, data):
    model = W.fit_whitening(rows)
    x, sums, v = plain(vectors)
    n, d = len(x), len(sums)
    values, axes = np.linalg.eigh(v)
    assert (model.n, list(model.sums)) == (n, sums)
    k = len(model.eigenvalues)
    assert k == min(32, np.linalg.matrix_rank(v, hermitian=True))
    assert np.allclose(model.eigenvalues, values[::-1][:k], rtol=1e-9)
    got = {}
    for r in W.by_component(W.whiten(rows, model), model).collect():
        got.setdefault((r.doc.vec_id, r.deviation), []).append(r)
    want = {}
    for (i, _), row in zip(data, x, strict=True):
        centred = np.array([float(Fraction(a * n - s, n)) for a, s in zip(row, sums, strict=True)])
        key = (i, sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)))
        want.setdefault(key, []).append(centred @ axes[:, ::-1][:, :k] / np.sqrt(values[::-1][:k]))
    assert set(got) == set(want)
    for key, expected in want.items():
        found = sorted(got[key], key=lambda r: r.component)
        assert [r.component for r in found] == sorted([*range(1, k + 1)] * len(expected))
        each = [r.whitened for r in found][:: len(expected)]
        assert np.allclose(np.abs(each), np.abs(expected[0]), atol=1e-6)
        assert np.allclose([r.explained for r in found][:: len(expected)], values[::-1][:k] / np.trace(v), rtol=1e-9)
        assert all(r.n == n for r in found)
    assert W.identity_error(rows, model) < 1e-9
    return model


def test_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(200, 40)).astype(np.float32) @ rng.normal(size=(40, 40)).astype(np.float32) + 3
    data = [(i, v) for i, v in enumerate(base.tolist())] + [(5, base[5].tolist()), (None, base[9].tolist())]
    odd = [(900, None), (901, []), (902, [None] + [1.0] * 39), (903, [float("nan")] * 40), (904, [float("inf")] + [1.0] * 39),
           (905, [1.0]), (906, [1e38] * 40)]
    rows = spark.createDataFrame([(i, v, "own") for i, v in data + odd], TYPES).repartition(5)
    model = check(rows, [v for _, v in data], data)
    assert W.whiten(rows, model).first().doc.deviation == "own"


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(4)
    data = [(i, v) for i, v in enumerate((rng.integers(-(2**40), 2**40, size=(20, 3))).astype(float).tolist())]
    rows = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    model = W.fit_whitening(rows)
    x, sums, v = plain([v for _, v in data])
    assert list(model.sums) == sums
    assert np.allclose(model.eigenvalues, np.linalg.eigvalsh(v)[::-1], rtol=1e-9)
    assert all(r.deviation is None for r in W.whiten(rows, model).collect())


@pytest.mark.parametrize("data", [[], [(1, [0.5, 0.25])], [(1, [0.5, 2.0]), (2, [0.5, 2.0])], [(1, None)]])
def test_nothing_to_whiten(spark, data):
    rows = spark.createDataFrame([(*r, "x") for r in data], TYPES)
    model = W.fit_whitening(rows)
    assert W.by_component(W.whiten(rows, model), model).count() == 0
    assert W.identity_error(rows, model) == 0


def test_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    data = [(r.vec_id, r.embedding) for r in rows.collect()]
    check(rows, [v for _, v in data], data)
