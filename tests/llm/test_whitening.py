"""Whitening against numpy's dense solver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from prefloom.llm import whitening


def covariance(vectors):
    x = np.unique(np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000, axis=0)
    return x, np.cov((x - x.mean(0)).T, bias=True).reshape(x.shape[1], -1)


def test_pivots_count_eigenvalues_and_solve():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 30):
        for _ in range(20):
            a = rng.normal(size=(n, n)) * (rng.random((n, n)) < 0.5)
            a = a + a.T
            assert whitening.Factor(a + 1e-7 * np.eye(n)).above() == (np.linalg.eigvalsh(a + 1e-7 * np.eye(n)) > 0).sum()
            b = rng.normal(size=n)
            a += np.diag(rng.normal(size=n))
            assert np.allclose(a @ whitening.Factor(a).solve(b), b, atol=1e-6 * np.linalg.cond(a))
    assert whitening.Factor(np.array([[0.0, 1.0], [1.0, 0.0]])).above() == 1


@pytest.mark.parametrize("values", [
    np.linspace(1, 40, 40), 10.0 ** -np.arange(12), np.ones(20), [5, 5, 5, 3, 3, 1, 0, 0, 0], [1, 1 + 1e-9, 1 + 2e-9, 0.5, 0.25], [0, 0, 0], [7.0],
    [1, 1 - 1e-14, 1e-3, 1e-3, 1e-9], np.concatenate([np.full(30, 2.0), [9.0, 9.0]])])
def test_eigenpairs(values):
    values = np.sort(np.array(values, float))[::-1]
    q = np.linalg.qr(np.random.default_rng(len(values)).normal(size=(len(values), len(values))))[0]
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    got, vectors = whitening.leading_eigenpairs(v)
    want = np.linalg.eigvalsh(v)[::-1]
    real = int((values > 1e-13 * values.max(initial=0) * len(values)).sum())
    assert len(got) == min(16, real)
    assert np.allclose(got, want[:len(got)], atol=1e-13 * max(want.max(), 1e-300), rtol=0)
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)
    assert np.abs(v @ vectors - vectors * got).max(initial=0) <= 1e-12 * max(want.max(), 1e-300)


def test_rows_against_numpy(spark):
    rng = np.random.default_rng(2)
    good = (rng.normal(size=(300, 20)) * np.linspace(0.2, 2, 20)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(good)] + [(7, good[7]), (None, good[8]), (900, None), (901, []), (902, [None] * 20), (903, [float("nan")] + [0.0] * 19),
                                                    (904, [float("-inf")] * 20), (905, [0.0] * 20)]
    other = [(2000 + i, rng.normal(size=3).tolist()) for i in range(30)] + [(3000, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame([(k, v, 1, "c") for k, v in rows + other], "vec_id long, embedding array<float>, n int, component string")
    got = whitening.whiten(df, whitening.fit_whitening(df)).collect()
    for size, own in ((20, rows), (3, other)):
        own = [(k, v) for k, v in own if v is not None and len(v) == size and all(c is not None and np.isfinite(c) for c in v)]
        x, v = covariance([np.float32(v) for _, v in own])
        e, u = np.linalg.eigh(v)
        e, u = e[::-1], u[:, ::-1]
        keys = [k for k, _ in own]
        for k, vector in own:
            mine = np.floor(64 * np.float32(vector).astype(float)).astype(np.int64) + 1_000_000
            found = [r for r in got if r.vec_id == k]
            assert len(found) == min(16, size) * keys.count(k)
            for r in found:
                c = r.component - 1
                assert r.n == len(x) and r.deviation == sum((len(x) * int(a) - int(s)) ** 2 for a, s in zip(mine, x.sum(0)))
                assert abs(abs(r.whitened) - abs((mine - x.mean(0)) @ u[:, c]) / e[c] ** 0.5) < 1e-8
                assert abs(r.explained - e[c] / np.trace(v)) < 1e-10 and r.identity_error < 1e-9
    assert {r.vec_id for r in got} == {k for k, v in rows if k not in (900, 901, 902, 903, 904)} | {k for k, _ in other[:-1]}
    assert whitening.whiten(df.limit(0), whitening.fit_whitening(df.limit(0))).collect() == []


def test_huge_entries_and_low_rank(spark):
    df = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [1e6, 1.0])], "vec_id long, embedding array<double>")
    got = whitening.whiten(df, whitening.fit_whitening(df)).collect()
    assert [r.component for r in got] == [1, 1, 1] and all(np.isfinite(r.whitened) for r in got)
    assert {r.vec_id: r.deviation for r in got}[1] is None
