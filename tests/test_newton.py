import numpy as np
import pytest

from prefloom.operators import newton as N


def rows_of(spark, d, parts=5):
    return spark.createDataFrame([(x.tolist(),) for x in d], "d array<double>").repartition(parts)


def objective(w, d, margin, reg):
    return np.logaddexp(0, margin - d @ w).mean() + reg / 2 * w @ w


@pytest.mark.parametrize("margin,reg", [(0.0, 0.0), (0.5, 1e-3), (2.0, 0.1)])
def test_the_gradient_vanishes_at_the_fit(spark, margin, reg):
    rng = np.random.default_rng(3)
    d = rng.normal(size=(900, 30)) * np.linspace(0.1, 3, 30)
    fit = N.fit_newton(rows_of(spark, d), "d", margin, reg)
    w = np.array(fit.weights)
    pull = 1 / (1 + np.exp(d @ w - margin))
    assert np.linalg.norm(reg * w - (pull[:, None] * d).mean(0)) < 1e-9
    assert fit.rows == 900 and fit.passes < 20 and fit.gradient_norm < 1e-9
    assert fit.objective == pytest.approx(objective(w, d, margin, reg), rel=1e-12)
    for _ in range(10):
        assert objective(w + rng.normal(size=30) * 0.01, d, margin, reg) > fit.objective


def test_separable_pairs_need_a_penalty(spark):
    d = np.abs(np.random.default_rng(1).normal(size=(50, 2)))
    free = N.fit_newton(rows_of(spark, d), "d", max_passes=12)
    assert free.passes == 12 and free.gradient_norm > 1e-10 and min(d @ np.array(free.weights)) > 1
    assert N.fit_newton(rows_of(spark, d), "d", reg=1e-3).gradient_norm < 1e-10


def test_odd_rows(spark):
    empty = spark.createDataFrame([], "d array<double>")
    assert N.fit_newton(empty, "d") == N.NewtonFit([], 0.0, 0.0, 0, 0)
    some = spark.createDataFrame([([1.0, 0.0],), (None,), ([1.0, 0.0],), ([-1.0, 0.0],)], "d array<double>")
    fit = N.fit_newton(some, "d")
    assert fit.rows == 3 and fit.weights == pytest.approx([np.log(2), 0.0], abs=1e-9)  # an idle feature gets no weight
    with pytest.raises(ValueError):
        N.fit_newton(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "d array<double>"), "d")


def test_sums_are_folded_from_many_parts(spark, monkeypatch):
    d = np.random.default_rng(2).normal(size=(500, 3))
    parts = N.partial_sums(rows_of(spark, d, 150), "d", lambda m: m.sum(0))
    assert 100 < parts.count() <= 150 and np.allclose(N.folded(parts, 150, 3), d.sum(0))
    monkeypatch.setattr(N, "DRIVER_BYTES", 100)  # two levels
    assert np.allclose(N.folded(parts, 150, 3), d.sum(0))
    assert N.folded(parts.limit(0), 150, 3) is None
