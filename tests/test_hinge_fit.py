import numpy as np
import pytest

from prefloom.operators import hinge_fit as H, reward_head


def rows_of(spark, d, parts=4):
    return spark.createDataFrame([(x.tolist(),) for x in d], "d array<double>").repartition(parts)


def primal(w, d, margin, reg):
    return reg / 2 * w @ w + np.maximum(0, margin - d @ w).mean()


@pytest.mark.parametrize("block_bytes,tol", [(1 << 20, 1e-5), (3200, 1e-3)])
def test_the_gap_certifies_the_fit(spark, block_bytes, tol):
    rng = np.random.default_rng(4)
    d = rng.normal(size=(300, 10)) + 0.3
    fit = H.fit_hinge_dual(rows_of(spark, d), "d", margin=0.5, reg=0.05, tol=tol, block_bytes=block_bytes)
    w = np.array(fit.weights)
    assert fit.rows == 300 and fit.blocks == 1 if block_bytes > 10_000 else 8 <= fit.blocks <= 16
    assert fit.primal == pytest.approx(primal(w, d, 0.5, 0.05), rel=1e-10)
    assert -1e-12 <= fit.gap <= tol
    for _ in range(200):  # no weights are better by more than the gap
        assert primal(w + rng.normal(size=10) * 0.02, d, 0.5, 0.05) >= fit.dual


def test_it_meets_the_smooth_solver(spark):
    d = np.random.default_rng(5).normal(size=(200, 4)) + 0.5
    df = spark.createDataFrame([(x.tolist(), [0.0] * 4) for x in d], "c array<double>, r array<double>")
    small = np.array(reward_head.head_weights(reward_head.fit_hinge(df, "c", "r", 0.5, reg=0.1, max_iter=15), 0.5))
    fit = H.fit_hinge_dual(df, "c", margin=0.5, reg=0.1, tol=1e-7)
    assert np.array(fit.weights) == pytest.approx(small, abs=5e-2) and fit.primal <= primal(small, d, 0.5, 0.1) + 1e-7


def test_more_features_than_the_margin_solver_takes(spark):
    rng = np.random.default_rng(6)
    d = (rng.random((40, 5000)) < 0.01).astype(float)
    fit = H.fit_hinge_dual(rows_of(spark, d), "d", margin=1.0, reg=0.1, tol=1e-4)
    assert len(fit.weights) == 5000 and fit.gap <= 1e-4


def test_odd_rows(spark):
    assert H.fit_hinge_dual(spark.createDataFrame([], "d array<double>"), "d") == H.HingeFit([], 0.0, 0.0, 0, 0, 0)
    some = spark.createDataFrame([([0.0, 0.0],), (None,), ([2.0, 0.0],), ([2.0, 0.0],)], "d array<double>")
    fit = H.fit_hinge_dual(some, "d", margin=1.0, reg=1e-3, tol=1e-8)
    assert fit.rows == 3 and fit.weights == pytest.approx([0.5, 0.0], abs=1e-3) and fit.primal == pytest.approx(1 / 3 + 1e-3 / 8, abs=1e-6)
    with pytest.raises(ValueError):
        H.fit_hinge_dual(some, "d", reg=0.0)
    with pytest.raises(ValueError):
        H.fit_hinge_dual(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "d array<double>"), "d")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("hinge_")]
