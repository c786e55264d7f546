import numpy as np
import pytest
from pyspark.sql import functions as F

from prefloom.operators import losses as L, reward_head as H


@pytest.fixture(scope="module")
def noisy(spark):
    """Pairs drawn from a logistic preference model with known weights."""
    rng = np.random.default_rng(13)
    w = np.array([1.5, -2.0, 0.5])
    a, b = rng.normal(size=(4000, 3)), rng.normal(size=(4000, 3))
    wins = rng.random(4000) < 1 / (1 + np.exp(-(a - b) @ w))
    c, r = np.where(wins[:, None], a, b), np.where(wins[:, None], b, a)
    df = spark.createDataFrame([(x.tolist(), y.tolist()) for x, y in zip(c, r)], "chosen array<double>, rejected array<double>")
    return df.cache(), c - r, w


def mean_log_loss(w, d, margin=0.0):
    return np.logaddexp(0, -(d @ w - margin)).mean()


def test_logistic_recovers_the_weights(noisy):
    df, d, w = noisy
    got = H.head_weights(H.fit_logistic(df, "chosen", "rejected"))
    assert got == pytest.approx(w, abs=0.2)
    for i in range(3):
        assert all(mean_log_loss(got, d) <= mean_log_loss(got + s * np.eye(3)[i], d) for s in (-0.01, 0.01))


def test_log_sigmoid_with_margin_is_optimal(noisy):
    df, d, _ = noisy
    got = np.array(H.head_weights(H.fit_log_sigmoid(df, "chosen", "rejected", 0.5)))
    for i in range(3):
        assert all(mean_log_loss(got, d, 0.5) <= mean_log_loss(got + s * np.eye(3)[i], d, 0.5) for s in (-0.01, 0.01))


def test_hinge_scales_with_the_margin(noisy):
    df, d, _ = noisy
    for reg in (0.0, 0.1):
        model = H.fit_hinge(df, "chosen", "rejected", 0.5, reg=reg)
        got = np.array(H.head_weights(model, 0.5))
        loss = lambda w: np.maximum(0, 0.5 - d @ w).mean() + reg / 2 * w @ w
        for i in range(3):
            assert all(loss(got) <= loss(got + s * np.eye(3)[i]) + 1e-6 for s in (-0.02, 0.02))


def test_save_and_load(spark, noisy, tmp_path):
    df, _, _ = noisy
    fits = {"logistic": H.fit_logistic(df, "chosen", "rejected"), "hinge": H.fit_hinge(df, "chosen", "rejected", max_iter=5),
            "log_sigmoid": H.fit_log_sigmoid(df, "chosen", "rejected", 0.5)}
    for kind, model in fits.items():
        path = str(tmp_path / kind)
        H.save_head(model, path, {"margin": 0.5}, {"name": "m"}, spark)
        back, config, metadata = H.load_head(path, spark)
        assert config == {"margin": 0.5, "kind": kind} and metadata == {"name": "m"}
        assert H.head_weights(back) == H.head_weights(model)
    with pytest.raises(Exception):
        H.load_head(str(tmp_path / "absent"), spark)
    with pytest.raises(ValueError):
        H.save_head(object(), str(tmp_path / "x"), {}, {}, spark)


def test_scores(spark):
    df = spark.createDataFrame([("p", "a b", None)], "prompt string, x string, y string")
    size = lambda text: F.array(F.length(text).cast("double"))
    row = H.score_texts(df, size, [2.0], {"x": "rx", "y": "ry"}, bias=1.0).first()
    assert (row.rx, row.ry) == (11.0, 5.0)
    features = H.hash_texts(df, {"x": "fx", "y": "fy"}, size=16).first()
    assert sum(features.fx) == 2.0 and sum(features.fy) == 0.0 and len(features.fx) == 16
    scored = H.score_features(spark.createDataFrame([([1.0], [0.0])], "a array<double>, b array<double>"), [2.0],
                              {"a": "chosen_reward", "b": "rejected_reward"})
    assert H.mean_loss(scored, "hinge", 3.0).first()[0] == 1.0
    assert L.loss_metrics(scored, "hinge", 3.0).first().loss_value == 1.0


def test_a_score_is_not_copied_into_later_filters(spark):
    df = spark.createDataFrame([("p", "abc")], "prompt string, x string")
    scored = H.score_texts(df, lambda t: F.array(F.length(F.regexp_replace(t, "b", "")).cast("double")), [1.0], {"x": "r"})
    used = scored.withColumn("s", F.col("r") + F.abs("r")).where(F.col("s") > F.col("r") - 1)
    assert used._jdf.queryExecution().executedPlan().toString().count("regexp_replace") == 1


def test_whole_fits_equal_the_small_ones(noisy):
    df, d, _ = noisy
    fit = H.fit_differences(df, "chosen", "rejected", reg=1e-3)
    assert fit.weights == pytest.approx(H.head_weights(H.fit_logistic(df, "chosen", "rejected", reg=1e-3)), abs=1e-4)
    margin = H.fit_differences(df, "chosen", "rejected", margin=0.5)
    assert margin.weights == pytest.approx(H.head_weights(H.fit_log_sigmoid(df, "chosen", "rejected", 0.5)), abs=1e-4)


def test_hashed_words_and_stored_weights(spark, tmp_path):
    import hashlib

    df = spark.createDataFrame([("a bé a", None), ("", "x\ty")], "t string, u string")
    rows = H.hash_words(df, {"t": "ft", "u": "fu"}, 16).collect()
    bucket = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 16
    want = np.zeros(16)
    for w in ("a", "bé", "a"):
        want[bucket(w)] += 1
    assert rows[0].ft == want.tolist() and sum(rows[0].fu) == 0 == sum(rows[1].ft) and sum(rows[1].fu) == 2
    H.save_weights([0.5, -1.0], str(tmp_path / "w"), {"buckets": 2}, {"name": "x"}, spark)
    assert H.load_weights(str(tmp_path / "w"), spark) == ([0.5, -1.0], {"buckets": 2, "kind": "weights"}, {"name": "x"})
    with pytest.raises(Exception):
        H.load_weights(str(tmp_path / "absent"), spark)
