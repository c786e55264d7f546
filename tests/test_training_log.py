import random

import pytest
from pyspark.sql import functions as F

from prefloom.operators import training_log as G


def gaps(rng, runs=3, steps=120):
    """Runs with irregular steps; the first run holds most rows."""
    rows = []
    for run in range(runs):
        step, ts = 0, 1000.0
        for _ in range(steps if run == 0 else 12):
            step += rng.choice([1, 1, 2, 40])
            ts += rng.random() * 10
            rows.append((run, step, ts, rng.random()))
    return rows


def test_running_means_over_chunks(spark):
    rows = gaps(random.Random(6))
    df = spark.createDataFrame(rows, "run long, step long, ts double, loss double").repartition(5)
    want, sums = {}, {}
    for run, step, _, loss in rows:
        s, n = sums.get(run, (0.0, 0))
        sums[run] = (s + loss, n + 1)
        want[run, step] = (s + loss) / (n + 1)
    for chunk in (8, 100_000):
        got = {(r.run, r.step): r.running_loss for r in G.running_means(df, ["run"], ["loss"], chunk=chunk).collect()}
        assert got == pytest.approx(want)


def test_time_remaining_over_chunks(spark):
    rows = gaps(random.Random(7))
    df = spark.createDataFrame(rows, "run_id long, step long, ts_seconds double, x double").withColumn("total", F.lit(5000))
    want, last, took = {}, {}, {}
    for run, step, ts, _ in rows:
        if run in last:
            took.setdefault(run, []).append(ts - last[run])
        last[run] = ts
        recent = took.get(run, [])[-10:]
        want[run, step] = sum(recent) / len(recent) * (5000 - step) if recent else None
    for chunk in (4, 64, 100_000):
        got = {(r.run_id, r.step): r.seconds_remaining for r in G.time_remaining(df, chunk=chunk).collect()}
        assert set(got) == set(want)
        assert {k: v for k, v in got.items() if v is not None} == pytest.approx({k: v for k, v in want.items() if v is not None})
    none = G.time_remaining(df.withColumn("total", F.lit(0)))
    assert none.where("seconds_remaining is not null").count() == 0


def beta_walk(kls, beta, target):
    out = []
    for kl in kls:
        if kl > target * 1.5:
            beta = min(beta * 1.5, 0.5)
        elif kl < target / 1.5:
            beta = max(beta / 1.5, 1e-4)
        out.append(beta)
    return out


def test_adaptive_beta_fixture(spark):
    df = spark.createDataFrame([(1, i, k) for i, k in enumerate([0.05, 0.05, 0.001, 0.03])], "run_id long, step long, kl_divergence double")
    got = [r.beta_kl for r in G.adaptive_beta(df, 0.02, 0.03).orderBy("step").collect()]
    assert got == pytest.approx([0.03, 0.045, 0.03, 0.03])


def test_adaptive_beta_folds_like_a_loop(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for run in range(3):
        step, n = 0, 400 if run == 0 else 15
        # Long stretches drive the coefficient into both bounds.
        kls = [rng.choice([0.0, 0.03, 0.2]) if run else (0.2 if i // 60 % 2 else 0.0) for i in range(n)]
        kls[3] = float("nan")
        steps = []
        for kl in kls:
            step += rng.choice([1, 2, 9])
            steps.append(step)
            rows.append((run, step, kl))
        want |= {(run, s): b for s, b in zip(steps, beta_walk(kls, 0.9, 0.03))}
    df = spark.createDataFrame(rows, "run_id long, step long, kl_divergence double").repartition(4)
    for fold in (4, 64, 100_000):
        got = {(r.run_id, r.step): r.beta_kl for r in G.adaptive_beta(df, 0.9, 0.03, fold=fold).collect()}
        assert got == pytest.approx(want)


def test_summaries(spark):
    rows = [("r", 0, 1, "loss", 2.0, None), ("r", 0, 2, "loss", 4.0, None), ("r", 1, 3, "loss", 1.0, None),
            ("r", 0, 2, "accuracy", 0.5, None), ("r", 0, 1, "note", None, "a"), ("r", 0, 2, "note", None, "b"), ("r", 0, 3, "note", None, None)]
    df = spark.createDataFrame(rows, "run_id string, epoch int, step long, name string, num_value double, raw_value string")
    got = {(r.epoch, r.name): tuple(r)[3:] for r in G.metric_rollup(df, ["run_id", "epoch", "name"]).collect()}
    assert got[0, "loss"] == (3.0, 2.0, 4.0, 2, None) and got[0, "note"] == (None, None, None, 0, "b")
    row = G.run_summary(df).first()
    assert (row.total_epochs, row.overall_loss_mean, row.overall_loss_min, row.overall_loss_max) == (2, 2.0, 1.0, 3.0)
    assert row.overall_accuracy_mean == 0.5


def test_accuracy_reduction_progress(spark):
    df = spark.createDataFrame([(1, 3, 4), (1, 1, 4), (2, 0, 0)], "epoch int, correct long, total long")
    assert {r.epoch: r.accuracy for r in G.epoch_accuracy(df, ["epoch"]).collect()} == {1: 0.5, 2: 0.0}
    loss = spark.createDataFrame([("a", 1, 4.0), ("a", 9, 1.0), ("b", 1, 0.0), ("b", 2, 1.0)], "run_id string, step long, loss double")
    assert {r.run_id: r.loss_reduction for r in G.loss_reduction(loss).collect()} == {"a": 75.0, "b": 0.0}
    assert [spark.range(1).select(G.progress_percent(F.lit(c), F.lit(t))).first()[0] for c, t in ((1, 4), (1, 0))] == [25.0, 0.0]
    times = spark.createDataFrame([("a", 5.0), ("a", 7.5), ("b", 1.0)], "run_id string, ts_seconds double")
    assert sorted(r.elapsed for r in G.elapsed(times, ["run_id"]).collect()) == [0.0, 0.0, 2.5]


def test_curves(spark):
    df = spark.createDataFrame([("r", {"a": [1.0, 2.0, 3.0], "b": [5.0], "c": []})], "run_id string, history map<string,array<double>>")
    assert {r.metric: r.vals for r in G.padded_curves(df).collect()} == {"a": [1.0, 2.0, 3.0], "b": [5.0, 5.0, 5.0]}
    assert sorted((r.metric, r.x, r.y) for r in G.curve_points(df).collect()) == [("a", 0, 1.0), ("a", 1, 2.0), ("a", 2, 3.0), ("b", 0, 5.0)]


def test_history_average(spark):
    values = {c: [1.0, 3.0] for c in G.HISTORY_COLUMNS}
    df = spark.createDataFrame([("r", *v) for v in zip(*values.values())], ["run_id", *values])
    row = G.history_average(df).first()
    assert row.steps == 2 and row.policy_loss == 2.0 and row.grad_norm == 2.0


def test_epoch_summary(spark):
    df = spark.createDataFrame([(1, 1.0, 0.5), (1, 3.0, 1.0)], "epoch int, loss double, accuracy double")
    assert tuple(G.epoch_summary(df, ["epoch"]).first()) == (1, 2.0, 0.75, 75.0)
