import numpy as np
import pytest
from pyspark.sql import functions as F

from prefloom.functions import numeric as N
from prefloom.operators import rollouts as R


def log_softmax(x):
    x = np.asarray(x, float)
    return x - x.max() - np.log(np.exp(x - x.max()).sum())


def test_token_statistics(spark):
    rng = np.random.default_rng(9)
    lens, rows, want = {0: 5, 1: 1, 2: 0}, [], {}
    for rid, n in lens.items():
        lp = [rng.normal(size=6) * 200 for _ in range(n)]
        lq = [rng.normal(size=6) * 3 for _ in range(n)]
        ids = rng.integers(0, 6, n).tolist()
        rows += [(rid, i, ids[i], lp[i].tolist(), lq[i].tolist()) for i in range(n)]
        p, q = [log_softmax(x) for x in lp], [log_softmax(x) for x in lq]
        want[rid] = (0.0, 0.0, 0.0) if not n else (
            np.mean([p[i][ids[i]] for i in range(n)]),
            np.mean([(np.exp(p[i]) * (p[i] - q[i])).sum() for i in range(n)]),
            np.mean([-(np.exp(p[i]) * p[i]).sum() for i in range(n)]))
    schema = "rollout_id long, pos int, token_id int, logits array<double>"
    policy = spark.createDataFrame([r[:4] for r in rows], schema)
    reference = spark.createDataFrame([(*r[:3], r[4]) for r in rows], schema)
    base = spark.createDataFrame([(i,) for i in lens], "rollout_id long")
    out = R.with_token_statistics(base, R.align_distributions(policy, reference))
    for r in out.collect():
        assert (r.logprob, r.kl, r.entropy) == pytest.approx(want[r.rollout_id], abs=1e-9)
    assert R.mean_entropy(out).first()[0] == pytest.approx(np.mean([w[2] for w in want.values()]))


def buffer(spark, n=40):
    rng = np.random.default_rng(10)
    cols = ["reward", "kl", "value", "value_new", "old_logprob", "new_logprob", "entropy"]
    data = rng.normal(size=(n, len(cols)))
    data[0, 0] = 60.0
    df = spark.createDataFrame([(i, i // 4, *map(float, row)) for i, row in enumerate(data)], ["rollout_id", "batch_id", *cols])
    return df, dict(zip(cols, data.T))


def test_returns_advantages_and_losses(spark):
    df, c = buffer(spark)
    z = np.clip((c["reward"] - c["reward"].mean()) / (c["reward"].std(ddof=1) + 1e-8), -3, 3)
    ret = z - 0.02 * c["kl"]
    adv = ret - c["value"]
    adv = np.clip((adv - adv.mean()) / (adv.std(ddof=1) + 1e-8), -1.5, 1.5)
    out = R.advantages(R.shaped_returns(R.normalized_rewards(df), 0.02), 1.5)
    rows = out.orderBy("rollout_id").collect()
    assert [r["return"] for r in rows] == pytest.approx(ret)
    assert [r.advantage for r in rows] == pytest.approx(adv)

    ratio = np.exp(c["new_logprob"] - c["old_logprob"])
    policy = -np.minimum(ratio * adv, np.clip(ratio, 0.8, 1.2) * adv).mean() + 0.02 * c["kl"].mean()
    huber = lambda x: np.where(abs(x) < 1, 0.5 * x * x, abs(x) - 0.5).mean()
    near = c["value"] + np.clip(c["value_new"] - c["value"], -0.2, 0.2)
    value = max(huber(c["value_new"] - ret), huber(near - ret))
    row = R.minibatch_losses(out, [], 0.02).first()
    assert (row.policy_loss, row.value_loss) == pytest.approx((policy, value))
    assert row.total_loss == pytest.approx(policy + 0.5 * value - 0.01 * c["entropy"].mean())
    plain = R.minibatch_losses(out, [], 0.02, value_clip_epsilon=None).first()
    assert plain.value_loss == pytest.approx(huber(c["value_new"] - ret))


def test_small_buffers_and_batches(spark):
    df, c = buffer(spark, 3)
    out = R.advantages(R.shaped_returns(R.normalized_rewards(df), 0.0), 100.0).orderBy("rollout_id").collect()
    assert [r.advantage for r in out] == pytest.approx([r["return"] - r.value for r in out])
    one = R.normalized_rewards(df.limit(1)).first()
    assert one.reward_norm is None
    df, c = buffer(spark)
    got = R.batch_returns(df, 0.02).orderBy("rollout_id").collect()
    want = []
    for b in range(10):
        r = c["reward"][b * 4:b * 4 + 4]
        want += list(np.clip((r - r.mean()) / (r.std(ddof=1) + 1e-8), -3, 3) - 0.02 * c["kl"][b * 4:b * 4 + 4])
    assert [r["return"] for r in got] == pytest.approx(want)
    snap = R.snapshot(df).first()
    assert (snap.kl_mean, snap.value_std) == pytest.approx((c["kl"].mean(), c["value"].std(ddof=1)))


def test_scores_and_clamp(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    assert R.linear_score(df, "v", [3.0, -1.0], 0.5).first().reward == 1.5
    x = spark.createDataFrame([(float("nan"),), (9.0,), (-9.0,)], "x double").select(N.clamp(F.col("x"), -3, 3).alias("y"))
    got = [r.y for r in x.collect()]
    assert np.isnan(got[0]) and got[1:] == [3.0, -3.0]
    assert R.concat_buffers(df, df, df).count() == 3


def test_statistics_in_place_equal_the_joined_ones(spark):
    import numpy as np

    rng = np.random.default_rng(8)
    rows = [(k, rng.integers(0, 5, n).tolist(), rng.normal(size=(n, 5)).tolist(), (rng.normal(size=(n, 5)) * 3).tolist()) for k, n in enumerate([4, 0, 1, 30])] + [(9, None, None, None)]
    df = spark.createDataFrame(rows, "rollout_id long, ids array<int>, logits_p array<array<double>>, logits_q array<array<double>>")
    got = {r.rollout_id: r for r in R.statistics_in_place(df.repartition(2)).collect()}
    parts = df.select("rollout_id", F.posexplode(F.arrays_zip("ids", "logits_p", "logits_q")).alias("pos", "x")).select("rollout_id", "pos", F.col("x.ids").alias("token_id"), "x.logits_p", "x.logits_q")
    for r in R.token_statistics(parts).collect():
        assert (got[r.rollout_id].logprob, got[r.rollout_id].kl, got[r.rollout_id].entropy) == pytest.approx((r.logprob, r.kl, r.entropy))
    assert all((got[k].logprob, got[k].kl, got[k].entropy) == (0.0, 0.0, 0.0) for k in (1, 9)) and len(got) == 5
