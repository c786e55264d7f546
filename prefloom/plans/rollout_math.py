"""Queries: token distributions, rewards, advantages and losses of rollouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from prefloom.operators import rollouts as R
from prefloom.plans import inputs as I
from prefloom.plans.registry import registered, rounded, table
from prefloom.sources.scratch import written

BETA, CLIP, MINIBATCH = 0.02, 0.5, 32


@registered(f"""WITH {I.TOKEN_LOGITS_SQL} SELECT rollout_id, round(logprob, 6) + 0.0 AS logprob,
  round(kl, 6) + 0.0 AS kl, round(entropy, 6) + 0.0 AS entropy FROM rollout_stats""")
def token_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 64 logits of both distributions, reduced in the row of their rollout."""
    return rounded(R.statistics_in_place(I.rollout_logits(spark, sf_dir)).select("rollout_id", "logprob", "kl", "entropy"))


@registered(f"""WITH {I.TOKEN_LOGITS_SQL} SELECT rollout_id, round(logprob, 6) + 0.0 AS logprob,
  round(kl, 6) + 0.0 AS kl, round(entropy, 6) + 0.0 AS entropy FROM rollout_stats""")
def token_statistics_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from two tables of positions, joined by rollout and place."""
    policy, reference = (written(side, "positions") for side in I.token_logits(spark, sf_dir))
    base = I.rollouts(spark, sf_dir).select("rollout_id")
    return rounded(R.with_token_statistics(base, R.align_distributions(policy, reference)))


@registered(f"WITH {I.TOKEN_LOGITS_SQL} SELECT round(avg(entropy), 6) + 0.0 AS entropy FROM rollout_stats")
def mean_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.mean_entropy(token_statistics(spark, sf_dir)))


@registered(f"SELECT vec_id, round({I.dot_sql('embedding')} + 0.25, 6) + 0.0 AS reward FROM embeddings")
def linear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = R.linear_score(table(spark, sf_dir, "embeddings"), "embedding", I.VECTOR_WEIGHTS, 0.25)
    return rounded(df.select("vec_id", "reward"))


_ADVANTAGES_SQL = f"""{I.ROLLOUTS_SQL},
m AS (SELECT avg(reward) AS mean, stddev_samp(reward) AS std FROM rollouts),
normed AS (SELECT rollouts.*, greatest(-3, least(3, (reward - mean) / (std + 1e-8))) AS reward_norm FROM rollouts, m),
shaped AS (SELECT *, reward_norm - {BETA} * kl AS ret FROM normed),
raw AS (SELECT *, ret - value AS adv FROM shaped),
a AS (SELECT avg(adv) AS mean, stddev_samp(adv) AS std FROM raw),
finished AS (SELECT raw.*, greatest(-{CLIP}, least({CLIP}, (adv - mean) / (std + 1e-8))) AS advantage FROM raw, a)"""


def _finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    normed = R.normalized_rewards(I.rollouts(spark, sf_dir))
    return R.advantages(R.shaped_returns(normed, BETA), CLIP)


@registered(f"WITH {_ADVANTAGES_SQL} SELECT rollout_id, round(reward_norm, 6) + 0.0 AS reward_norm FROM normed")
def normalized_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.normalized_rewards(I.rollouts(spark, sf_dir)).select("rollout_id", "reward_norm"))


@registered(f"""WITH {_ADVANTAGES_SQL} SELECT rollout_id, round(ret, 6) + 0.0 AS "return", round(advantage, 6) + 0.0 AS advantage FROM finished""")
def advantages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_finished(spark, sf_dir).select("rollout_id", "return", "advantage"))


@registered(f"""WITH {I.ROLLOUTS_SQL}, b AS (SELECT batch_id, avg(reward) AS mean, stddev_samp(reward) AS std FROM rollouts GROUP BY batch_id)
SELECT rollout_id, round(greatest(-3, least(3, (reward - mean) / (std + 1e-8))) - {BETA} * kl, 6) + 0.0 AS "return"
FROM rollouts JOIN b USING (batch_id)""")
def batch_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.batch_returns(I.rollouts(spark, sf_dir), BETA).select("rollout_id", "return"))


def _huber(x: str) -> str:
    return f"CASE WHEN abs({x}) < 1 THEN 0.5 * ({x}) * ({x}) ELSE abs({x}) - 0.5 END"


@registered(f"""WITH {_ADVANTAGES_SQL}, r AS (
  SELECT *, rollout_id // {MINIBATCH} AS minibatch, exp(new_logprob - old_logprob) AS ratio,
         value + greatest(-0.2, least(0.2, value_new - value)) AS near FROM finished), g AS (
  SELECT minibatch, -avg(least(ratio * advantage, greatest(0.8, least(1.2, ratio)) * advantage)) AS p, avg(kl) AS k,
         greatest(avg({_huber('value_new - ret')}), avg({_huber('near - ret')})) AS v, avg(entropy) AS e
  FROM r GROUP BY minibatch)
SELECT minibatch, round(p + {BETA} * k, 6) + 0.0 AS policy_loss, round(k, 6) + 0.0 AS kl_divergence, round(v, 6) + 0.0 AS value_loss,
  round(e, 6) + 0.0 AS entropy, round(p + {BETA} * k + 0.5 * v - 0.01 * e, 6) + 0.0 AS total_loss FROM g""")
def minibatch_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _finished(spark, sf_dir).withColumn("minibatch", F.floor(F.col("rollout_id") / MINIBATCH))
    return rounded(R.minibatch_losses(df, ["minibatch"], BETA))


@registered(f"""WITH {I.ROLLOUTS_SQL} SELECT {', '.join(f'round(avg({c}), 6) + 0.0 AS {c}_mean, round(stddev_samp({c}), 6) + 0.0 AS {c}_std' for c in ('kl', 'reward', 'value'))} FROM rollouts""")
def rollout_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.snapshot(I.rollouts(spark, sf_dir)))


@registered(f"""WITH {I.ROLLOUTS_SQL} SELECT prompt_len::INT AS prompt_len, count(*) * 2 AS rows, round(avg(reward), 6) + 0.0 AS reward FROM rollouts GROUP BY prompt_len""")
def joined_buffers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two buffers one after the other; columns are matched by name."""
    one = I.rollouts(spark, sf_dir).select("rollout_id", "prompt_len", "reward")
    both = R.concat_buffers(one, one.select("reward", "prompt_len", "rollout_id"))
    return rounded(both.groupBy("prompt_len").agg(F.count("*").alias("rows"), F.avg("reward").alias("reward")))
