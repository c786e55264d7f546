"""Rollout mathematics over recorded rollouts and token distributions."""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Column, functions as F, types as T

from prefloom.functions.numeric import clamp, dot, entropy, huber, kl_divergence, token_logprob
from prefloom.functions.tokens import response_ids
from prefloom.operators.alignment import one_row

# The UDF below travels with its code, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Guard of the standard score, its bounds, and the size from which advantages are standardized.
SCORE_GUARD = 1e-8
SCORE_BOUND = 3.0
STANDARDIZE_FROM = 4


def concat_buffers(*buffers: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), buffers)


def with_room_for_response(df: DataFrame) -> DataFrame:
    """Rollouts whose estimated response length is positive."""
    return df.where(F.size("full_ids") - (F.col("prompt_len") + 1) > 0)


def response_tokens(df: DataFrame, eos_id: int | None, key: str = "rollout_id", carried: list[str] | None = None) -> DataFrame:
    """(rollout, pos, token_id) of each response token, and ``carried`` columns; ``pos`` counts from the response start."""
    ids = response_ids(F.col("full_ids"), F.col("prompt_len"), eos_id)
    return df.select(key, *(carried or []), F.posexplode(ids).alias("pos", "token_id"))


def align_distributions(policy: DataFrame, reference: DataFrame) -> DataFrame:
    """Both distributions of the same rollout position in one row."""
    return policy.withColumnRenamed("logits", "logits_p").join(
        reference.withColumnRenamed("logits", "logits_q").select("rollout_id", "pos", "logits_q"),
        ["rollout_id", "pos"])


def token_statistics(tokens: DataFrame, key: str = "rollout_id") -> DataFrame:
    """Mean log-probability, KL and entropy over a rollout's response tokens."""
    p, q = F.col("logits_p"), F.col("logits_q")
    return tokens.groupBy(key).agg(
        F.avg(token_logprob(p, F.col("token_id"))).alias("logprob"),
        F.avg(kl_divergence(p, q)).alias("kl"),
        F.avg(entropy(p)).alias("entropy"),
    )


def with_token_statistics(rollouts: DataFrame, tokens: DataFrame, key: str = "rollout_id") -> DataFrame:
    """The same for every rollout; 0 where no response token is left."""
    stats = token_statistics(tokens, key)
    zeros = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("logprob", "kl", "entropy")}
    return rollouts.join(stats, key, "left").withColumns(zeros)


def _log_softmax(logits: pa.ListArray) -> np.ndarray:
    """Rows of log-probabilities, one for each list of logits."""
    sizes = pc.list_value_length(logits)
    if pc.min(sizes).as_py() != pc.max(sizes).as_py():
        raise ValueError("the logits of a batch have different lengths")
    x = logits.flatten().to_numpy(zero_copy_only=False).reshape(len(logits), -1)
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


_MEANS = T.StructType([T.StructField(n, T.DoubleType()) for n in ("logprob", "kl", "entropy")])


@F.arrow_udf(_MEANS)
def _means(ids: pa.Array, policy: pa.Array, reference: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(ids)), sizes)
    out = [np.zeros(len(ids))] * 3
    if len(owner):
        p, q = _log_softmax(policy.flatten()), _log_softmax(reference.flatten())
        chance, token = np.exp(p), ids.flatten().to_numpy(zero_copy_only=False)
        per_token = (p[np.arange(len(token)), token], (chance * (p - q)).sum(1), -(chance * p).sum(1))
        out = [np.bincount(owner, x, len(ids)) / np.maximum(sizes, 1) for x in per_token]
    return pa.StructArray.from_arrays([pa.array(x) for x in out], names=["logprob", "kl", "entropy"])


def statistics_in_place(rollouts: DataFrame, ids: str = "ids", policy: str = "logits_p", reference: str = "logits_q") -> DataFrame:
    """Add mean log-probability, KL and entropy over a rollout's response tokens; 0 where there is none.

    A rollout's ids (0-based) and the logits of both distributions stand in its row, one list for each token, and are reduced
    there in Arrow batches: no row is exploded, shuffled or joined.
    """
    df = rollouts.withColumn("_means", _means(ids, policy, reference))
    return df.withColumns({c: F.col(f"_means.{c}") for c in ("logprob", "kl", "entropy")}).drop("_means")


def mean_entropy(stats: DataFrame) -> DataFrame:
    return stats.agg(F.avg("entropy").alias("entropy"))


def linear_score(df: DataFrame, features: str, weights: list[float], bias: float = 0.0, name: str = "reward") -> DataFrame:
    """w . h + b per row."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    return df.withColumn(name, dot(F.col(features).cast("array<double>"), w, bias))


def snapshot(df: DataFrame) -> DataFrame:
    aggs = []
    for c in ("kl", "reward", "value"):
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    return df.agg(*aggs)


def _standard(x: Column, mean: Column, deviation: Column) -> Column:
    return (x - mean) / (deviation + F.lit(SCORE_GUARD))


def _moments(df: DataFrame, value: str) -> Column:
    """Mean, deviation and count of a whole buffer as one subquery value."""
    return one_row(df.agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count("*").alias("n")))


def normalized_rewards(df: DataFrame, reward: str = "reward") -> DataFrame:
    """Standard score over the whole buffer, bounded. NULL for a buffer of one row."""
    m = _moments(df, reward)
    z = _standard(F.col(reward), m["mean"], m["std"])
    return df.withColumn("reward_norm", clamp(z, -SCORE_BOUND, SCORE_BOUND))


def shaped_returns(df: DataFrame, beta: float) -> DataFrame:
    return df.withColumn("return", F.col("reward_norm") - F.lit(float(beta)) * F.col("kl"))


def advantages(df: DataFrame, clip: float, normalize: bool = True) -> DataFrame:
    """Return minus value, standardized in buffers of at least four rows, then clipped."""
    raw = df.withColumn("advantage", F.col("return") - F.col("value"))
    if normalize:
        m = _moments(raw, "advantage")
        z = _standard(F.col("advantage"), m["mean"], m["std"])
        raw = raw.withColumn(
            "advantage", F.when(m["n"] >= STANDARDIZE_FROM, z).otherwise(F.col("advantage")))
    return raw.withColumn("advantage", clamp(F.col("advantage"), -clip, clip))


def batch_returns(df: DataFrame, beta: float, batch: str = "batch_id") -> DataFrame:
    """Normalized, KL-shaped return within each batch."""
    stats = df.groupBy(batch).agg(F.avg("reward").alias("_mean"), F.stddev_samp("reward").alias("_std"))
    z = _standard(F.col("reward"), F.col("_mean"), F.col("_std"))
    joined = df.join(stats, batch).withColumn("reward_norm", clamp(z, -SCORE_BOUND, SCORE_BOUND))
    return shaped_returns(joined, beta).drop("_mean", "_std")


def policy_loss(new_logprob: Column, old_logprob: Column, advantage: Column, clip_epsilon: float) -> Column:
    """Clipped surrogate of a group of rows, as an aggregate."""
    ratio = F.exp(new_logprob - old_logprob)
    limited = clamp(ratio, 1.0 - clip_epsilon, 1.0 + clip_epsilon)
    return -F.avg(F.least(ratio * advantage, limited * advantage))


def value_loss(current: Column, old: Column, returns: Column, clip_epsilon: float | None) -> Column:
    """Huber loss of the critic: with clipping, the larger of the two means."""
    plain = F.avg(huber(current - returns))
    if not clip_epsilon or clip_epsilon <= 0:
        return plain
    near = old + clamp(current - old, -clip_epsilon, clip_epsilon)
    return F.greatest(plain, F.avg(huber(near - returns)))


def minibatch_losses(
    df: DataFrame, by: list[str], beta: float, clip_epsilon: float = 0.2, value_clip_epsilon: float | None = 0.2,
    value_coeff: float = 0.5, entropy_coeff: float = 0.01,
) -> DataFrame:
    """Policy, value and total loss per mini-batch, in one pass.

    Needs new_logprob, old_logprob, advantage, value_new, value, return, kl and entropy.
    """
    parts = df.groupBy(*by).agg(
        policy_loss(F.col("new_logprob"), F.col("old_logprob"), F.col("advantage"), clip_epsilon).alias("_policy"),
        F.avg("kl").alias("kl_divergence"),
        value_loss(F.col("value_new"), F.col("value"), F.col("return"), value_clip_epsilon).alias("value_loss"),
        F.avg("entropy").alias("entropy"),
    )
    policy = F.col("_policy") + F.lit(float(beta)) * F.col("kl_divergence")
    total = F.col("policy_loss") + value_coeff * F.col("value_loss") - entropy_coeff * F.col("entropy")
    return parts.withColumn("policy_loss", policy).withColumn("total_loss", total).drop("_policy")
