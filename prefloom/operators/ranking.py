"""Keeping the better response."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from prefloom.functions.numeric import prefers
from prefloom.functions.text import compose

# Fixed value: the difference a preference must exceed.
CLEAR_DIFFERENCE = 0.1


def better_of_pair(
    pairs: DataFrame, threshold: float = CLEAR_DIFFERENCE, sep: str = "",
    chosen_reward: str = "chosen_reward", rejected_reward: str = "rejected_reward",
) -> DataFrame:
    """The higher-scored response of each pair, where the difference is clear."""
    c, r = F.col(chosen_reward), F.col(rejected_reward)
    wins = prefers(c, r)
    diff = F.when(wins, c - r).otherwise(r - c)
    return (
        pairs.withColumns({
            "best_response": F.when(wins, F.col("chosen")).otherwise(F.col("rejected")),
            "score": F.greatest(c, r),
            "score_diff": diff,
        })
        .where((F.col("score_diff") > threshold) & ~F.isnan("score_diff"))
        .withColumn("text", compose("prompt", "best_response", sep))
    )


def best_of_candidates(
    df: DataFrame, threshold: float = CLEAR_DIFFERENCE, key: str = "prompt_id", candidate: str = "candidate_id"
) -> DataFrame:
    """Best of any number of candidates, if it beats the runner-up clearly.

    The rank filter lets Spark keep two rows per prompt and task before the
    shuffle, so a prompt with very many candidates does not land in one task.
    """
    order = W.partitionBy(key).orderBy(F.desc("reward"), F.asc(candidate))
    top = df.where(F.col("reward").isNotNull() & ~F.isnan("reward"))
    top = top.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= 2)
    paired = top.withColumn("runner_up", F.lead("reward").over(order))
    best = paired.where(F.col("_rank") == 1).withColumn("score_diff", F.col("reward") - F.col("runner_up"))
    return best.where(F.col("score_diff") > threshold).drop("_rank")


def ranking_yield(df: DataFrame, kept: str = "kept") -> DataFrame:
    return df.agg(F.count("*").alias("pairs"), F.count_if(F.col(kept)).alias("examples"))
