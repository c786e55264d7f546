"""Reports on scored responses: alignment, quality, win rates, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prefloom.functions.numeric import prefers, share
from prefloom.functions.text import n_words
from prefloom.operators.ordering import first_rows
from prefloom.operators.text_metrics import chosen_metrics, quality_by


def zip_by_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Align two lists by key; rows without a partner are left out."""
    return left.join(right, key)


def preference_alignment(
    df: DataFrame, chosen: str = "chosen_reward", rejected: str = "rejected_reward", by: list[str] | None = None
) -> DataFrame:
    c, r = F.col(chosen), F.col(rejected)
    return df.groupBy(*(by or [])).agg(
        share(prefers(c, r)).alias("preference_accuracy"),
        F.avg(c - r).alias("avg_reward_difference"),
        F.avg(c).alias("chosen_avg_reward"),
        F.avg(r).alias("rejected_avg_reward"),
    )


def average_reward(df: DataFrame, reward: str = "reward") -> DataFrame:
    return df.agg(F.coalesce(F.avg(reward), F.lit(0.0)).alias("avg_reward"))


def response_stats(
    df: DataFrame, response: str = "response", reward: str = "reward", by: list[str] | None = None
) -> DataFrame:
    """Mean words, mean reward and its sample deviation (NULL for a single row)."""
    return df.groupBy(*(by or [])).agg(*_stats(response, reward))


def _stats(response: str, reward: str) -> list[Column]:
    return [F.avg(n_words(response)).alias("avg_response_length"), F.avg(reward).alias("avg_reward_score"), F.stddev_samp(reward).alias("reward_std")]


def model_quality(
    responses: DataFrame, references: DataFrame | None = None, metrics: list[str] | None = None,
    token_vectors: tuple[DataFrame, DataFrame] | None = None, key: str = "prompt_id", by: list[str] | None = None,
) -> DataFrame:
    """One row for the responses of one model, or of each value of ``by``: text metrics, then lengths and rewards, in one scan of the responses.

    References are a column ``reference`` of the responses, or a table ``(key, reference)``; without them there are no text metrics. Without a
    list of metrics all are worked out that the inputs allow: the embedding match needs ``token_vectors``, the predicted side with ``by``.
    """
    by = by or []
    if references is None and "reference" not in responses.columns:
        return response_stats(responses, by=by)
    rows = responses if references is None else responses.drop("reference").join(references.select(key, "reference"), key, "left")
    names = chosen_metrics(metrics, token_vectors)
    return quality_by(rows.withColumn("prediction", F.col("response")), by, _stats("response", "reward"), names, token_vectors)


def win_rate(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.agg(share(prefers(F.col(first), F.col(second))).alias("win_rate"))


def one_row(df: DataFrame) -> Column:
    """A one-row table as a struct value (scalar subquery, evaluated once)."""
    return df.select(F.struct("*").alias("row")).scalar()


def compare_two(
    first: DataFrame, second: DataFrame, key: str = "prompt_id", samples: int = 3,
    references: DataFrame | None = None, metrics: list[str] | None = None,
    token_vectors: tuple[DataFrame, DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """One report row for two response tables (key, response, reward) over the same prompts.

    With ``references`` both sides also get text metrics; the embedding match among them needs the ``token_vectors`` of the first, the
    second and the references. Both models are measured in one scan.
    """
    both = first.select(key, F.col("reward").alias("r1")).join(
        second.select(key, F.col("reward").alias("r2")), key)
    report = both.agg(share(prefers(F.col("r1"), F.col("r2"))).alias("win_rate_model_1"))
    side = lambda df, n: df.withColumn("side", F.lit(n))
    columns = [key, "response", "reward"]
    rows = side(first.select(*columns), 1).unionByName(side(second.select(*columns), 2))
    vectors = token_vectors and (side(token_vectors[0], 1).unionByName(side(token_vectors[1], 2)), token_vectors[2])
    quality = model_quality(rows, references, metrics, vectors, key, by=["side"])
    values = F.struct(*[c for c in quality.columns if c != "side"])
    wide = one_row(quality.agg(*[F.max(F.when(F.col("side") == n, values)).alias(f"m{n}") for n in (1, 2)]))
    return report.select(
        wide["m1"].alias("model_1_metrics"),
        wide["m2"].alias("model_2_metrics"),
        "win_rate_model_1",
        sample_list(first, key, "response", samples).alias("model_1_samples"),
        sample_list(second, key, "response", samples).alias("model_2_samples"),
    )


def sample_list(df: DataFrame, key: str, column: str, n: int) -> Column:
    """The first ``n`` values by key as one array value."""
    few = first_rows(df.select(key, column), key, n)
    items = few.agg(F.array_sort(F.collect_list(F.struct(key, column))).alias("items"))
    return items.select(F.transform("items", lambda x: x[column])).scalar()


def side_by_side(
    df: DataFrame, models: list[str], key: str = "prompt_id", model: str = "model", values: tuple[str, ...] = ("response", "reward")
) -> DataFrame:
    """The ``values`` of each named model in one row per prompt (one shuffle)."""
    cells = []
    for name in models:
        cell = F.when(F.col(model) == name, F.struct(*values))
        cells.append(F.max(cell).alias(name))
    wide = df.groupBy(key).agg(*cells)
    flat = [F.col(f"`{m}`.{f}").alias(f"{m}_{f}") for m in models for f in values]
    return wide.select(key, *flat)


def evaluation_report(
    responses: DataFrame, pairs: DataFrame, references: DataFrame | None = None, metrics: list[str] | None = None,
    key: str = "prompt_id", samples: int = 5, token_vectors: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Quality, alignment and samples as one nested document row.

    With ``references``, or a column ``reference`` of the responses, text metrics are part of the quality.
    """
    sample = F.struct(
        sample_list(responses, key, "prompt", samples).alias("prompts"),
        sample_list(responses, key, "response", samples).alias("responses"))
    alignment = preference_alignment(pairs)
    return alignment.select(
        one_row(model_quality(responses, references, metrics, token_vectors, key)).alias("model_quality"),
        F.struct(*alignment.columns).alias("preference_alignment"),
        sample.alias("sample_generations"),
    )
