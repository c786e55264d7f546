"""Fitting, applying and storing a linear reward head."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Model
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from prefloom.functions.numeric import dot
from prefloom.functions.text import WS, compose, default_text, words
from prefloom.operators.columns import once
from prefloom.operators.losses import loss_column
from prefloom.operators.newton import NewtonFit, fit_newton
from prefloom.sources.scratch import written

# Largest feature count the solver of the margin fit accepts.
MARGIN_FIT_FEATURES = 4096

_KINDS = {
    "logistic": LogisticRegressionModel, "hinge": LinearSVCModel, "log_sigmoid": GeneralizedLinearRegressionModel,
}


def hash_texts(df: DataFrame, columns: dict[str, str], size: int = 1024) -> DataFrame:
    """Word counts hashed into a feature array, per text column (``columns``: text -> features)."""
    tokens = RegexTokenizer(inputCol="_text", outputCol="_words", pattern=f"{WS}+", toLowercase=False)
    counts = HashingTF(inputCol="_words", outputCol="_hashed", numFeatures=size)
    for text, output in columns.items():
        hashed = counts.transform(tokens.transform(df.withColumn("_text", default_text(text))))
        df = hashed.withColumn(output, vector_to_array("_hashed")).drop("_text", "_words", "_hashed")
    return df


def hash_words(df: DataFrame, columns: dict[str, str], size: int = 256) -> DataFrame:
    """Word counts in ``size`` buckets per text column (``columns``: text -> counts); a word's bucket is that of the first 32 bits of its
    MD5 digest, so that other systems can find it. Words are counted in Arrow batches; a null text has no words."""

    @F.arrow_udf("array<double>")
    def counted(tokens: pa.Array) -> pa.Array:
        coded = tokens.flatten().dictionary_encode()
        bucket = np.array([int.from_bytes(hashlib.md5(t.encode()).digest()[:4], "big") % size for t in coded.dictionary.to_pylist()], np.int64)
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        place = np.repeat(np.arange(len(tokens)), lengths) * size + bucket[coded.indices.to_numpy(zero_copy_only=False)]
        counts = np.bincount(place, minlength=len(tokens) * size).astype(float)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(tokens) + 1, dtype=np.int32) * size), pa.array(counts))

    return df.withColumns({out: counted(words(default_text(text))) for text, out in columns.items()})


def fit_differences(df: DataFrame, chosen: str, rejected: str, margin: float = 0.0, reg: float = 0.0, scale: float = 1.0, **limits) -> NewtonFit:
    """Weights over all features that minimize the mean of ``log(1 + exp(margin - w . (chosen - rejected) * scale))`` plus the penalty.

    The differences are written once, as every Newton step reads them. ``limits`` go to ``fit_newton``.
    """
    diff = F.zip_with(F.col(chosen).cast("array<double>"), F.col(rejected).cast("array<double>"), lambda a, b: (a - b) * scale)
    return fit_newton(written(df.select(diff.alias("d")), "differences"), "d", margin, reg, **limits)


def pair_differences(df: DataFrame, chosen: str, rejected: str, both_signs: bool = True) -> DataFrame:
    """Training rows: the feature difference with label 1 and, mirrored, with label 0."""
    diff = F.zip_with(F.col(chosen).cast("array<double>"), F.col(rejected).cast("array<double>"), lambda a, b: a - b)
    rows = df.select(diff.alias("d"))
    if both_signs:
        signed = F.array(
            F.struct(F.col("d").alias("d"), F.lit(1.0).alias("label")),
            F.struct(F.transform("d", lambda x: -x).alias("d"), F.lit(0.0).alias("label")))
        rows = rows.select(F.inline(signed))
    else:
        rows = rows.withColumn("label", F.lit(1.0))
    return rows.select(array_to_vector("d").alias("features"), "label")


def fit_logistic(df: DataFrame, chosen: str, rejected: str, reg: float = 0.0, max_iter: int = 100) -> Model:
    """Weights that minimize -log sigmoid(w . d)."""
    estimator = LogisticRegression(
        fitIntercept=False, standardization=False, regParam=reg, maxIter=max_iter, tol=1e-9)
    return estimator.fit(pair_differences(df, chosen, rejected, both_signs=False))


def fit_hinge(df: DataFrame, chosen: str, rejected: str, margin: float = 1.0, reg: float = 1e-4, max_iter: int = 100) -> Model:
    """Weights for the hinge of a margin, up to its scale: ``head_weights`` with the same margin gives the head.

    With v = w / margin the hinge of margin 1 and ``reg * margin`` is the same problem. A little regularization keeps the optimum
    unique where the pairs can be separated.
    """
    estimator = LinearSVC(fitIntercept=False, standardization=False, regParam=reg * margin, maxIter=max_iter, tol=1e-9)
    return estimator.fit(pair_differences(df, chosen, rejected, both_signs=False))


def fit_log_sigmoid(
    df: DataFrame, chosen: str, rejected: str, margin: float, reg: float = 0.0, max_iter: int = 50
) -> Model:
    """Weights that minimize -log sigmoid(w . d - margin), the margin being an offset."""
    rows = written(pair_differences(df, chosen, rejected, both_signs=False).withColumn("offset", F.lit(-float(margin))), "differences")
    size = rows.select(F.max(F.size(vector_to_array("features")))).first()[0] or 0
    if size > MARGIN_FIT_FEATURES:
        raise ValueError(f"the margin fit takes at most {MARGIN_FIT_FEATURES} features, not {size}")
    estimator = GeneralizedLinearRegression(
        family="binomial", link="logit", fitIntercept=False, regParam=reg, maxIter=max_iter, offsetCol="offset")
    return estimator.fit(rows)


def head_weights(model: Model, margin: float = 1.0) -> list[float]:
    """Weights of a fitted head; a hinge head is scaled to its margin."""
    scale = margin if isinstance(model, LinearSVCModel) else 1.0
    return [scale * float(w) for w in model.coefficients.toArray()]


def score_features(df: DataFrame, weights: list[float], columns: dict[str, str], bias: float = 0.0) -> DataFrame:
    """Add a reward per feature column (``columns``: features -> reward)."""
    w = F.array(*[F.lit(x) for x in weights])
    return once(df, {out: dot(F.col(c).cast("array<double>"), w, bias) for c, out in columns.items()})


def score_texts(
    df: DataFrame, features: Callable[[Column], Column], weights: list[float], responses: dict[str, str],
    prompt: str = "prompt", sep: str = " ", bias: float = 0.0,
) -> DataFrame:
    """Add a reward of prompt + response per response column (``responses``: response -> reward).

    ``features`` maps a text Column to an array Column.
    """
    w = F.array(*[F.lit(float(x)) for x in weights])
    texts = once(df, {f"_{out}": compose(prompt, default_text(c), sep) for c, out in responses.items()})
    scored = once(texts, {out: dot(features(F.col(f"_{out}")), w, bias) for out in responses.values()})
    return scored.drop(*[f"_{out}" for out in responses.values()])


def mean_loss(df: DataFrame, loss: str, margin: float = 0.0) -> DataFrame:
    value = loss_column(loss, F.col("chosen_reward"), F.col("rejected_reward"), margin)
    return df.agg(F.avg(value).alias("loss"))


# --- persistence -----------------------------------------------------------

def save_head(model: Model, path: str, config: dict, metadata: dict, spark: SparkSession) -> None:
    """Store the weights, and the configuration and metadata as one-row JSON tables."""
    kind = next((k for k, cls in _KINDS.items() if isinstance(model, cls)), None)
    if kind is None:
        raise ValueError(f"not a reward head: {type(model).__name__}")
    model.write().overwrite().save(f"{path}/weights")
    for name, content in (("config", {**config, "kind": kind}), ("metadata", metadata)):
        row = spark.createDataFrame([(json.dumps(content, sort_keys=True),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{path}/{name}")


def load_head(path: str, spark: SparkSession) -> tuple[Model, dict, dict]:
    """The model, its configuration and its metadata; an absent path raises."""
    config, metadata = (json.loads(spark.read.text(f"{path}/{n}").first()[0]) for n in ("config", "metadata"))
    return _KINDS[config["kind"]].load(f"{path}/weights"), config, metadata


def save_weights(weights: list[float], path: str, config: dict, metadata: dict, spark: SparkSession) -> None:
    """Store a plain head: its weights as a table, the configuration and metadata as one-row JSON tables."""
    rows = [(i, float(w)) for i, w in enumerate(weights)]
    spark.createDataFrame(rows, "component int, weight double").coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")
    for name, content in (("config", {**config, "kind": "weights"}), ("metadata", metadata)):
        spark.createDataFrame([(json.dumps(content, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}")


def load_weights(path: str, spark: SparkSession) -> tuple[list[float], dict, dict]:
    """The weights in order, the configuration and the metadata; an absent path raises."""
    config, metadata = (json.loads(spark.read.text(f"{path}/{n}").first()[0]) for n in ("config", "metadata"))
    rows = spark.read.parquet(f"{path}/weights").orderBy("component").collect()  # as many rows as features
    return [r.weight for r in rows], config, metadata
