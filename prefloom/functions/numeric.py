"""Column functions over scores and vectors; safe for NaN and large values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def piece_of(index: Column | str, size: int) -> Column:
    """Number of the piece of ``size`` that an index (0 or more) falls into, in whole numbers."""
    index = F.col(index) if isinstance(index, str) else index
    return F.call_function("div", index.cast("long"), F.lit(size).cast("long"))


def prefers(chosen: Column, rejected: Column) -> Column:
    """Strictly greater; NaN never wins (Spark itself sorts NaN above all numbers)."""
    return (chosen > rejected) & ~F.isnan(chosen)


def share(flag: Column) -> Column:
    """Share of rows where ``flag`` holds, 0 for no rows."""
    return F.coalesce(F.avg(F.coalesce(flag, F.lit(False)).cast("double")), F.lit(0.0))


def log_sigmoid(x: Column) -> Column:
    return F.least(x, F.lit(0.0)) - F.log1p(F.exp(-F.abs(x)))


def clamp(x: Column, low: float | Column, high: float | Column) -> Column:
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return F.when(x.isNull() | F.isnan(x), x).otherwise(F.greatest(low, F.least(high, x)))


def huber(error: Column) -> Column:
    size = F.abs(error)
    return F.when(size < 1.0, 0.5 * error * error).otherwise(size - 0.5)


def dot(a: Column, b: Column, bias: float | Column = 0.0) -> Column:
    bias = bias if isinstance(bias, Column) else F.lit(float(bias))
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), bias, lambda acc, v: acc + v)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def log_normalizer(logits: Column) -> Column:
    """log(sum(exp(logits))), shifted by the maximum."""
    top = F.array_max(logits)
    return top + F.log(_sum(F.transform(logits, lambda x: F.exp(x - top))))


def token_logprob(logits: Column, token_id: Column) -> Column:
    """Log-softmax of the logits at a 0-based token id."""
    return F.element_at(logits, (token_id + 1).cast("int")) - log_normalizer(logits)


def _expected(logits: Column, values: Column) -> Column:
    """Mean of ``values`` under the distribution of the logits; normalizers stay outside the lambdas, which run for every entry."""
    top = F.array_max(logits)
    weights = F.transform(logits, lambda a: F.exp(a - top))
    return _sum(F.zip_with(weights, values, lambda w, v: w * v)) / _sum(weights)


def kl_divergence(logits_p: Column, logits_q: Column) -> Column:
    """Sum of p * (log p - log q), from two arrays of logits."""
    differences = F.zip_with(logits_p, logits_q, lambda a, b: a - b)
    return _expected(logits_p, differences) - log_normalizer(logits_p) + log_normalizer(logits_q)


def entropy(logits: Column) -> Column:
    return log_normalizer(logits) - _expected(logits, logits)
