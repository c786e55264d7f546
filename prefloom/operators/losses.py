"""Pairwise losses by name, and their metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from prefloom.functions.numeric import log_sigmoid, prefers, share

Loss = Callable[[Column, Column, float], Column]


def hinge(chosen: Column, rejected: Column, margin: float) -> Column:
    if margin <= 0:
        raise ValueError("hinge needs a margin above 0")
    gap = F.lit(float(margin)) - (chosen - rejected)
    return F.when(gap.isNotNull(), F.greatest(F.lit(0.0), gap))


def log_sigmoid_margin(chosen: Column, rejected: Column, margin: float) -> Column:
    return -log_sigmoid(chosen - rejected - F.lit(float(margin)))


def bradley_terry(chosen: Column, rejected: Column, margin: float) -> Column:
    """Logistic at margin 0; with a margin it is the hinge."""
    return hinge(chosen, rejected, margin) if margin > 0 else -log_sigmoid(chosen - rejected)


_LOSSES: dict[str, Loss] = {
    "bradley_terry": bradley_terry,
    "hinge": hinge,
    "log_sigmoid": log_sigmoid_margin,
}


def register_loss(name: str, loss: Loss) -> None:
    """Add a loss: a function of (chosen, rejected, margin) to a Column."""
    if not callable(loss):
        raise ValueError("a loss must be a function of (chosen, rejected, margin)")
    _LOSSES[name] = loss


def available_losses() -> list[str]:
    return list(_LOSSES)


def loss_column(name: str, chosen: Column, rejected: Column, margin: float = 0.0) -> Column:
    if name not in _LOSSES:
        raise ValueError(f"unknown loss {name!r}; available: {', '.join(_LOSSES)}")
    if isinstance(margin, bool) or not isinstance(margin, (int, float)) or margin < 0:
        raise ValueError(f"margin must be a number of at least 0, not {margin!r}")
    return _LOSSES[name](chosen, rejected, margin)


def loss_metrics(
    df: DataFrame, loss: str, margin: float = 0.0, chosen: str = "chosen_reward",
    rejected: str = "rejected_reward", by: list[str] | None = None,
) -> DataFrame:
    """Accuracy, means, share of pairs beyond the margin, and mean loss in one pass."""
    c, r = F.col(chosen), F.col(rejected)
    return df.groupBy(*(by or [])).agg(
        share(prefers(c, r)).alias("preference_accuracy"),
        share(prefers(c - r, F.lit(float(margin))) | (c - r == margin)).alias("margin_satisfaction"),
        F.avg(c).alias("chosen_reward_mean"),
        F.avg(r).alias("rejected_reward_mean"),
        F.avg(c - r).alias("reward_diff_mean"),
        F.avg(loss_column(loss, c, r, margin)).alias("loss_value"),
        F.count("*").alias("pairs"),
    )
