"""Newton fits of linear heads: gradient and Gram matrix are summed over the cluster, the driver holds only what has the size of the features."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Partial sums that one task of a fold adds up, and bytes of them that the driver takes.
FAN, DRIVER_BYTES = 64, 1 << 26


def matrix_of(column: pa.Array) -> np.ndarray:
    """A column of number lists of one length as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def partial_sums(df: DataFrame, column: str, sums: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """One row ``(sums binary)`` for each task: ``sums`` of the matrices of its batches, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = sums(matrix_of(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return df.select(column).mapInArrow(run, "sums binary")


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for value in batch.column(0):
            part = np.frombuffer(value.as_buffer(), float)
            total = part.copy() if total is None else np.add(total, part, out=total)
    if total is not None:
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def folded(parts: DataFrame, count: int, size: int) -> np.ndarray | None:
    """The sum of ``count`` or fewer packed arrays of ``size`` doubles; None for no rows.

    Arrays are folded level by level, ``FAN`` in a task that holds two, until the rest is at most ``DRIVER_BYTES`` or a single array.
    """
    while count > max(1, DRIVER_BYTES // (8 * size)):
        count = -(-count // FAN)
        parts = parts.repartition(count).mapInArrow(_added, "sums binary")
    rows = parts.collect()
    return np.sum([np.frombuffer(r.sums, float) for r in rows], axis=0) if rows else None


def logistic_sums(weights: np.ndarray, margin: float) -> Callable[[np.ndarray], np.ndarray]:
    """Rows, loss, gradient and upper triangle of the Gram matrix of ``log(1 + exp(margin - w . d))``."""
    upper = np.triu_indices(len(weights))

    def sums(d: np.ndarray) -> np.ndarray:
        z = d @ weights - margin
        pull = np.exp(-np.logaddexp(0, z))
        gram = (d * (pull * (1 - pull))[:, None]).T @ d
        return np.concatenate([[len(d), np.logaddexp(0, -z).sum()], -(pull @ d), gram[upper]])

    return sums


@dataclass(frozen=True)
class Point:
    """Weights with the number of rows, the mean loss, and its gradient and Gram matrix there."""

    weights: np.ndarray
    rows: int
    loss: float
    gradient: np.ndarray
    gram: np.ndarray


def logistic_point(rows: DataFrame, column: str, weights: np.ndarray, margin: float, tasks: int) -> Point:
    """One pass over the rows, which lie in ``tasks`` partitions at most."""
    size = len(weights)
    total = folded(partial_sums(rows, column, logistic_sums(weights, margin)), tasks, 2 + size + size * (size + 1) // 2)
    if total is None:
        return Point(weights, 0, 0.0, np.zeros(size), np.zeros((size, size)))
    n, upper = total[0], np.triu_indices(size)
    gram = np.zeros((size, size))
    gram[upper] = total[2 + size:] / n
    return Point(weights, int(n), total[1] / n, total[2:2 + size] / n, gram + np.triu(gram, 1).T)


@dataclass(frozen=True)
class NewtonFit:
    """A fitted head: weights, mean loss with its penalty, norm of the gradient, passes, rows."""

    weights: list[float]
    objective: float
    gradient_norm: float
    passes: int
    rows: int


def fit_newton(rows: DataFrame, column: str, margin: float = 0.0, reg: float = 0.0, tol: float = 1e-10, max_passes: int = 60) -> NewtonFit:
    """Weights that minimize the mean of ``log(1 + exp(margin - w . d))`` plus ``reg / 2 |w|^2`` over the feature lists ``column``.

    Steps that do not lower the objective are halved; the fit ends when the gradient's norm is at most ``tol``, when rounding allows no
    further descent, or after ``max_passes`` passes. Without a penalty, rows that can be separated have no optimum: the weights then are those
    of the last pass, and the gradient's norm says so. Null lists are left out; lists of different lengths raise; no rows give no weights.
    """
    rows = rows.where(F.col(column).isNotNull())
    sizes = rows.select(F.size(column).alias("n"), F.spark_partition_id().alias("part")).agg(F.min("n"), F.max("n"), F.max("part") + 1).first()
    if sizes[0] is None:
        return NewtonFit([], 0.0, 0.0, 0, 0)
    if sizes[0] != sizes[1]:
        raise ValueError(f"feature lists have {sizes[0]} to {sizes[1]} entries")

    def objective(p: Point) -> float:
        return p.loss + reg / 2 * float(p.weights @ p.weights)

    def slope(p: Point) -> np.ndarray:
        return p.gradient + reg * p.weights

    tasks = sizes[2]
    best, passes = logistic_point(rows, column, np.zeros(sizes[0]), margin, tasks), 1
    while passes < max_passes and np.linalg.norm(slope(best)) > tol:
        gram = best.gram + reg * np.eye(len(best.weights))
        step = -np.linalg.lstsq(gram, slope(best), rcond=1e-14)[0]
        next_best = None
        while next_best is None and passes < max_passes:
            point, passes = logistic_point(rows, column, best.weights + step, margin, tasks), passes + 1
            if objective(point) < objective(best) or np.linalg.norm(slope(point)) < 0.5 * np.linalg.norm(slope(best)):
                next_best = point
            elif np.abs(step).max() <= 1e-14 * (1 + np.abs(best.weights).max()):
                break
            step = step / 2
        if next_best is None:
            break
        best = next_best
    return NewtonFit([float(w) for w in best.weights], objective(best), float(np.linalg.norm(slope(best))), passes, best.rows)
