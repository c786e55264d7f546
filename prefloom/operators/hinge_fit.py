"""Hinge fits of any number of features, by dual coordinate ascent in blocks of rows.

With ``P(w) = reg / 2 |w|^2 + mean(max(0, margin - w . d))`` every row has a dual variable between 0 and 1, and
``w = sum(a d) / (reg n)``. In a round each block of rows raises the dual along its own variables, one by one, against weights that no other
block changes meanwhile; the joined change is then averaged down to the length at which the dual is highest, which one number decides. The
distance of primal and dual value is the fit's own certificate: no weights are better by more than the gap.

Rows are packed into blocks once, in a table bucketed by block. A round reads that table, moves only the dual variables (one number for
each row), and the driver holds only the weights.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from prefloom.operators.newton import folded, matrix_of
from prefloom.sources.scratch import scratch_path, written

#: Bytes of features in a block.
BLOCK_BYTES = 1 << 23


@dataclass(frozen=True)
class HingeFit:
    """Weights, the primal and the dual value that belong to them, rounds, rows and blocks."""

    weights: list[float]
    primal: float
    dual: float
    rounds: int
    rows: int
    blocks: int

    @property
    def gap(self) -> float:
        return self.primal - self.dual


def _packed(size: int, block_bytes: int):
    most = max(1, block_bytes // (8 * size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows: list[np.ndarray]) -> pa.RecordBatch:
            matrix = np.concatenate(rows)
            return pa.record_batch([pa.array([uuid.uuid4().hex]), pa.array([len(matrix)]), pa.array([matrix.tobytes()], pa.binary())], names=["block", "n", "d"])

        held, n = [], 0
        for batch in batches:
            matrix = matrix_of(batch.column(0))
            while len(matrix):
                part, matrix = matrix[:most - n], matrix[most - n:]
                held.append(part)
                n += len(part)
                if n == most:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    return run


def _ascend(weights: np.ndarray, margin: float, scale: float, taken: float, seed: int, passes: int):
    """Per block: its dual variables ``a`` (with the share ``taken`` of their last change), their next change, and the sums (change of
    ``sum(a d)``, hinge loss, dual variables, and their change)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, n, d, a, last in zip(*(batch.column(i).to_pylist() for i in range(5))):
                d = np.frombuffer(d).reshape(n, -1)
                a = np.zeros(n) if a is None else np.frombuffer(a) + taken * np.frombuffer(last)
                loss, new, own, norms = np.maximum(0.0, margin - d @ weights).sum(), a.copy(), weights.copy(), np.einsum("ij,ij->i", d, d) / scale
                for k in range(passes):
                    for i in np.random.default_rng([seed, k]).permutation(n).tolist():
                        value = min(max(new[i] + (margin - d[i] @ own) / norms[i], 0.0), 1.0) if norms[i] else 1.0
                        if value != new[i]:
                            own += ((value - new[i]) / scale) * d[i]
                            new[i] = value
                change = new - a
                yield pa.record_batch([pa.array([name]), *(pa.array([x.tobytes()], pa.binary()) for x in (a, change, np.append(change @ d, [loss, a.sum(), change.sum()])))],
                                      names=["block", "a", "change", "sums"])

    return run


def _bucketed(df: DataFrame, buckets: int, name: str) -> str:
    """Write a table bucketed by block into the scratch folder; returns its name, for the caller to drop."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, "block").write.bucketBy(buckets, "block").sortBy("block").option("path", scratch_path(spark, name)).saveAsTable(table)
    return table


def fit_hinge_dual(df: DataFrame, column: str, margin: float = 1.0, reg: float = 1e-3, tol: float = 1e-6, max_rounds: int = 300, passes: int = 5,
                   block_bytes: int = BLOCK_BYTES) -> HingeFit:
    """Weights that minimize ``reg / 2 |w|^2`` plus the mean of ``max(0, margin - w . d)`` over the feature lists ``column``.

    Ends when the gap is at most ``tol`` times the primal value (or ``tol``, if larger), or after ``max_rounds`` rounds. The result does not
    depend on the order of the rows beyond the gap. ``reg`` must be above 0. Null lists are left out, lists of different lengths raise, a row of
    zeros has the loss ``margin`` whatever the weights; no rows give no weights.
    """
    if reg <= 0 or margin <= 0:
        raise ValueError("the hinge fit needs a penalty and a margin above 0")
    spark: SparkSession = df.sparkSession
    rows = df.select(F.col(column).cast("array<double>").alias("d")).where("d is not null")
    n, least, most = rows.agg(F.count("*"), F.min(F.size("d")), F.max(F.size("d"))).first()
    if not n:
        return HingeFit([], 0.0, 0.0, 0, 0, 0)
    if least != most:
        raise ValueError(f"feature lists have {least} to {most} entries")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # mixed rows make blocks alike, and full ones few
    mixed = rows.repartition(-(-n * 8 * most // block_bytes))
    packed = written(mixed.mapInArrow(_packed(most, block_bytes), "block string, n long, d binary"), "hinge-rows")
    table = _bucketed(packed, buckets, "hinge_blocks")
    blocks, features = packed.count(), spark.table(table)
    total, duals, rounds, scale, taken = np.zeros(most), None, 0, reg * n, 0.0
    try:
        while True:
            w = total / scale
            none = F.lit(None).cast("binary")
            met = features.withColumns({"a": none, "change": none}) if duals is None else features.join(duals, "block", "left")
            run = _ascend(w, margin, scale, taken, rounds, passes)
            out = written(met.select("block", "n", "d", "a", "change").mapInArrow(run, "block string, a binary, change binary, sums binary"), "hinge-duals")
            sums = folded(out.select("sums"), blocks, most + 3)
            step, (loss, held, more) = sums[:-3], sums[-3:]
            primal, dual = reg / 2 * float(w @ w) + loss / n, margin * held / n - reg / 2 * float(w @ w)
            if primal - dual <= tol * max(1.0, primal) or rounds == max_rounds:
                return HingeFit([float(x) for x in w], float(primal), float(dual), rounds, n, blocks)
            bend = float(step @ step) / scale
            taken = min(1.0, max(0.0, (margin * more - float(w @ step)) / bend)) if bend else 1.0
            total, duals, rounds = total + taken * step, out.select("block", "a", "change"), rounds + 1
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
