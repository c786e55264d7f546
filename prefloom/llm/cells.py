"""Cells of a low-dimensional space: a kd-tree of cuts fitted on a bounded sample, to deal points and balls out to tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from prefloom.sources.scratch import written

#: Points on which cuts are fitted; every point is then dealt out by them.
SAMPLE = 8192


class Cells:
    """A complete binary tree of cuts at medians, each along the coordinate of the largest spread."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        self.depth, dims = depth, sample.shape[1]
        self.axis, self.at = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1)
        self.low, self.high = np.full((2**(depth + 1) - 1, dims), -np.inf), np.full((2**(depth + 1) - 1, dims), np.inf)
        parts = [sample]
        for node in range(2**depth - 1):
            own = parts[node]
            if len(own):
                self.axis[node] = int(own.var(0).argmax())
                self.at[node] = np.median(own[:, self.axis[node]])
            a, c = self.axis[node], self.at[node]
            for child in (2 * node + 1, 2 * node + 2):
                self.low[child], self.high[child] = self.low[node], self.high[node]
            self.high[2 * node + 1, a] = c
            self.low[2 * node + 2, a] = c
            parts += [own[own[:, a] < c], own[own[:, a] >= c]]

    def home(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] >= self.at[node])
        return node - (2**self.depth - 1)

    def reach(self, points: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (point, cell) with the cell's box not farther from the point than its radius."""
        row, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            row, node = np.concatenate([row, row]), np.concatenate([2 * node + 1, 2 * node + 2])
            gap = np.maximum(np.maximum(self.low[node] - points[row], points[row] - self.high[node]), 0)
            keep = (gap * gap).sum(1) <= radius[row] ** 2
            row, node = row[keep], node[keep]
        return row, node - (2**self.depth - 1)


def depth_for(n: int, each: int, most: int = 10) -> int:
    """Cuts in turn so that a cell of evenly dealt points holds about ``each``."""
    return max(0, min(most, int(np.ceil(np.log2(max(n, 1) / each)))))


def usable_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, d, v)``: the vectors whose components are finite and not all zero, packed as doubles or floats, with their size ``d``."""
    x = F.col(vector)
    good = df.select(F.col(key).alias("id"), x.alias("x")).filter(
        F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists("x", lambda c: c != 0))
    kind = np.dtype(np.float64 if df.schema[vector].dataType.elementType.typeName() == "double" else np.float32)

    def run(batches):
        for batch in batches:
            raw = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind).tobytes()
            size = batch.column(2).to_numpy()
            ends = np.cumsum(size, dtype=np.int64) * kind.itemsize
            packed = [raw[b - d * kind.itemsize:b] for b, d in zip(ends.tolist(), size.tolist())]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(packed, pa.binary())], names=["id", "d", "v"])

    sized = good.select("id", "x", F.size("x").alias("d"))
    return written(sized.mapInArrow(run, f"id {df.schema[key].dataType.simpleString()}, d int, v binary"), "vectors")


def sizes_of(vectors: DataFrame) -> list[int]:
    """The sizes in use, in order; a table holds few."""
    return sorted(r.d for r in vectors.select("d").distinct().collect())


def unpacked(column, wide: bool) -> np.ndarray:
    """Packed vectors as rows of doubles."""
    values = list(column)
    raw = np.frombuffer(b"".join(values), np.float64 if wide else np.float32)
    return raw.reshape(len(values), -1).astype(np.float64) if values else np.zeros((0, 1))


def sample_of(vectors: DataFrame, wide: bool, size: int = SAMPLE) -> np.ndarray:
    """At most ``size`` vectors, chosen by a hash."""
    return unpacked([r[0] for r in vectors.select("v").orderBy(F.xxhash64("v")).limit(size).collect()], wide)
