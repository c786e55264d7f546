"""Whitened embeddings by spectrum slicing.

Vectors are put on a grid of whole numbers, ``x = floor(64 c) + 1000000``, and every distinct grid vector counts once. Sums and the
centred covariance are added up over the cluster; the covariance, whose size is that of the dimensions, is solved in the driver: the
signs of the pivots of ``V - s I = L D L'`` count the eigenvalues above ``s``, bisection by these counts isolates each leading
eigenvalue, Rayleigh quotient iteration finds it, and counts on both sides certify its number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from prefloom.sources.scratch import written

#: The grid: cells per unit, the number added, and the largest cell number on either side; entries beyond count as that.
SCALE, SHIFT, MOST = 64, 1_000_000, 1 << 53


class Factor:
    """``P A P' = L D L'`` of a symmetric matrix, with pivots of one or two rows (Bunch and Kaufman's choice)."""

    def __init__(self, a: np.ndarray) -> None:
        a = np.array(a, float)
        n, k, bound = len(a), 0, (1 + 17**0.5) / 8
        self.order, self.blocks, self.a = np.arange(n), [], a
        tiny = np.finfo(float).eps * max(float(np.abs(a).max(initial=0)), np.finfo(float).tiny)
        while k < n:
            size, pivot = 1, k
            if k < n - 1:
                below = np.abs(a[k + 1:, k])
                r = k + 1 + int(below.argmax())
                most = below[r - k - 1]
                if abs(a[k, k]) < bound * most:
                    row = np.abs(a[r, k:]).copy()
                    row[r - k] = 0
                    widest = row.max()
                    if abs(a[k, k]) * widest < bound * most * most:
                        pivot, size = (r, 1) if abs(a[r, r]) >= bound * widest else (r, 2)
            at = k + size - 1
            if pivot != at:
                a[[at, pivot]] = a[[pivot, at]]
                a[:, [at, pivot]] = a[:, [pivot, at]]
                self.order[[at, pivot]] = self.order[[pivot, at]]
            end = k + size
            if size == 1 and abs(a[k, k]) < tiny:
                a[k, k] = tiny
            block, column = a[k:end, k:end].copy(), a[end:, k:end].copy()
            lower = column / block if size == 1 else np.linalg.solve(block, column.T).T
            a[end:, end:] -= lower @ column.T
            a[end:, k:end] = lower
            self.blocks.append((k, end, block))
            k = end

    def above(self) -> int:
        """The number of eigenvalues above zero; a pivot of two rows has one of either sign."""
        return sum(1 if e - k == 2 else int(b[0, 0] > 0) for k, e, b in self.blocks)

    def solve(self, b: np.ndarray) -> np.ndarray:
        x = b[self.order].astype(float)
        for k, e, _ in self.blocks:
            x[e:] -= self.a[e:, k:e] @ x[k:e]
        for k, e, block in self.blocks:
            x[k:e] = x[k:e] / block[0] if e - k == 1 else np.linalg.solve(block, x[k:e])
        for k, e, _ in reversed(self.blocks):
            x[k:e] -= self.a[e:, k:e].T @ x[e:]
        out = np.empty_like(x)
        out[self.order] = x
        return out


def leading_eigenpairs(v: np.ndarray, most: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` leading eigenvalues of a covariance, falling, and their unit eigenvectors as columns.

    Eigenvalues that rounding cannot tell from zero are left out. Eigenvalues closer than rounding share an isolating interval; their
    vectors are made orthogonal.
    """
    d, scale = len(v), float(np.abs(v).sum(1).max(initial=0))
    values, vectors, eye, seen = [], np.zeros((d, 0)), np.eye(d), {}
    least = 8 * d * np.finfo(float).eps * scale  # what rounding cannot tell apart

    def above(s: float) -> int:
        if s not in seen:
            seen[s] = Factor(v - s * eye).above()
        return seen[s]

    for j in range(min(most, d)):
        if scale == 0 or above(least) <= j:
            break
        low, high = least, scale * (1 + 1e-12)
        for s in sorted(seen):  # the narrowest known interval around eigenvalue j + 1
            low, high = (max(low, s), high) if seen[s] > j else (low, min(high, s))
        while not (above(low) == j + 1 and above(high) == j and high - low <= 0.1 * high) and high - low > least:
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) > j else (low, middle)
        while True:
            value, vector = _rayleigh(v, vectors, (low + high) / 2, least, j)
            if low - least <= value <= high + least and above(value + least) <= j < above(value - least):
                break
            if high - low <= least:
                raise ArithmeticError(f"eigenvalue {j + 1} was not found in its interval")
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) > j else (low, middle)
        values.append(value)
        vectors = np.column_stack([vectors, vector])
    return np.array(values), vectors


def _rayleigh(v: np.ndarray, found: np.ndarray, shift: float, least: float, seed: int) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from a shift, orthogonal to what is found."""
    eye, best = np.eye(len(v)), (np.inf, shift, np.zeros(len(v)))
    x = np.random.default_rng(seed).normal(size=len(v))
    for step in range(12):
        x -= found @ (found.T @ x)
        x /= np.linalg.norm(x)
        if step > 1:  # two steps of inverse iteration first, so that the quotient starts next to its eigenvalue
            product = v @ x
            shift = float(x @ product)
            off = float(np.linalg.norm(product - shift * x))
            if off < best[0]:
                best = (off, shift, x)
            if off <= least / 8 or off > 0.5 * best[0] and off > best[0]:
                break
        y = Factor(v - shift * eye).solve(x)
        if not np.isfinite(y).all():
            break
        x = y / np.abs(y).max()
    return best[1], best[2]


def _grid(batch: pa.RecordBatch, at: int):
    """Per size of the vectors of a batch: size, rows, and ``floor(64 c)`` as a matrix."""
    column = batch.column(at)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for d in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == d)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), int(d))
        with np.errstate(over="ignore"):
            yield int(d), rows, np.clip(np.floor(flat * SCALE), -MOST, MOST).astype(np.int64)


def _packed(batches):
    """Each vector in the narrowest whole numbers that hold it, so that equal vectors have equal bytes."""
    for batch in batches:
        for d, _, y in _grid(batch, 0):
            width = np.maximum(np.abs(y).max(1), np.abs(y + 1).max(1))
            for kind, low, high in ((np.int16, 0, 1 << 15), (np.int32, 1 << 15, 1 << 31), (np.int64, 1 << 31, 1 << 62)):
                own = y[(width >= low) & (width < high)].astype(kind)
                yield pa.record_batch([pa.array(np.full(len(own), d, np.int32)), pa.array([r.tobytes() for r in own], pa.binary())], names=["d", "y"])


def _unpacked(batch: pa.RecordBatch):
    """Per size and width of packed vectors: size and matrix."""
    sizes, lengths = batch.column(0).to_numpy(), pc.binary_length(batch.column(1)).to_numpy()
    for d, length in sorted(set(zip(sizes.tolist(), lengths.tolist()))):
        rows = batch.column(1).filter(pa.array((sizes == d) & (lengths == length)))
        yield d, np.frombuffer(b"".join(rows.to_pylist()), f"<i{length // d}").reshape(-1, d).astype(np.int64)


def _sums(batches):
    """Per size: the number of vectors (at ``i = -1``), and sums as two halves, which cannot overflow."""
    high, low = {}, {}
    for batch in batches:
        for d, y in _unpacked(batch):
            y = np.column_stack([np.ones(len(y), np.int64), y])
            high[d] = high.get(d, 0) + (y >> 32).sum(0)
            low[d] = low.get(d, 0) + (y & 0xFFFFFFFF).sum(0)
    for d in high:
        yield pa.record_batch([pa.array(np.full(d + 1, d, np.int32)), pa.array(np.arange(-1, d, dtype=np.int32)), pa.array(high[d]), pa.array(low[d])],
                              names=["d", "i", "high", "low"])


def _products(change):
    """Per size: sums of the products of all pairs of coordinates of ``change(d, y)``, and of the coordinates (at ``j = -1``)."""

    def run(batches):
        total = {}
        for batch in batches:
            for d, y in _unpacked(batch):
                z = change(d, y)
                total[d] = total.get(d, 0) + np.column_stack([z.sum(0), z.T @ z])
        for d, sums in total.items():
            i, j = (x.ravel() for x in np.indices(sums.shape))
            upper = j >= np.where(j == 0, 0, i + 1)
            yield pa.record_batch([pa.array(np.full(upper.sum(), d, np.int32)), pa.array(i[upper].astype(np.int32)), pa.array((j[upper] - 1).astype(np.int32)),
                                   pa.array(sums.ravel()[upper])], names=["d", "i", "j", "s"])

    return run


def _covariances(fit: DataFrame, change, counts: dict[int, int]) -> dict[int, np.ndarray]:
    """Covariance of ``change(d, y)`` per size, with the number of vectors as divisor; the driver gets a number for each pair of coordinates."""
    rows = fit.mapInArrow(_products(change), "d int, i int, j int, s double").groupBy("d", "i", "j").agg(F.sum("s").alias("s")).toPandas()
    out = {}
    for d, part in rows.groupby("d"):
        means, pairs = part[part.j < 0].set_index("i").s.sort_index().to_numpy() / counts[d], part[part.j >= 0]
        v = np.zeros((len(means), len(means)))
        v[pairs.i, pairs.j] = pairs.s / counts[d]
        v = np.triu(v) + np.triu(v, 1).T
        out[int(d)] = v - np.outer(means, means)
    return out


@dataclass(frozen=True)
class Whitening:
    """For vectors of one size: how many distinct there are, their sums (of ``floor(64 c)``), the components as columns, the eigenvalues,
    their shares of the trace, and the largest error of the whitened covariance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def whiten(self, y: np.ndarray) -> np.ndarray:
        return (y - np.array([s / self.n for s in self.sums])) @ self.components / np.sqrt(self.values)

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n x - S)^2``; None beyond 64 bits."""
        reach = max(abs(self.n * int(e) - s) for s, ends in zip(self.sums, zip(y.min(0), y.max(0))) for e in ends)
        if len(self.sums) * reach**2 < 1 << 62 and max(map(abs, self.sums)) < 1 << 62:
            return ((self.n * y - np.array(self.sums)) ** 2).sum(1).tolist()
        exact = [sum((self.n * x - s) ** 2 for x, s in zip(row, self.sums)) for row in y.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def _finite(df: DataFrame, vector: str) -> DataFrame:
    return df.filter(F.col(vector).isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = 16) -> dict[int, Whitening]:
    """The whitening of the vectors of each size; sizes are fitted apart.

    Vectors that are null or hold null or non-finite entries are left out, and so are empty ones; repeated vectors count once. Components
    whose eigenvalue is not above rounding do not exist: none for a single distinct vector, and fewer where vectors lie in a subspace.
    """
    vectors = _finite(df.select(F.col(vector).alias("v")), "v")
    fit = written(vectors.mapInArrow(_packed, "d int, y binary").distinct(), "grid-vectors")
    totals = fit.mapInArrow(_sums, "d int, i int, high long, low long").groupBy("d", "i").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    sums: dict[int, dict[int, int]] = {}
    for row in totals:  # a row for each coordinate
        sums.setdefault(row.d, {})[row.i] = (row.high << 32) + row.low
    counts = {d: s[-1] for d, s in sums.items()}
    means = {d: np.array([s[i] / counts[d] for i in range(d)]) for d, s in sums.items()}
    models = {}
    for d, v in _covariances(fit, lambda d, y: y - means[d], counts).items():
        values, vectors = leading_eigenpairs(v, components)
        models[d] = Whitening(counts[d], tuple(sums[d][i] for i in range(d)), vectors, values, values / max(np.trace(v), np.finfo(float).tiny))
    if models:
        errors = _covariances(fit, lambda d, y: models[d].whiten(y), counts)
        for d, m in models.items():
            if len(m.values):
                models[d] = Whitening(m.n, m.sums, m.components, m.values, m.explained, float(np.abs(errors[d] - np.eye(len(m.values))).max()))
    return models


def whiten(df: DataFrame, models: dict[int, Whitening], key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(key, component int, n long, deviation long, whitened double, explained double, identity_error double)``: a row for each row and component.

    ``deviation`` is the exact sum of ``(n x - S)^2`` over the dimensions, null where 64 bits do not hold it; ``whitened`` is the centred
    vector on the component over the root of its eigenvalue. Only the key and the vector are read. Rows that ``fit_whitening`` leaves out
    have no result; null keys and repeated rows are kept; an empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(models)  # a matrix for each size of vectors

    def run(batches):
        for batch in batches:
            for d, rows, y in _grid(batch, 1):
                model = shared.value.get(d)
                if model is None or not (k := len(model.values)):
                    continue
                repeat = np.repeat(np.arange(len(rows)), k)
                deviation = pa.array(model.deviations(y), pa.int64())
                yield pa.record_batch([
                    batch.column(0).take(pa.array(rows[repeat])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(repeat), model.n)), deviation.take(pa.array(repeat)), pa.array(model.whiten(y).ravel()),
                    pa.array(np.tile(model.explained, len(rows))), pa.array(np.full(len(repeat), model.identity_error))],
                    names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = df.schema[key].dataType.simpleString()
    rows = _finite(df.select(F.col(key).alias("key"), F.col(vector).alias("v")), "v")
    return rows.mapInArrow(run, f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double").withColumnRenamed("key", key)
