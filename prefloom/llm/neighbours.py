"""Approximate nearest neighbours by stable random projections.

Vectors are projected to ``dims`` dimensions by independent normal weights: the squared projected distance of two vectors, over their squared
distance, has a chi-square distribution with ``dims`` degrees of freedom. Projected points are dealt to kd-cells, and in a cell a kd-tree gives
them to a query in order of projected distance. Each is verified on the whole vectors, until the test holds: a vector nearer than the
k-th best so far would be projected that far with a chance under ``1 - confidence`` only. So each true neighbour is missed with that
chance at most. A first round in the query's own piece of its cell bounds the k-th distance; the second visits the other pieces the test cannot
rule out, and what both have found is ranked. Projections of equal vectors differ in their last bits, so the test allows for rounding.
"""

from __future__ import annotations

from math import exp

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from prefloom.llm.cells import Cells, depth_for, sample_of, sizes_of, unpacked, usable_vectors
from prefloom.sources.scratch import written

DIMS, CONFIDENCE = 8, 0.99
#: Rows of a cell's piece, and points of a leaf of its tree.
PIECE, LEAF = 8192, 64


def chi_square_quantile(p: float, dims: int) -> float:
    """The quantile for an even number of degrees of freedom, by halving an interval."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        term, total = 1.0, 1.0
        for i in range(1, dims // 2):
            term *= mid / 2 / i
            total += term
        low, high = (mid, high) if 1 - exp(-mid / 2) * total < p else (low, mid)
    return high


def _radius(bound, norm, limit: float, slack: float):
    """How far a vector within ``bound`` may be projected: by the test, and by the rounding of both projections."""
    return bound * np.sqrt(limit) + slack * (norm + bound)


class _Tree:
    """Projected points in leaves of ``LEAF``, cut at medians, with the box of each leaf."""

    def __init__(self, points: np.ndarray) -> None:
        parts, done = [np.arange(len(points))], []
        while parts:
            own = parts.pop()
            if len(own) <= LEAF:
                done.append(own)
                continue
            axis, half = int(np.ptp(points[own], axis=0).argmax()), len(own) // 2
            order = own[np.argpartition(points[own, axis], half)]
            parts += [order[:half], order[half:]]
        self.points, self.leaves = points, done
        self.low = np.array([points[x].min(0) for x in done])
        self.high = np.array([points[x].max(0) for x in done])

    def nearest(self, query: np.ndarray, vector: np.ndarray, vectors: np.ndarray, ids: np.ndarray, own, k: int, bound: float, limit: float, slack: float):
        """The verified k nearest, leaves in order of their box's projected distance, until the test holds."""
        gap = np.maximum(np.maximum(self.low - query, query - self.high), 0)
        reach = (gap * gap).sum(1)
        order = np.argsort(reach)
        best, names = np.zeros(0), np.zeros(0, ids.dtype)
        at, norm = 0, float(np.sqrt((vector * vector).sum()))
        while at < len(order) and reach[order[at]] <= _radius(bound, norm, limit, slack) ** 2:
            rows = np.concatenate([self.leaves[x] for x in order[at:at + 8]])
            at += 8
            shift = self.points[rows] - query
            rows = rows[((shift * shift).sum(1) <= _radius(bound, norm, limit, slack) ** 2) & (ids[rows] != own)]
            apart = vectors[rows] - vector
            best, names = np.concatenate([best, np.sqrt((apart * apart).sum(1))]), np.concatenate([names, ids[rows]])
            top = np.lexsort((names, best))[:k]
            best, names = best[top], names[top]
            if len(best) == k:
                bound = min(bound, float(best[-1]))
        return names, best


def _search(k: int, limit: float, slack: float, wide: bool):
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            vectors, points, ids = unpacked(rows["v"], wide), unpacked(rows["p"], True), rows["id"].to_numpy()
            tree = _Tree(points)
            asked, at = unpacked(queries["v"], wide), unpacked(queries["p"], True)
            for own, vector, query, bound in zip(queries["id"].to_numpy(), asked, at, queries["bound"].to_numpy()):
                names, far = tree.nearest(query, vector, vectors, ids, own, k, bound, limit, slack)
                out.append(pd.DataFrame({"query_id": own, "vec_id": names, "score": far}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    return run


def nearest_neighbours(df: DataFrame, is_query: Column, k: int = 10, dims: int = DIMS, confidence: float = CONFIDENCE, seed: int = 7,
                       key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank int, vec_id, score double)``: for each row with ``is_query`` its k nearest other rows by Euclidean distance, nearest
    first, ties by key; all of them if there are fewer.

    Vectors that are null, zero, or hold null or non-finite components take no part; a query's candidates are the vectors of its size, and each size is
    searched in turn. Repeated rows ask once; other vectors under one key ask too and are ranked together; rows with one key are no neighbours of each other;
    rows with a null key take no part; equal vectors are ranked by key; an empty table gives no rows. Cuts are fitted on a bounded sample, every row is indexed; a cell with more rows than a piece is split by a hash.
    """
    wide = df.schema[vector].dataType.elementType.typeName() == "double"
    ids = df.filter(F.col(key).isNotNull())
    vectors = usable_vectors(ids, key, vector)
    asked = ids.filter(is_query).select(F.col(key).alias("id")).distinct()
    found = df.select(F.col(key).alias("query_id"), F.col(key).alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    for d in sizes_of(vectors):
        found = found.unionByName(_in_one_size(vectors.filter(F.col("d") == d).drop("d"), asked, k, dims, confidence, seed, wide))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _in_one_size(vectors: DataFrame, asked: DataFrame, k: int, dims: int, confidence: float, seed: int, wide: bool) -> DataFrame:
    """``(query_id, vec_id, score)``, the nearest ones of each query among them, for vectors ``(id, v)`` all of one size."""
    spark = vectors.sparkSession
    n = vectors.count()
    sample = sample_of(vectors, wide)
    weights = np.random.default_rng(seed).standard_normal((sample.shape[1], dims))
    cells = Cells(sample @ weights, depth_for(n, PIECE))
    limit = chi_square_quantile(confidence, dims)
    # a sum of n products is off by n roundings of its terms at most; two of them, twice over
    slack = float(4 * len(weights) * np.finfo(np.float64).eps * np.linalg.norm(weights))
    sent = spark.sparkContext.broadcast((weights, cells))

    def project(batches):
        weights, cells = sent.value
        for batch in batches:
            points = unpacked(batch.column(1).to_pylist(), wide)
            points = points @ weights if len(points) else np.zeros((0, dims))
            yield pa.record_batch([*batch.columns, pa.array([p.tobytes() for p in points], pa.binary()), pa.array(cells.home(points))], names=["id", "v", "p", "cell"])

    dealt = written(vectors.mapInArrow(project, "id long, v binary, p binary, cell long"), "projected")
    pieces = dealt.groupBy("cell").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("pieces"))
    # one row per cell, at most 1024
    rows = dealt.join(F.broadcast(pieces), "cell").withColumn("piece", F.pmod(F.xxhash64("id", "v"), F.col("pieces")).cast("int"))
    queries = dealt.join(asked, "id").select(*[F.col(c).alias(c) for c in ("id", "v", "p", "cell")]).dropDuplicates(["id", "v"])
    search = _search(k, limit, slack, wide)
    shape = "query_id long, vec_id long, score double"
    first = queries.select("id", "v", "p", "cell", F.lit(0).alias("piece"), F.lit(float("inf")).alias("bound"))
    found = written(first.groupBy("cell", "piece").cogroup(rows.filter("piece = 0").groupBy("cell", "piece")).applyInPandas(search, shape), "own-piece")
    bounds = found.groupBy("query_id").agg(F.count("*").alias("c"), F.max("score").alias("far")).select(
        F.col("query_id").alias("id"), F.when(F.col("c") >= k, F.col("far")).alias("bound"))
    bounded = queries.join(bounds, "id", "left").select("id", "v", "p", F.coalesce("bound", F.lit(float("inf"))).alias("bound"), F.col("cell").alias("home"))

    def deal(batches):
        cells = sent.value[1]
        for batch in batches:
            points, bound = unpacked(batch.column(2).to_pylist(), True), batch.column(3).to_numpy()
            if len(points):
                vectors = unpacked(batch.column(1).to_pylist(), wide)
                row, cell = cells.reach(points, _radius(bound, np.sqrt((vectors * vectors).sum(1)), limit, slack))
                part = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell)], names=["id", "v", "p", "bound", "home", "cell"])

    sent_out = bounded.mapInArrow(deal, "id long, v binary, p binary, bound double, home long, cell long").join(F.broadcast(pieces), "cell")
    sent_out = sent_out.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
    sent_out = sent_out.filter("cell != home or piece != 0").drop("home")
    return found.unionByName(sent_out.groupBy("cell", "piece").cogroup(rows.groupBy("cell", "piece")).applyInPandas(search, shape))
