"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors are rotated and split into blocks of ``width`` coordinates. Cosine c means a squared distance of ``2 - 2c``; if each block gets a
share of that budget in proportion to its width, some block of a linked pair stays within its share. So each block is joined by range on its
own: cells of the block's space take their own points and every point within the share's radius, and pairs within the share are candidates.
A pair counts in its first such block only; candidates are verified on the whole vectors in double precision.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from prefloom.llm.cells import Cells, depth_for, sample_of, sizes_of, unpacked, usable_vectors
from prefloom.llm.components import components
from prefloom.sources.scratch import written

#: Points at home in one unit of work, points compared with them there, and rows of a tile.
HOME, OTHER, TILE = 16_384, 16_384, 512


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


def _within(home: np.ndarray, other: np.ndarray, share: float) -> np.ndarray:
    """Pairs within the share, by one product in single precision; its rounding is allowed for."""
    left = np.column_stack([-2 * home, (home * home).sum(1), np.ones(len(home))]).astype(np.float32)
    right = np.column_stack([other, np.ones(len(other)), (other * other).sum(1)]).astype(np.float32)
    return left @ right.T <= np.float32(share + 1e-5)


def _spanning(x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges to the smallest row of each connected group of the pairs, instead of all pairs."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = new[new]
        if (new == root).all():
            moved = np.flatnonzero(root != np.arange(n))
            return moved, root[moved]
        root = new


def _links(shared, cosine: float, width: int, wide: bool):
    """Links of the points at home with the others of a unit: their number by weight, and edges that connect the same points."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        turn = shared.value[0]
        block = int(frame["block"].iat[0])
        whole = _unit(unpacked(frame["v"], wide))
        turned = whole @ turn
        cuts = [slice(k, k + width) for k in range(0, whole.shape[1], width)]
        shares = [(2 - 2 * cosine) * len(range(whole.shape[1])[c]) / whole.shape[1] for c in cuts]
        node, weight = frame["node"].to_numpy(), frame["weight"].to_numpy()
        home, other = np.flatnonzero(frame["side"].to_numpy() == 0), np.flatnonzero(frame["side"].to_numpy() == 1)
        nodes, counts, edges = [], [], []
        for k in range(0, len(home), TILE):
            own = home[k:k + TILE]
            near = _within(turned[own][:, cuts[block]], turned[other][:, cuts[block]], shares[block])
            x, y = np.nonzero(near)
            good = np.zeros(len(x), bool)
            for at in range(0, len(x), 50_000):
                a, b = own[x[at:at + 50_000]], other[y[at:at + 50_000]]
                fits = node[a] != node[b]
                gap = turned[a] - turned[b]
                gap *= gap
                # one rule for both directions of a pair, so that it counts in one block; the allowance is that of the filter
                for j in range(block):
                    fits &= gap[:, cuts[j]].sum(1) > shares[j] + 1e-6
                fits &= gap[:, cuts[block]].sum(1) <= shares[block] + 1e-6
                fits[fits] = (whole[a[fits]] * whole[b[fits]]).sum(1) >= cosine
                good[at:at + 50_000] = fits
            x, y = x[good], y[good]
            if len(x):
                total = np.bincount(x, weight[other[y]], len(own))
                nodes.append(node[own[total > 0]])
                counts.append(total[total > 0].astype(np.int64))
                rows, values = np.unique(np.concatenate([node[own[x]], node[other[y]]]), return_inverse=True)
                a, b = _spanning(values[:len(x)], values[len(x):], len(rows))
                edges.append((rows[a], rows[b]))
        linked = [pd.DataFrame({"node": n, "links": c, "to": n}) for n, c in zip(nodes, counts)]
        joined = [pd.DataFrame({"node": a, "links": np.zeros(len(a), np.int64), "to": b}) for a, b in edges]
        return pd.concat(linked + joined) if linked else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("node", "links", "to")})

    return run


def near_vectors(df: DataFrame, cosine: float = 0.9, width: int = 16, seed: int = 11, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(key, n_links long, component_id, kept boolean)`` for every row: other rows with at least this cosine, the smallest key reachable by
    links, and whether the row is it.

    Vectors that are null, zero, or hold null or non-finite components link with nothing; vectors of different sizes do not link, and those of each size
    are joined in turn. Equal vectors are one point with their number as its weight; rows with one key are rows of their own; a null key stays null; an
    empty table gives no rows. Pairs are counted where they are found and leave a unit of work only as counts and connecting edges. A cell with more
    points than a unit is split on both sides.
    """
    wide = df.schema[vector].dataType.elementType.typeName() == "double"
    rows = usable_vectors(df, key, vector)
    used = df.select(F.col(key).alias("id"), F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id")).limit(0)
    for d in sizes_of(rows):
        used = used.unionByName(_of_one_size(rows.filter(F.col("d") == d).drop("d"), cosine, width, seed, wide))
    # rows without a usable vector, by their number for each key
    rest = df.groupBy(F.col(key).alias("id")).count().join(rows.groupBy(F.col("id").alias("i")).agg(F.count("*").alias("u")), F.col("id").eqNullSafe(F.col("i")), "left")
    rest = rest.withColumn("more", F.col("count") - F.coalesce("u", F.lit(0))).filter("more > 0").select(
        "id", F.explode(F.sequence(F.lit(1).cast("long"), "more")).alias("_")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return used.unionByName(rest).select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _of_one_size(vectors: DataFrame, cosine: float, width: int, seed: int, wide: bool) -> DataFrame:
    """``(id, n_links, component_id)`` for every row of ``(id, v)``, all of one size."""
    spark = vectors.sparkSession
    rows = vectors.withColumn("node", F.xxhash64("v"))
    points = written(rows.groupBy("node").agg(F.first("v").alias("v"), F.count("*").alias("weight")), "points")
    n = points.count()
    sample = _unit(sample_of(points, wide))
    dims = sample.shape[1]
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))[0]
    cuts = [slice(k, k + width) for k in range(0, dims, width)]
    trees = [Cells((sample @ turn)[:, c], depth_for(n, HOME)) for c in cuts]
    shared = spark.sparkContext.broadcast((turn, trees))
    radii = [np.sqrt((2 - 2 * cosine) * len(range(dims)[c]) / dims + 1e-5) for c in cuts]

    def deal(batches):
        turn, trees = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            turned = _unit(unpacked(batch.column(1).to_pylist(), wide)) @ turn
            for block, (c, tree, radius) in enumerate(zip(cuts, trees, radii)):
                home = tree.home(turned[:, c])
                row, cell = tree.reach(turned[:, c], np.full(len(turned), radius))
                for side, r, at in ((0, np.arange(len(turned)), home), (1, row, cell)):
                    part = batch.take(pa.array(r))
                    yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(np.broadcast_to(x, len(r)).astype(np.int32)) for x in (block, at, side))],
                                                     names=["node", "v", "weight", "block", "cell", "side"])

    dealt = points.select("node", "v", "weight").mapInArrow(deal, "node long, v binary, weight long, block int, cell int, side int")
    # one row per block and cell, at most 1024 cells to a block
    sizes = dealt.groupBy("block", "cell").agg(
        F.ceil(F.sum(1 - F.col("side")) / HOME).cast("int").alias("homes"), F.ceil(F.sum("side") / OTHER).cast("int").alias("others"))
    sized = dealt.join(F.broadcast(sizes), ["block", "cell"]).filter("homes > 0")
    spot = lambda c: F.pmod(F.xxhash64("node", F.lit(1)), F.col(c)).cast("int")
    units = sized.withColumn("h", F.when(F.col("side") == 0, F.array(spot("homes"))).otherwise(F.sequence(F.lit(0), F.col("homes") - 1))).withColumn(
        "o", F.when(F.col("side") == 1, F.array(spot("others"))).otherwise(F.sequence(F.lit(0), F.col("others") - 1)))
    units = units.withColumn("h", F.explode("h")).withColumn("o", F.explode("o")).drop("homes", "others")
    found = units.groupBy("block", "cell", "h", "o").applyInPandas(_links(shared, cosine, width, wide), "node long, links long, to long")
    found = written(found, "vector-links")
    labels = components(found.filter("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = rows.select("id", "node").join(points.select("node", "weight"), "node").join(counts, "node", "left").join(labels, "node", "left")
    known = known.withColumn("root", F.coalesce("component", "node"))
    least = known.groupBy("root").agg(F.min("id").alias("least"))
    return known.join(least, "root").select("id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("least", "id").alias("component_id"))
