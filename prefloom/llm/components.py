"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prefloom.sources.scratch import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an edge table ``(a, b)`` of longs; the component is its smallest node.

    Every round is a minimum per node and a join, so no neighbourhood is gathered in one place; its result is written to the
    shared folder. Rows stay linear in the edges. Self-loops and repeated edges do no harm; an empty table gives no rows.
    """
    current = written(edges.filter("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(current)
    for _ in range(rounds):
        if not before[0]:
            break
        # large star: all larger neighbours of a node go to the smallest of its neighbourhood
        both = _both_ways(current)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(
            least.select("a", F.col("m").alias("b"))).distinct()
        current = written(small, "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    return current.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
