"""Order, batches, splits and caps, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from prefloom.functions.numeric import piece_of
from prefloom.sources.scratch import written

# Tables of bucket counts never exceed this many rows.
_BUCKET_BITS = 16


def prefix_cutoff(df: DataFrame, key: str, target: int) -> int | None:
    """The smallest integer key up to which (inclusive) at least ``target`` rows lie.

    Radix selection: each pass counts rows per key range (partial aggregation on
    the scan, at most 65,536 result rows) and descends into the range where the
    running count passes ``target``. Rows are neither sorted nor shuffled, and a
    64-bit key needs at most four passes. None if the table has fewer rows.
    """
    if target <= 0:
        raise ValueError("target must be positive")
    low, high, rows = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if rows < target:
        return None
    shift = 0
    while (high >> shift) - (low >> shift) >= 1 << _BUCKET_BITS:
        shift += _BUCKET_BITS
    before = 0
    running = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    while True:
        counts = (
            df.where(F.col(key).between(low, high))
            .groupBy(F.shiftright(F.col(key).cast("long"), shift).alias("bucket")).agg(F.count("*").alias("n"))
        )
        hit = (
            counts.withColumn("upto", F.sum("n").over(running))
            .where(F.col("upto") >= target - before).orderBy("bucket").first()
        )
        if shift == 0:
            return hit["bucket"]
        before += hit["upto"] - hit["n"]
        low, high = hit["bucket"] << shift, ((hit["bucket"] + 1) << shift) - 1
        shift -= _BUCKET_BITS


def ordered_head(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``min(n, rows)`` rows by a unique integer key.

    The result is a key filter, so it is pushed down to the scan.
    """
    if n <= 0:
        return df.limit(0)
    cutoff = prefix_cutoff(df, key, n)
    return df if cutoff is None else df.where(F.col(key) <= cutoff)


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """A short ordered sample from the front (report rows)."""
    return df.orderBy(key).limit(n)


def last_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """A short ordered sample from the end, in ascending order."""
    return df.orderBy(F.col(key).desc()).limit(n).orderBy(key)


def ordered_split(df: DataFrame, key: str, fraction: float = 0.8) -> DataFrame:
    """Mark the first ``int(fraction * rows)`` rows by a unique integer key as 'train', the rest as 'eval'."""
    size = int(fraction * df.count())
    cutoff = prefix_cutoff(df, key, size) if size > 0 else None
    inside = F.lit(False) if cutoff is None else F.col(key) <= cutoff
    return df.withColumn("part", F.when(inside, F.lit("train")).otherwise(F.lit("eval")))


def dense_index(df: DataFrame, keys: list[str], name: str = "idx") -> DataFrame:
    """0-based position of each row in the order of ``keys`` (which must be unique).

    One range shuffle; the sorted ranges are written to the shared folder with
    their part number and place, so the second pass only adds the sizes of the
    parts before. The offset table has one row per part, so it is broadcast.
    """
    in_part = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    parts = written(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id()).withColumn("_place", in_part),
        "ordered")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part").agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        parts.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place")).drop("_part", "_place", "_offset")
    )


def assign_batches(df: DataFrame, keys: list[str], batch_size: int) -> DataFrame:
    """Consecutive groups of ``batch_size`` rows; the last one may be smaller."""
    indexed = dense_index(df, keys)
    return indexed.withColumn("batch_id", piece_of("idx", batch_size))


def epoch_shuffle(df: DataFrame, key: str, seed: int, epoch: int) -> DataFrame:
    """The 0-based ``position`` of each row in a repeatable random order, different for each epoch; ``key`` must be unique."""
    order = F.md5(F.concat_ws(":", F.lit(seed), F.lit(epoch), F.col(key).cast("string")))
    return dense_index(df.withColumn("_order", order), ["_order", key], "position").drop("_order")


def every_kth_step(df: DataFrame, k: int, step: Column | str = "step") -> DataFrame:
    step = F.col(step) if isinstance(step, str) else step
    return df.where(step % k == 0)


def cap_rollouts(df: DataFrame, cap: int, batch: str = "batch_id") -> DataFrame:
    """Whole batches in order until their running row count reaches ``cap``."""
    return ordered_head_by_group(df, batch, cap)


def ordered_head_by_group(df: DataFrame, group: str, n: int) -> DataFrame:
    """Groups in key order while the rows before them number less than ``n``."""
    if n <= 0:
        return df.limit(0)
    cutoff = prefix_cutoff(df, group, n)
    return df if cutoff is None else df.where(F.col(group) <= cutoff)
