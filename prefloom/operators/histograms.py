"""Equal-width histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prefloom.functions.text import n_words
from prefloom.operators.alignment import one_row
from prefloom.operators.columns import once
from prefloom.sources.scratch import written


def histogram(df: DataFrame, value: str, bins: int, weight: str | None = None) -> DataFrame:
    """Counts per bin between the smallest and largest finite value; the last bin is closed.

    If all values are equal there is one bin. Bins without values are left out.
    ``weight`` is the number of values a row stands for.
    """
    x = F.col(value).cast("double")
    count = F.lit(1).cast("long") if weight is None else F.col(weight)
    finite = df.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))).select(x.alias("x"), count.alias("n"))
    edges = one_row(finite.agg(F.min("x").alias("low"), F.max("x").alias("high")))
    placed = finite.withColumn("e", edges)
    raw = F.width_bucket("x", F.col("e.low"), F.col("e.high"), F.lit(bins))
    bucket = F.when(F.col("e.low") == F.col("e.high"), F.lit(1)).otherwise(F.least(raw, F.lit(bins)))
    counts = placed.groupBy(bucket.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    width = (F.col("e.high") - F.col("e.low")) / bins
    return counts.withColumn("e", edges).select(
        "bin", (F.col("e.low") + (F.col("bin") - 1) * width).alias("bin_start"), "n")


def length_histogram(df: DataFrame, text: str, bins: int = 30) -> DataFrame:
    """Histogram of words per text.

    Texts are read once: the counts of equal lengths, a short table, are written first.
    """
    counted = once(df.select(text), {"n_words": n_words(text)})
    lengths = counted.groupBy("n_words").agg(F.count("*").alias("texts"))
    return histogram(written(lengths, "lengths"), "n_words", bins, weight="texts")
