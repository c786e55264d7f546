"""Sources of raw preference pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from prefloom.operators.ordering import ordered_head

# The loader kind and source name that are accepted, and the default size.
LOADER_KIND = "preference"
KNOWN_SOURCE = "hh-rlhf"
DEFAULT_LIMIT = 5000

RAW_PAIRS = T.StructType([
    T.StructField("pair_id", T.LongType()),
    T.StructField("chosen", T.StringType()),
    T.StructField("rejected", T.StringType()),
    T.StructField("split", T.StringType()),
])


def read_raw_pairs(spark: SparkSession, path: str, fmt: str = "parquet", split: str | None = "train") -> DataFrame:
    """Raw pairs of one split. With ``split`` as a folder level only its files are read."""
    reader = spark.read.schema(RAW_PAIRS)
    df = reader.json(path) if fmt == "json" else reader.format(fmt).load(path)
    return df if split is None else df.where(F.col("split") == split)


def read_pairs(
    spark: SparkSession,
    source: str,
    path: str,
    loader: str = LOADER_KIND,
    limit: int | None = DEFAULT_LIMIT,
    fmt: str = "parquet",
    split: str | None = "train",
) -> DataFrame:
    """Resolve a source by name and read its first ``limit`` raw pairs (None: all of them)."""
    if loader != LOADER_KIND:
        raise ValueError(f"unknown loader {loader!r}: only {LOADER_KIND!r} is supported")
    if KNOWN_SOURCE not in source.lower():
        raise ValueError(f"unsupported preference source {source!r}")
    df = read_raw_pairs(spark, path, fmt, split)
    return df if limit is None else ordered_head(df, "pair_id", limit)
