"""Sinks for training logs and sample tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from prefloom.functions.text import preview


def long_metrics(df: DataFrame, ids: list[str], names: list[str]) -> DataFrame:
    """One row per named number of a step; absent numbers are left out."""
    numbers = df.select(*ids, *[F.col(n).cast("double").alias(n) for n in names])
    return numbers.unpivot(ids, names, "name", "num_value").where(F.col("num_value").isNotNull())


def append_metrics(df: DataFrame, path: str, folders: int | None = None) -> None:
    """Append step metrics, one folder per run; with ``folders``, all runs share that many folders.

    Rows of a folder are brought together, to avoid a file per task and folder; the
    rebalance hint lets adaptive execution split a folder that is too large. A folder
    per run suits logs of few runs: each takes a file per write, which the driver commits and
    lists. Shared folders hold runs by hash and in order, so one run is still found by the statistics of its files.
    ``read_metrics`` reads them.
    """
    if folders is None:
        df.hint("rebalance", "run_id").write.mode("append").partitionBy("run_id").parquet(path)
        return
    shared = df.withColumn("run_part", F.pmod(F.hash("run_id"), F.lit(folders))).hint("rebalance", "run_part")
    shared.sortWithinPartitions("run_part", "run_id").write.mode("append").partitionBy("run_part").parquet(path)


def read_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows that ``append_metrics`` wrote to shared folders; ``schema`` is that of the written rows."""
    return spark.read.schema(f"{schema}, run_part int").parquet(path).drop("run_part")


def sample_table(df: DataFrame, idx: Column | str, prompt: str = "prompt", response: str = "response") -> DataFrame:
    idx = F.col(idx) if isinstance(idx, str) else idx
    return df.select(
        idx.alias("idx"), preview(prompt, 100).alias("prompt"), preview(response, 200).alias("response"))


def append_samples(df: DataFrame, path: str, idx: Column | str, **columns: str) -> None:
    """Append a sample table of prompt and response previews."""
    sample_table(df, idx, **columns).write.mode("append").parquet(path)


# --- writes that count once ----------------------------------------------------

def append_once(df: DataFrame, path: str, write_id: str) -> bool:
    """Append rows under a write's own name; a write whose name is in the manifest already changes nothing and gives False.

    The rows are staged in a folder of the write's name, which a retry replaces, and count from the moment the manifest names the write.
    So a write that broke off leaves nothing to be read, and one that is repeated or retried counts once.
    """
    spark = df.sparkSession
    done = _manifest(spark, path)
    if done is not None and done.where(F.col("write_id") == write_id).limit(1).count():
        return False
    df.write.mode("overwrite").parquet(f"{path}/rows/write_id={write_id}")
    spark.createDataFrame([(write_id,)], "write_id string").coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return True


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema("write_id string").parquet(f"{path}/manifest")
    except AnalysisException:
        return None


def read_once(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all writes that the manifest names; ``schema`` is that of the written rows. Nothing written gives no rows.

    Folders of other writes are pruned by the names in the manifest.
    """
    done = _manifest(spark, path)
    if done is None:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, write_id string").option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return rows.join(done.distinct(), "write_id", "left_semi").drop("write_id")
