"""Tables written to the shared checkpoint folder, to fix a result and cut its lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a row group: writers hold one in the heap, readers one of each column they read.
ROW_GROUP = 32 << 20
_local_folders: dict[str, str] = {}


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, or the folder set on its context; an own one only in local mode without both."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_folders:
        _local_folders[sc.applicationId] = tempfile.mkdtemp(prefix="prefloom-")
    return _local_folders[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    root = checkpoint_folder(spark)
    return f"{root}/prefloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and return the table read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
