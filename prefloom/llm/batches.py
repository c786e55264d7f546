"""Rows with whole texts go to Python in small Arrow batches, so that neither the JVM nor a worker holds many texts at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of a batch.
ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession, rows: int = ROWS) -> Iterator[None]:
    """Jobs started inside send at most ``rows`` rows at once; a smaller setting of the session stays as it is. Results do not depend on it."""
    before = spark.conf.get(_SETTING)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(_SETTING, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_SETTING, before)


def give_back() -> None:
    """Memory that this worker has freed goes back to the system. Workers are kept for later tasks, and what they hold on to adds to the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
