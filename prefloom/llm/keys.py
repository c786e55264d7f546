"""Semi-joins of wide rows with a key set: a bit field of fixed size drops most other rows before they are shuffled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Bits of the field, 1 MB whatever the number of keys; a fuller field only lets more rows through to the join.
BITS = 1 << 23


def _spot(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def _field(keys: DataFrame, key: str):
    """The keys as a bit field of fixed size, sent to all tasks."""
    cells = keys.select(_spot(key).alias("p")).select(F.shiftright("p", 3).alias("byte"), F.expr("shiftleft(1, cast(p & 7 as int))").alias("bit"))
    used = cells.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toPandas()
    field = np.zeros(BITS // 8, np.uint8)
    field[used["byte"].to_numpy().astype(np.int64)] = used["bits"].to_numpy().astype(np.uint8)
    return keys.sparkSession.sparkContext.broadcast(field)


def _marked(df: DataFrame, sent, key: str, wanted: bool) -> DataFrame:
    columns = df.columns

    def run(batches):
        for batch in batches:
            spot = batch.column(len(columns)).to_numpy()
            held = ((sent.value[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1).astype(bool)
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=columns).filter(pa.array(held == wanted))

    return df.withColumn("_spot", _spot(key).cast("long")).mapInArrow(run, df.schema)


def only_keys(df: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """The rows of ``df`` whose long ``key`` is among ``keys``; rows with a null key go."""
    near = _marked(df.filter(F.col(key).isNotNull()), _field(keys, key), key, True)
    return near.join(keys.select(key).distinct(), key, "left_semi")


def split_keys(df: DataFrame, keys: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` in two parts: those whose ``key`` may be among ``keys``, and those whose key is not. Every row is in one of them."""
    sent = _field(keys, key)
    return _marked(df, sent, key, True), _marked(df, sent, key, False)
