"""Named queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; without SQL it is checked by the tests."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns, as engines add them up in different orders."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in doubles}) if doubles else df


def listed(col: Column | str) -> Column:
    """An array as comma-separated text."""
    col = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ",")
