"""Adding columns that are costly to work out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def once(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Add columns that are worked out once per row.

    A one-element generator keeps later filters and projections from copying the
    expressions to each place where the result is used.
    """
    row = F.struct(*[c.alias(n) for n, c in values.items()])
    return df.select("*", F.inline(F.array(row)))
