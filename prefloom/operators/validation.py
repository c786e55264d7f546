"""Checks over whole tables, as counts per rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from prefloom.functions.text import is_blank


def dataset_info(df: DataFrame) -> DataFrame:
    """Row count with one row per field."""
    fields = F.array(*[F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("type"))
                       for f in df.schema.fields])
    return df.agg(F.count("*").alias("rows")).select("rows", F.inline(fields))


def validate_pairs(df: DataFrame, fields: tuple[str, ...] = ("chosen_text", "rejected_text")) -> DataFrame:
    """Violations per rule: empty table, absent field, wrong type, absent value, blank value."""
    types = {f.name: f.dataType for f in df.schema.fields}
    rules = [("dataset_empty", (F.count("*") == 0).cast("long"))]
    for name in fields:
        if name not in types:
            rules.append((f"{name}_missing_field", F.count("*")))
        elif not isinstance(types[name], T.StringType):
            rules.append((f"{name}_not_text", F.count("*")))
        else:
            rules.append((f"{name}_null", F.count_if(F.col(name).isNull())))
            rules.append((f"{name}_blank", F.count_if(is_blank(name))))
    return _as_rows(df, rules)


def validate_batches(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Violations per rule over padded batches with ids and masks of both sides."""
    ids = ["chosen_input_ids", "rejected_input_ids"]
    masks = ["chosen_attention_mask", "rejected_attention_mask"]
    fields = ids + masks
    absent = [c for c in fields if c not in df.columns]
    if absent:
        return _as_rows(df, [(f"{c}_missing_field", F.count("*")) for c in absent])
    checks = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in fields]
    for i, m in zip(ids, masks):
        checks.append(F.count_if(F.size(i) != F.size(m)).alias(f"shape_{i}"))
        checks.append((F.min(F.size(i)) != F.max(F.size(i))).alias(f"ragged_{i}"))
    checks.append((F.count(ids[0]) != F.count(ids[1])).alias("sizes"))
    per_batch = df.groupBy(batch).agg(*checks)
    rules = [(f"{c}_null", F.coalesce(F.sum(f"null_{c}"), F.lit(0))) for c in fields]
    for i, m in zip(ids, masks):
        rules.append((f"{i}_and_mask_differ", F.coalesce(F.sum(f"shape_{i}"), F.lit(0))))
        rules.append((f"{i}_ragged_batches", F.count_if(F.col(f"ragged_{i}"))))
    rules.append(("side_sizes_differ", F.count_if(F.col("sizes"))))
    return _as_rows(per_batch, rules)


def finite_check(df: DataFrame, vector: str, by: list[str] | None = None) -> DataFrame:
    """Number of values, NaN and infinite ones in a vector column, per group or in all."""
    values = df.select(*(by or []), F.explode(vector).alias("w"))
    w = F.col("w").cast("double")
    return values.groupBy(*(by or [])).agg(
        F.count("w").alias("n_values"),
        F.count_if(F.isnan(w)).alias("n_nan"),
        F.count_if(F.abs(w) == F.lit(float("inf"))).alias("n_inf"),
    )


def _as_rows(df: DataFrame, rules: list) -> DataFrame:
    """One aggregation pass, turned into (rule, violations) rows."""
    wide = df.agg(*[expr.cast("long").alias(name) for name, expr in rules])
    return wide.unpivot([], [name for name, _ in rules], "rule", "violations")
