"""Stages of a corpus pipeline: each takes documents and returns what stays of them, with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from prefloom.llm.jaccard import jaccard_join
from prefloom.llm.keys import only_keys, split_keys
from prefloom.llm.mixing import mixed_rows
from prefloom.llm.secret_scan import redact_secrets
from prefloom.llm.toxicity import fit_toxicity, without_toxic
from prefloom.plans.registry import table
from prefloom.sources.scratch import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half."""
    return without_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest key; of repeated rows one; rows with a null key all stay.

    Rows whose key is surely that of one document without copies, or of the first of its group, stay where they are; only the others are moved.
    """
    labels = written(jaccard_join(docs), "near-copies")
    kept = labels.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("c"))
    copies = labels.filter("doc_id is not null and not doc_id <=> component_id").select("doc_id")
    maybe, alone = split_keys(docs.filter("doc_id is not null"), copies.unionByName(kept.filter("c > 1").select("doc_id")), "doc_id")
    met = only_keys(maybe, kept.select("doc_id"), "doc_id").dropDuplicates(["doc_id", "text"])
    return alone.unionByName(met).unionByName(docs.filter("doc_id is null"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind and ``n_chars`` counted anew."""
    out = redact_secrets(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order that mixes their sources to the target weights."""
    return mixed_rows(docs)
