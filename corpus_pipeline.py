"""From raw documents to token ids: clean, deduplicate, mask, mix and encode. Each stage is written and read again by the next."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from prefloom.llm import stages
from prefloom.llm.queries import encoded_digests
from prefloom.plans.registry import table
from prefloom.sources.scratch import written


def written_order(docs: DataFrame) -> Column | None:
    """The place of each row in Parquet files as they were written: task, file of the task, row. Null in files
    that Spark has not named, None for rows that are not read from Parquet files."""
    try:
        docs.select("_metadata.row_index").schema
    except AnalysisException:
        return None
    part = lambda pattern: F.regexp_extract("_metadata.file_name", pattern, 1).try_cast("long")
    return F.shiftleft(part(r"^part-(\d+)"), 43) + F.shiftleft(part(r"-c(\d+)\."), 31) + F.col("_metadata.row_index")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number and digest of its token ids, and the digest of the text they decode to.

    Documents read from Parquet files, as the mixing stage leaves them, also keep ``position``: sorting by it gives the mixed order.
    """
    position = written_order(docs)
    if position is None:
        return encoded_digests(docs)
    placed = docs.select(F.struct("doc_id", position.alias("position")).alias("doc_id"), "text")
    return encoded_digests(placed).select("doc_id.doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "doc_id.position")


STAGES = [
    ("toxicity", stages.drop_toxic),
    ("ngram_jaccard_join", stages.drop_near_copies),
    ("secret_scan", stages.mask_secrets),
    ("source_mix", stages.mix),
    ("bpe_codec", encode),
]

#: A trained classifier, components and tokenizers are no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows come in the mixed order, which ``position`` keeps."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs.orderBy("position")
