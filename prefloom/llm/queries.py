"""The queries ``opN_<name>`` over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from prefloom.llm import (bpe, jaccard, katz, lexical_search, mixing, near_vectors, neighbours, quality_rules, secret_scan, substrings, toxicity,
                          whitening)
from prefloom.llm.mixing_sql import MIX_SQL
from prefloom.llm.search_sql import SEARCH_SQL
from prefloom.plans.registry import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def encoded_digests(docs: DataFrame) -> DataFrame:
    """Digests of the ids of each text and of the text they decode to."""
    encoded = bpe.decode_ids(bpe.encode_texts(docs, VOCABULARY), VOCABULARY)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.count_tokens(table(spark, sf_dir, "documents"), VOCABULARY, limit=2048)


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secret_scan.BASE]))
    return found.select("doc_id", *[count(r.kind) for r in secret_scan.BASE],
                        F.sha2(secret_scan.span_list(base).cast("binary"), 256).alias("base_sha256"), secret_scan.span_list("spans").alias("spans"))


@query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


SQL["op10_source_mix"] = MIX_SQL


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.expr("crc32(cast(doc_id as string)) % 5 = 0").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), F.size("sentences").alias("n_sentences"))


@query
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), F.size("repeats").alias("n_repeats"))


@query
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op8_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.expr("crc32(cast(doc_id as string)) % 5 = 1")
    scored = katz.score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit_whitening(vectors))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op12_lexical_search"] = SEARCH_SQL


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality_rules.score_quality(docs, quality_rules.fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.expr("crc32(cast(doc_id as string)) % 4 = 2").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), "rules")
