"""Queries: text metrics and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from prefloom.operators import histograms, text_metrics as M, validation
from prefloom.plans import inputs as I
from prefloom.plans.registry import registered, rounded, table

BINS = 20


def _document_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.pair_by_item(*I.documents_and_references(spark, sf_dir))


@registered(f"WITH {I.DOCUMENT_PAIRS_SQL} SELECT item_id, md5(prediction) AS prediction, md5(reference) AS reference FROM text_pairs")
def aligned_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _document_pairs(spark, sf_dir)
    return df.select("item_id", F.md5("prediction").alias("prediction"), F.md5("reference").alias("reference"))


def _bleu_tokens_sql(x: str) -> str:
    for old, new in M.BLEU_RULES:
        old, new = (s.replace("'", "''").replace("\n", "' || chr(10) || '") for s in (old, new))
        x = f"replace({x}, '{old}', '{new}')"
    x = f"(' ' || {x} || ' ')"
    for pattern, new in M.BLEU_PATTERNS:
        pattern = pattern.replace("`!-", "` -")  # as published, with the blank
        new = new.replace("$1", r"\1").replace("$2", r"\2")
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    return I.words_sql(x)


def grams_sql(source: str, s: str = "") -> str:
    """N-gram counts of ``source (item_id, prediction, reference)``; table names end in ``s``."""
    return f"""
t{s} AS MATERIALIZED (SELECT item_id, {_bleu_tokens_sql('prediction')} AS p, {_bleu_tokens_sql('reference')} AS r FROM {source}),
sides{s} AS (SELECT item_id, 0 AS side, p AS w FROM t{s} UNION ALL SELECT item_id, 1, r FROM t{s}),
one{s} AS MATERIALIZED (SELECT item_id, side, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM sides{s}),
ahead{s} AS MATERIALIZED (
  SELECT item_id, side, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4 FROM one{s}
  WINDOW o AS (PARTITION BY item_id, side ORDER BY i)),
grams{s} AS (
  SELECT item_id, side, 1 AS n, w AS gram FROM ahead{s}
  UNION ALL SELECT item_id, side, 2, w || ' ' || w2 FROM ahead{s} WHERE w2 IS NOT NULL
  UNION ALL SELECT item_id, side, 3, w || ' ' || w2 || ' ' || w3 FROM ahead{s} WHERE w3 IS NOT NULL
  UNION ALL SELECT item_id, side, 4, w || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM ahead{s} WHERE w4 IS NOT NULL),
counted{s} AS (
  SELECT item_id, n, gram, count(*) FILTER (side = 0) AS cp, count(*) FILTER (side = 1) AS cr FROM grams{s} GROUP BY ALL),
by_order{s} AS (
  SELECT n::INT AS n, sum(least(cp, cr))::BIGINT AS matched, sum(cp)::BIGINT AS total, sum(cr)::BIGINT AS total_ref
  FROM counted{s} GROUP BY n)"""


def bleu_sql(source: str, s: str = "") -> str:
    """The same and ``bleu{s}``, one row."""
    return f"""{grams_sql(source, s)},
halved{s} AS (SELECT *, sum((matched = 0)::INT) OVER (ORDER BY n) AS zeros FROM by_order{s}),
logs{s} AS (SELECT sum(ln(100.0 * CASE WHEN matched > 0 THEN matched ELSE pow(2.0, -zeros) END / total)) / 4 AS l,
  sum(matched) AS hits, count(*) AS orders, max(total) FILTER (n = 1) AS lp, max(total_ref) FILTER (n = 1) AS lr FROM halved{s}),
bleu{s} AS (SELECT CASE WHEN hits = 0 OR orders < 4 THEN 0.0
  ELSE CASE WHEN lp >= lr THEN 1.0 ELSE exp(1 - lr / lp::DOUBLE) END * exp(l) END AS bleu FROM logs{s})"""


_GRAMS_SQL = f"{I.DOCUMENT_PAIRS_SQL},{grams_sql('text_pairs')}"


@registered(f"WITH {_GRAMS_SQL} SELECT n, matched, total, total_ref FROM by_order")
def bleu_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.bleu_counts(_document_pairs(spark, sf_dir))


_BLEU_SQL = f"{I.DOCUMENT_PAIRS_SQL},{bleu_sql('text_pairs')}"


@registered(f"WITH {_BLEU_SQL} SELECT round(bleu, 6) + 0.0 AS bleu FROM bleu")
def corpus_bleu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.corpus_bleu(_document_pairs(spark, sf_dir)))


@registered()
def rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.rouge_l(_document_pairs(spark, sf_dir)))


@registered()
def rouge_l_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unstemmed scores per item."""
    return rounded(M.rouge_l_scores(_document_pairs(spark, sf_dir), stemming=False))


_MATCH_SQL = f"""{I.TOKEN_VECTORS_SQL},
sims AS (SELECT item_id, p.pos AS i, r.pos AS j, list_cosine_similarity(p.vec, r.vec) AS s
  FROM vectors_p p JOIN vectors_r r USING (item_id)),
prec AS (SELECT item_id, avg(m) AS p FROM (SELECT item_id, i, max(s) AS m FROM sims GROUP BY ALL) GROUP BY item_id),
rec AS (SELECT item_id, avg(m) AS r FROM (SELECT item_id, j, max(s) AS m FROM sims GROUP BY ALL) GROUP BY item_id),
scores AS (SELECT item_id, p, r, CASE WHEN p + r <> 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM prec JOIN rec USING (item_id))"""


@registered(f"""WITH {_MATCH_SQL} SELECT item_id, round(p, 6) + 0.0 AS precision, round(r, 6) + 0.0 AS recall, round(f1, 6) + 0.0 AS f1 FROM scores""")
def embedding_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small blocks, so that items of the test data span several of them."""
    return rounded(M.embedding_match_scores(*I.token_vectors(spark, sf_dir), block=8))


@registered(f"""WITH {_BLEU_SQL}, {_MATCH_SQL.replace('prec AS', 'prec_ AS').replace('FROM prec ', 'FROM prec_ ')}
SELECT 'bleu' AS metric, round(bleu, 6) + 0.0 AS value FROM bleu UNION ALL
SELECT 'bertscore', round(avg(f1), 6) + 0.0 FROM scores""")
def selected_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.compute_all(
        _document_pairs(spark, sf_dir), ["bleu", "bertscore"], I.token_vectors(spark, sf_dir)))


@registered(f"""WITH {I.TOKEN_LOGITS_SQL} SELECT round(exp(avg(-logprob)), 6) + 0.0 AS perplexity,
  round(avg(-logprob), 6) + 0.0 AS loss FROM token_stats WHERE pos % 4 <> 3""")
def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth position carries the ignored label."""
    policy, _ = I.token_logits(spark, sf_dir)
    label = F.when(F.col("pos") % 4 == 3, M.IGNORED_LABEL).otherwise(F.col("token_id"))
    return rounded(M.perplexity(policy.withColumn("label", label)))


def _histogram_sql(source: str, bins: int) -> str:
    return f"""x AS ({source}), e AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
b AS (SELECT CASE WHEN lo = hi THEN 1 ELSE least(floor((x - lo) / (hi - lo) * {bins}) + 1, {bins}) END::INT AS bin, lo, hi FROM x, e)
SELECT bin, round(lo + (bin - 1) * ((hi - lo) / {bins}), 6) + 0.0 AS bin_start, count(*) AS n FROM b GROUP BY ALL"""


@registered("WITH " + _histogram_sql("SELECT value AS x FROM events", BINS))
def value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(histograms.histogram(table(spark, sf_dir, "events"), "value", BINS))


@registered("WITH " + _histogram_sql(f"SELECT len({I.words_sql('text')})::DOUBLE AS x FROM documents", 30))
def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(histograms.length_histogram(table(spark, sf_dir, "documents"), "text"))


@registered("""WITH v AS (SELECT label, unnest(embedding)::DOUBLE AS w FROM embeddings)
SELECT label, count(*) AS n_values, count(*) FILTER (isnan(w)) AS n_nan, count(*) FILTER (isinf(w)) AS n_inf FROM v GROUP BY label""")
def finite_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.finite_check(table(spark, sf_dir, "embeddings"), "embedding", ["label"])
