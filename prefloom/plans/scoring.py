"""Queries: scores, losses, ranking, comparison, fitted heads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from prefloom.functions.numeric import dot
from prefloom.operators import alignment as A, hinge_fit, losses as L, ranking as R, reward_head as H
from prefloom.plans import inputs as I
from prefloom.plans.registry import registered, rounded, table
from prefloom.plans.text_quality import bleu_sql
from prefloom.sources.scratch import scratch_path, written

MARGIN = 0.5


@registered(f"WITH {I.SCORED_PAIRS_SQL} SELECT pair_id, round(chosen_reward, 6) + 0.0 AS chosen_reward, "
            "round(rejected_reward, 6) + 0.0 AS rejected_reward FROM scored_pairs")
def pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(I.scored_pairs(spark, sf_dir).select("pair_id", "chosen_reward", "rejected_reward"))


@registered(f"WITH {I.MODEL_RESPONSES_SQL} SELECT prompt_id, round(reward, 6) + 0.0 AS reward FROM model_responses WHERE model = 'ppo'")
def scored_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts and responses from two tables, aligned by key and scored."""
    pairs = I.pairs(spark, sf_dir)
    prompts = pairs.select(F.col("pair_id").alias("prompt_id"), "prompt")
    responses = pairs.select(F.col("pair_id").alias("prompt_id"), F.col("chosen").alias("response"))
    both = A.zip_by_key(prompts, responses, "prompt_id")
    scored = H.score_texts(both, I.text_statistics, I.TEXT_WEIGHTS, {"response": "reward"})
    return rounded(scored.select("prompt_id", "reward"))


_ALIGN_SQL = """avg((chosen_reward > rejected_reward)::INT) AS a, avg(chosen_reward - rejected_reward) AS d,
  avg(chosen_reward) AS c, avg(rejected_reward) AS r"""
_ALIGN_OUT = """round(a, 6) + 0.0 AS preference_accuracy, round(d, 6) + 0.0 AS avg_reward_difference,
  round(c, 6) + 0.0 AS chosen_avg_reward, round(r, 6) + 0.0 AS rejected_avg_reward"""


@registered(f"WITH {I.SCORED_PAIRS_SQL}, s AS (SELECT {_ALIGN_SQL} FROM scored_pairs) SELECT {_ALIGN_OUT} FROM s")
def preference_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(A.preference_alignment(I.scored_pairs(spark, sf_dir)))


@registered(f"""WITH {I.SCORED_PAIRS_SQL}, s AS (
  SELECT CASE WHEN length(prompt) > 200 THEN 'long' ELSE 'short' END AS prompt_kind, {_ALIGN_SQL}
  FROM scored_pairs GROUP BY 1) SELECT prompt_kind, {_ALIGN_OUT} FROM s""")
def alignment_by_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment for short and long prompts."""
    kind = F.when(F.length("prompt") > 200, "long").otherwise("short")
    df = I.scored_pairs(spark, sf_dir).withColumn("prompt_kind", kind)
    return rounded(A.preference_alignment(df, by=["prompt_kind"]))


def _loss_sql(loss: str, margin: float) -> str:
    return f"""WITH {I.SCORED_PAIRS_SQL}, d AS (
  SELECT chosen_reward AS c, rejected_reward AS r, chosen_reward - rejected_reward AS d FROM scored_pairs), s AS (
  SELECT avg((c > r)::INT) AS a, avg((d >= {margin})::INT) AS m, avg(c) AS c, avg(r) AS r, avg(d) AS d,
         avg({loss}) AS l, count(*) AS n FROM d)
SELECT round(a, 6) + 0.0 AS preference_accuracy, round(m, 6) + 0.0 AS margin_satisfaction,
  round(c, 6) + 0.0 AS chosen_reward_mean, round(r, 6) + 0.0 AS rejected_reward_mean,
  round(d, 6) + 0.0 AS reward_diff_mean, round(l, 6) + 0.0 AS loss_value, n AS pairs FROM s"""


@registered(_loss_sql("ln(1 + exp(-d))", 0.0))
def loss_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(L.loss_metrics(I.scored_pairs(spark, sf_dir), "bradley_terry"))


@registered(_loss_sql(f"greatest(0, {MARGIN} - d)", MARGIN))
def loss_bradley_terry_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(L.loss_metrics(I.scored_pairs(spark, sf_dir), "bradley_terry", MARGIN))


@registered(_loss_sql(f"greatest(0, {MARGIN} - d)", MARGIN))
def loss_hinge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(L.loss_metrics(I.scored_pairs(spark, sf_dir), "hinge", MARGIN))


@registered(_loss_sql(f"ln(1 + exp(-(d - {MARGIN})))", MARGIN))
def loss_log_sigmoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(L.loss_metrics(I.scored_pairs(spark, sf_dir), "log_sigmoid", MARGIN))


@registered(_loss_sql("(1 - d) * (1 - d)", 1.0))
def loss_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loss added by the user under its own name."""
    L.register_loss("squared", lambda c, r, m: (m - (c - r)) * (m - (c - r)))
    return rounded(L.loss_metrics(I.scored_pairs(spark, sf_dir), "squared", 1.0))


@registered(f"""WITH {I.SCORED_PAIRS_SQL}, b AS (SELECT pair_id, md5(prompt || CASE WHEN chosen_reward > rejected_reward THEN chosen ELSE rejected END) AS text,
  greatest(chosen_reward, rejected_reward) AS score, abs(chosen_reward - rejected_reward) AS diff FROM scored_pairs)
SELECT pair_id, text, round(score, 6) + 0.0 AS score, round(diff, 6) + 0.0 AS score_diff FROM b WHERE diff > 0.1""")
def better_of_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = R.better_of_pair(I.scored_pairs(spark, sf_dir))
    return rounded(df.select("pair_id", F.md5("text").alias("text"), "score", "score_diff"))


@registered(f"""WITH {I.MODEL_RESPONSES_SQL}, k AS (
  SELECT *, row_number() OVER w AS k, lead(reward) OVER w AS runner FROM model_responses
  WINDOW w AS (PARTITION BY prompt_id ORDER BY reward DESC, model))
SELECT prompt_id, model AS candidate_id, round(reward, 6) + 0.0 AS reward, round(reward - runner, 6) + 0.0 AS score_diff
FROM k WHERE k = 1 AND reward - runner > 0.1""")
def best_of_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.model_responses(spark, sf_dir).withColumnRenamed("model", "candidate_id")
    return rounded(R.best_of_candidates(df).select("prompt_id", "candidate_id", "reward", "score_diff"))


MODELS = ("base", "ppo", "supervised")


def _with_references(rows: DataFrame) -> DataFrame:
    """The chosen response of each prompt, without its full stops, beside every response."""
    return rows.withColumn("reference", F.translate("reference", ".", ""))


def _references(rows: DataFrame) -> DataFrame:
    return rows.where("model = 'ppo'").select("prompt_id", F.translate("response", ".", "").alias("reference"))


#: Which of the eight token vectors of an embedding stand for a model's tokens, and which for the reference's.
_VECTOR_PLACES = {"base": (0, 1, 2, 3), "ppo": (4, 5, 6, 7), "supervised": (0, 2, 4, 6)}
_REFERENCE_PLACES = (1, 3, 4, 6)


def _token_vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Token vectors of the three models, and of the references."""
    e = F.col("embedding").cast("array<double>")
    cut = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 5).alias("item_id"), (F.col("vec_id") % 5 * 8).alias("first"), F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice(e, i * 8 + 1, 8))).alias("i", "vec")).withColumn("pos", F.col("first") + F.col("i"))
    owners = F.concat(*[F.when(F.col("i").isin(*places), F.array(F.lit(m))).otherwise(F.array().cast("array<string>")) for m, places in _VECTOR_PLACES.items()])
    return cut.select("item_id", "pos", "vec", F.explode(owners).alias("model")), cut.where(F.col("i").isin(*_REFERENCE_PLACES)).select("item_id", "pos", "vec")


def _match_sql(model: str) -> str:
    at = lambda places: ", ".join(map(str, places))
    return f"""
sims_{model} AS (SELECT p.item_id, p.part * 8 + p.i AS a, r.part * 8 + r.i AS b, list_cosine_similarity(p.vec, r.vec) AS s FROM cut p JOIN cut r USING (item_id)
  WHERE p.i IN ({at(_VECTOR_PLACES[model])}) AND r.i IN ({at(_REFERENCE_PLACES)})),
match_{model} AS (SELECT avg(CASE WHEN p + r <> 0 THEN 2 * p * r / (p + r) ELSE 0 END) AS bertscore FROM
  (SELECT item_id, avg(s) AS p FROM (SELECT item_id, a, max(s) AS s FROM sims_{model} GROUP BY ALL) GROUP BY ALL) JOIN
  (SELECT item_id, avg(s) AS r FROM (SELECT item_id, b, max(s) AS s FROM sims_{model} GROUP BY ALL) GROUP BY ALL) USING (item_id))"""


def _bleu_of_sql(model: str) -> str:
    return f"""
pairs_{model} AS (SELECT m.prompt_id AS item_id, m.response AS prediction, replace(r.response, '.', '') AS reference
  FROM model_responses m JOIN model_responses r ON r.prompt_id = m.prompt_id AND r.model = 'ppo' WHERE m.model = '{model}'),
{bleu_sql(f'pairs_{model}', f'_{model}')},{_match_sql(model)}"""


_MODELS_SQL = f"{I.MODEL_RESPONSES_SQL}, {I.TOKEN_VECTORS_SQL}"


@registered(f"""WITH {_MODELS_SQL}, {', '.join(map(_bleu_of_sql, MODELS))}, s AS (
  SELECT model, avg(len({I.words_sql('response')})) AS w, avg(reward) AS r, stddev_samp(reward) AS d
  FROM model_responses GROUP BY model),
b AS ({' UNION ALL '.join(f"SELECT '{m}' AS model, bleu, bertscore FROM bleu_{m}, match_{m}" for m in MODELS)})
SELECT model, round(bleu, 6) + 0.0 AS bleu, round(bertscore, 6) + 0.0 AS bertscore, round(w, 6) + 0.0 AS avg_response_length, round(r, 6) + 0.0 AS avg_reward_score, round(d, 6) + 0.0 AS reward_std
FROM s JOIN b USING (model)""")
def model_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each model's responses against the references, in one scan; both texts of a prompt come in one row."""
    rows = _with_references(I.model_responses(spark, sf_dir, reference=True))
    return rounded(A.model_quality(rows, metrics=["bleu", "bertscore"], token_vectors=_token_vectors(spark, sf_dir), by=["model"]))


@registered(f"WITH {I.MODEL_RESPONSES_SQL} SELECT round(avg(reward), 6) + 0.0 AS avg_reward FROM model_responses")
def average_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(A.average_reward(I.model_responses(spark, sf_dir)))


_TWO_SQL = f"""WITH {_MODELS_SQL},
p AS (SELECT * FROM model_responses WHERE model = 'ppo'), b AS (SELECT * FROM model_responses WHERE model = 'base')"""


@registered(f"""{_TWO_SQL} SELECT round(avg((p.reward > b.reward)::INT), 6) + 0.0 AS win_rate FROM p JOIN b USING (prompt_id)""")
def win_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = A.side_by_side(I.model_responses(spark, sf_dir, ("base", "ppo")), ["base", "ppo"], values=("reward",))
    return rounded(A.win_rate(df, "ppo_reward", "base_reward"))


def _stats_sql(t: str, model: str) -> str:
    return (f"(SELECT round(bleu, 6) + 0.0 FROM bleu_{model}) AS {t}_bleu, (SELECT round(bertscore, 6) + 0.0 FROM match_{model}) AS {t}_bertscore, (SELECT round(avg(len({I.words_sql('response')})), 6) + 0.0 FROM {t}) AS {t}_length, "
            f"(SELECT round(avg(reward), 6) + 0.0 FROM {t}) AS {t}_reward, "
            f"(SELECT md5(string_agg(response, '|' ORDER BY prompt_id)) FROM (SELECT * FROM {t} ORDER BY prompt_id LIMIT 3)) AS {t}_samples")


@registered(f"""{_TWO_SQL}, {_bleu_of_sql('ppo')}, {_bleu_of_sql('base')}
SELECT round(avg((p.reward > b.reward)::INT), 6) + 0.0 AS win_rate, {_stats_sql('p', 'ppo')}, {_stats_sql('b', 'base')}
FROM p JOIN b USING (prompt_id)""")
def two_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(I.model_responses(spark, sf_dir, ("base", "ppo")), "responses")
    vectors, references = _token_vectors(spark, sf_dir)
    of = lambda m: vectors.where(F.col("model") == m).drop("model")
    report = A.compare_two(rows.where("model = 'ppo'"), rows.where("model = 'base'"), references=_references(rows), metrics=["bleu", "bertscore"],
                           token_vectors=(of("ppo"), of("base"), references))
    return rounded(report.select(
        F.col("win_rate_model_1").alias("win_rate"),
        F.col("model_1_metrics.bleu").alias("p_bleu"), F.col("model_2_metrics.bleu").alias("b_bleu"),
        F.col("model_1_metrics.bertscore").alias("p_bertscore"), F.col("model_2_metrics.bertscore").alias("b_bertscore"),
        F.col("model_1_metrics.avg_response_length").alias("p_length"),
        F.col("model_1_metrics.avg_reward_score").alias("p_reward"),
        F.md5(F.array_join("model_1_samples", "|")).alias("p_samples"),
        F.col("model_2_metrics.avg_response_length").alias("b_length"),
        F.col("model_2_metrics.avg_reward_score").alias("b_reward"),
        F.md5(F.array_join("model_2_samples", "|")).alias("b_samples")))


@registered(f"""WITH {I.MODEL_RESPONSES_SQL}
SELECT prompt_id, {', '.join(f"max(CASE WHEN model = '{m}' THEN response END) AS {m}_response, round(max(CASE WHEN model = '{m}' THEN reward END), 3) + 0.0 AS {m}_reward" for m in ('base', 'ppo', 'supervised'))}
FROM model_responses GROUP BY prompt_id""")
def three_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(A.side_by_side(I.model_responses(spark, sf_dir), ["base", "ppo", "supervised"]), 3)


@registered(f"""WITH {_MODELS_SQL}, p AS (SELECT * FROM model_responses WHERE model = 'base'), {_bleu_of_sql('base')},
f AS (SELECT * FROM p ORDER BY prompt_id LIMIT 5), s AS (SELECT {_ALIGN_SQL} FROM scored_pairs)
SELECT (SELECT round(avg(len({I.words_sql('response')})), 6) + 0.0 FROM p) AS avg_response_length,
  (SELECT round(bleu, 6) + 0.0 FROM bleu_base) AS bleu, (SELECT round(bertscore, 6) + 0.0 FROM match_base) AS bertscore, (SELECT round(stddev_samp(reward), 6) + 0.0 FROM p) AS reward_std, round(a, 6) + 0.0 AS preference_accuracy,
  round(d, 6) + 0.0 AS avg_reward_difference, (SELECT md5(string_agg(prompt, '|' ORDER BY prompt_id)) FROM f) AS prompts,
  (SELECT md5(string_agg(response, '|' ORDER BY prompt_id)) FROM f) AS responses FROM s""")
def evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected responses as a model's; a pair and its reference stand in one row, and pairs are scored and written once."""
    scored = written(I.scored_pairs(spark, sf_dir), "scored")
    rows = scored.select(F.col("pair_id").alias("prompt_id"), "prompt", F.col("rejected").alias("response"), F.col("rejected_reward").alias("reward"),
                         F.translate("chosen", ".", "").alias("reference"))
    vectors, references = _token_vectors(spark, sf_dir)
    doc = A.evaluation_report(rows, scored, metrics=["bleu", "bertscore"], token_vectors=(vectors.where("model = 'base'").drop("model"), references))
    return rounded(doc.select(
        "model_quality.bleu", "model_quality.bertscore", "model_quality.avg_response_length", "model_quality.reward_std",
        "preference_alignment.preference_accuracy", "preference_alignment.avg_reward_difference",
        F.md5(F.array_join("sample_generations.prompts", "|")).alias("prompts"),
        F.md5(F.array_join("sample_generations.responses", "|")).alias("responses")))


# --- fitted heads -------------------------------------------------------------

_QUARTERS = range(4)


def _few_features(pairs: DataFrame) -> DataFrame:
    """Vectors reduced to the sums of their quarters."""
    def sums(c: str):
        return F.array(*[F.aggregate(F.slice(c, q * 16 + 1, 16), F.lit(0.0), lambda a, x: a + x) for q in _QUARTERS])

    return pairs.select(sums("chosen").alias("chosen"), sums("rejected").alias("rejected"))


_FEW_SQL = f"""{I.VECTOR_PAIRS_SQL},
d AS MATERIALIZED (SELECT {', '.join(f"list_sum(chosen[{q * 16 + 1}:{q * 16 + 16}]) - list_sum(rejected[{q * 16 + 1}:{q * 16 + 16}]) AS d{q}, list_sum(chosen[{q * 16 + 1}:{q * 16 + 16}]) AS c{q}" for q in _QUARTERS)} FROM vector_pairs)"""
_SCORE_SQL = " + ".join(f"w{q} * d{q}" for q in _QUARTERS)


def _descent_sql(rows: str, reg: float, margin: float, rate: float, steps: int, loss: str) -> str:
    """Gradient descent on the mean logistic loss of the differences, with the weights and losses it ends at."""
    pull = f"1 / (1 + exp({_SCORE_SQL} - {margin}))"
    step = ", ".join(f"w{q} - {rate} * ({reg} * w{q} - avg(d{q} * {pull}))" for q in _QUARTERS)
    names = ", ".join(f"w{q}" for q in _QUARTERS)
    return f"""WITH RECURSIVE {rows},
walk AS (SELECT 0 AS k, {', '.join(f'0.0::DOUBLE AS w{q}' for q in _QUARTERS)}
  UNION ALL SELECT k + 1, {step} FROM walk, d WHERE k < {steps} GROUP BY k, {names}),
final AS (SELECT * FROM walk WHERE k = {steps}),
s AS (SELECT {names}, {_SCORE_SQL} AS m, {' + '.join(f'w{q} * c{q}' for q in _QUARTERS)} AS c FROM final, d)
SELECT round(avg((m > 0)::INT), 3) + 0.0 AS preference_accuracy, round(avg((m >= {margin})::INT), 3) + 0.0 AS margin_satisfaction,
  round(avg(c), 3) + 0.0 AS chosen_reward_mean, round(avg(c - m), 3) + 0.0 AS rejected_reward_mean, round(avg(m), 3) + 0.0 AS reward_diff_mean,
  round(avg({loss}), 3) + 0.0 AS loss_value, count(*) AS pairs, {', '.join(f'round(any_value(w{q}), 3) + 0.0 AS w{q}' for q in _QUARTERS)} FROM s"""


def _fit_report(df: DataFrame, weights: list[float], loss: str, margin: float, digits: int = 3) -> DataFrame:
    scored = H.score_features(df, weights, {"chosen": "chosen_reward", "rejected": "rejected_reward"})
    return rounded(L.loss_metrics(scored, loss, margin), digits)


def _with_weights(report: DataFrame, weights: list[float]) -> DataFrame:
    return report.withColumns({f"w{q}": F.lit(round(w, 3) + 0.0) for q, w in enumerate(weights)})


@registered(_descent_sql(_FEW_SQL, 0.001, 0.0, 6.0, 400, "ln(1 + exp(-m))"))
def fitted_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = written(_few_features(I.vector_pairs(spark, sf_dir)), "features")
    weights = H.head_weights(H.fit_logistic(pairs, "chosen", "rejected", reg=1e-3))
    return _with_weights(_fit_report(pairs, weights, "bradley_terry", 0.0), weights)


@registered()
def fitted_hinge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole vectors; the optimum is not smooth, so tests compare it with its surroundings."""
    pairs = written(I.vector_pairs(spark, sf_dir), "features")
    model = H.fit_hinge(pairs, "chosen", "rejected", MARGIN, reg=1e-3)
    return _fit_report(pairs, H.head_weights(model, MARGIN), "hinge", MARGIN, 4)


@registered(_descent_sql(_FEW_SQL, 0.0, MARGIN, 6.0, 600, f"ln(1 + exp(-(m - {MARGIN})))"))
def fitted_log_sigmoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = written(_few_features(I.vector_pairs(spark, sf_dir)), "features")
    weights = H.head_weights(H.fit_log_sigmoid(pairs, "chosen", "rejected", MARGIN))
    return _with_weights(_fit_report(pairs, weights, "log_sigmoid", MARGIN), weights)


def _statistics_sql(side: str) -> list[str]:
    return [f"length({side}) / 1000.0::DOUBLE", f"len({I.words_sql(side)}) / 100.0::DOUBLE",
            f"{I.count_sql(side, ',')} / 10.0::DOUBLE", f"{I.count_sql(side, '.')} / 10.0::DOUBLE"]


_TEXT_ROWS_SQL = f"""{I.PAIRS_SQL},
d AS MATERIALIZED (SELECT {', '.join(f"{c} - {r} AS d{q}, {c} AS c{q}" for q, (c, r) in enumerate(zip(_statistics_sql('chosen'), _statistics_sql('rejected'))))} FROM clean_pairs)"""


@registered(_descent_sql(_TEXT_ROWS_SQL, 0.1, 0.0, 1.0, 1500, "ln(1 + exp(-m))"))
def fitted_on_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A head on text statistics, stored, loaded and applied."""
    texts = I.pairs(spark, sf_dir)
    pairs = written(texts.select(I.text_statistics(F.col("chosen")).alias("chosen"), I.text_statistics(F.col("rejected")).alias("rejected")), "features")
    path = scratch_path(spark, "head")
    H.save_head(H.fit_logistic(pairs, "chosen", "rejected", reg=0.1), path, {"features": 4}, {"name": "statistics"}, spark)
    model, _, _ = H.load_head(path, spark)
    weights = H.head_weights(model)
    return _with_weights(_fit_report(pairs, weights, "bradley_terry", 0.0), weights)


# --- whole vectors -------------------------------------------------------------

WORD_BUCKETS = 256


def _accelerated_sql(rows: str, size: int, reg: float, margin: float, rate: float, steps: int) -> str:
    """Accelerated gradient descent on the mean logistic loss of the differences ``d (v)``; ends with ``final (w)``, a list of weights."""
    pace = (reg * rate) ** 0.5
    momentum = (1 - pace) / (1 + pace)
    return f"""WITH RECURSIVE {rows},
walk AS (SELECT 0 AS k, list_transform(range({size}), lambda i: 0.0::DOUBLE) AS w, list_transform(range({size}), lambda i: 0.0::DOUBLE) AS y
  UNION ALL
  SELECT k + 1, n, list_transform(range(1, {size + 1}), lambda i: n[i] + {momentum} * (n[i] - w[i])) FROM (
    SELECT k, any_value(w) AS w, list(y_i - {rate} * ({reg} * y_i - pulled) ORDER BY i) AS n FROM (
      SELECT k, i, any_value(w) AS w, any_value(y[i]) AS y_i, avg(pull * v[i]) AS pulled FROM (
        SELECT k, w, y, v, 1 / (1 + exp(list_dot_product(v, y) - {margin})) AS pull FROM walk, d WHERE k < {steps}), range(1, {size + 1}) t(i)
      GROUP BY k, i) GROUP BY k)),
final AS (SELECT w FROM walk WHERE k = {steps})"""


def _weights_sql(rows: str, size: int, reg: float, margin: float, rate: float, steps: int) -> str:
    return f"""{_accelerated_sql(rows, size, reg, margin, rate, steps)},
o AS (SELECT avg(ln(1 + exp({margin} - list_dot_product(v, w)))) + {reg / 2} * list_dot_product(any_value(w), any_value(w)) AS objective, count(*) AS pairs FROM d, final)
SELECT (unnest(range({size})))::INTEGER AS component, round(unnest(w), 3) + 0.0 AS weight, round(objective, 6) + 0.0 AS objective, pairs FROM final, o"""


def _weight_rows(spark: SparkSession, weights: list[float], objective: float, rows: int) -> DataFrame:
    """A row for each feature."""
    out = spark.createDataFrame(list(enumerate(weights)), "component int, weight double")
    return out.select("component", (F.round("weight", 3) + F.lit(0.0)).alias("weight"), F.lit(round(objective, 6)).alias("objective"), F.lit(rows).cast("long").alias("pairs"))


_WHOLE_SQL = f"{I.VECTOR_PAIRS_SQL}, d AS MATERIALIZED (SELECT list_transform(range(1, 65), lambda i: chosen[i] - rejected[i]) AS v FROM vector_pairs)"


@registered(_weights_sql(_WHOLE_SQL, 64, 1e-3, 0.0, 4.0, 400))
def fitted_logistic_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 64 components, by Newton steps."""
    fit = H.fit_differences(I.vector_pairs(spark, sf_dir), "chosen", "rejected", reg=1e-3)
    return _weight_rows(spark, fit.weights, fit.objective, fit.rows)


@registered(_weights_sql(_WHOLE_SQL, 64, 1e-3, MARGIN, 4.0, 400))
def fitted_log_sigmoid_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 64 components, with a margin."""
    fit = H.fit_differences(I.vector_pairs(spark, sf_dir), "chosen", "rejected", margin=MARGIN, reg=1e-3)
    return _weight_rows(spark, fit.weights, fit.objective, fit.rows)


def _word_counts_sql(side: str) -> str:
    return f"""SELECT pair_id, ('0x' || substr(md5(w), 1, 8))::BIGINT % {WORD_BUCKETS} AS b, count(*) AS n
  FROM (SELECT pair_id, unnest({I.words_sql(side)}) AS w FROM clean_pairs) GROUP BY ALL"""


_WORD_ROWS_SQL = f"""{I.PAIRS_SQL},
hashed AS (SELECT pair_id, b, sum(n)::DOUBLE AS n FROM ({_word_counts_sql('chosen')} UNION ALL SELECT pair_id, b, -n FROM ({_word_counts_sql('rejected')})) GROUP BY ALL),
d AS MATERIALIZED (SELECT list(coalesce(n, 0.0) * 0.1 ORDER BY b) AS v
  FROM (SELECT pair_id, b FROM clean_pairs, range({WORD_BUCKETS}) t(b)) LEFT JOIN hashed USING (pair_id, b) GROUP BY pair_id)"""


@registered(_weights_sql(_WORD_ROWS_SQL, WORD_BUCKETS, 0.05, 0.0, 1.0, 150))
def fitted_on_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A head on 256 buckets of words, stored, loaded and applied."""
    texts = I.pairs(spark, sf_dir).select("chosen", "rejected")
    fit = H.fit_differences(H.hash_words(texts, {"chosen": "c", "rejected": "r"}, WORD_BUCKETS), "c", "r", reg=0.05, scale=0.1)
    path = scratch_path(spark, "head")
    H.save_weights(fit.weights, path, {"buckets": WORD_BUCKETS, "scale": 0.1}, {"objective": fit.objective, "pairs": fit.rows}, spark)
    weights, _, metadata = H.load_weights(path, spark)
    return _weight_rows(spark, weights, metadata["objective"], metadata["pairs"])


HINGE_REG = 0.01


def _dual_sql(rows: str, size: int, reg: float, margin: float, rate: float, steps: int) -> str:
    """Accelerated ascent of the hinge dual in the box; primal and dual value of the weights that it ends at."""
    return f"""WITH RECURSIVE {rows},
m AS MATERIALIZED (SELECT row_number() OVER () AS p, v FROM d), n AS MATERIALIZED (SELECT count(*) AS n FROM m),
cells AS MATERIALIZED (SELECT p, i, v[i] AS x FROM m, range(1, {size + 1}) c(i)),
walk AS (SELECT 0 AS k, p, 0.0::DOUBLE AS a, 0.0::DOUBLE AS y, 1.0::DOUBLE AS t FROM m
  UNION ALL
  SELECT k + 1, p, b, b + (t - 1) / ((1 + sqrt(1 + 4 * t * t)) / 2) * (b - a), (1 + sqrt(1 + 4 * t * t)) / 2 FROM (
    SELECT k, p, a, t, greatest(0.0, least(1.0, y + {rate} * ({margin} - list_dot_product(v, w)))) AS b
    FROM walk JOIN m USING (p), (SELECT list(s ORDER BY i) AS w FROM (SELECT i, sum(y * x) / ({reg} * any_value(n)) AS s FROM walk JOIN cells USING (p), n GROUP BY i))
    WHERE k < {steps})),
ends AS (SELECT p, a FROM walk WHERE k = {steps}),
final AS (SELECT list(s ORDER BY i) AS w, (SELECT sum(a) FROM ends) AS held, any_value(n) AS n FROM
  (SELECT i, sum(a * x) / ({reg} * any_value(n)) AS s, any_value(n) AS n FROM ends JOIN cells USING (p), n GROUP BY i)),
o AS (SELECT {reg / 2} * list_dot_product(any_value(w), any_value(w)) AS penalty, avg(greatest(0.0, {margin} - list_dot_product(v, w))) AS loss, {margin} * any_value(held) / any_value(n) AS gain,
  avg((list_dot_product(v, w) > 0)::INT) AS accuracy, count(*) AS pairs FROM final, m)
SELECT round(penalty + loss, 4) + 0.0 AS primal, round(gain - penalty, 4) + 0.0 AS dual, penalty + loss - (gain - penalty) < 1e-5 AS certified,
  round(accuracy, 3) + 0.0 AS preference_accuracy, pairs FROM o"""


@registered(_dual_sql(_WHOLE_SQL, 64, HINGE_REG, MARGIN, 0.1, 1500))
def fitted_hinge_dual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 64 components; primal and dual value, worked out again from the returned weights, certify the fit."""
    pairs = I.vector_pairs(spark, sf_dir).select(F.zip_with("chosen", "rejected", lambda a, b: a - b).alias("d"))
    rows = written(pairs, "differences")
    fit = hinge_fit.fit_hinge_dual(rows, "d", MARGIN, HINGE_REG, tol=1e-8)
    scored = rows.select(dot(F.col("d"), F.array(*map(F.lit, fit.weights))).alias("m"))
    penalty = HINGE_REG / 2 * sum(w * w for w in fit.weights)
    primal = F.avg(F.greatest(F.lit(0.0), MARGIN - F.col("m"))) + penalty
    return rounded(scored.agg(primal.alias("primal"), F.lit(fit.dual).alias("dual"), F.avg((F.col("m") > 0).cast("double")).alias("accuracy"), F.count("*").alias("pairs")).select(
        "primal", "dual", (F.col("primal") - F.col("dual") < 1e-5).alias("certified"), F.round("accuracy", 3).alias("preference_accuracy"), "pairs"), 4)
