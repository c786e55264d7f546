"""The engine's input tables, derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from prefloom.functions.text import count_of, n_words
from prefloom.operators.pairs import prepare_pairs
from prefloom.operators.reward_head import score_texts
from prefloom.plans.registry import table

# Weights of the fixed linear reward over text statistics and over embeddings.
TEXT_WEIGHTS = [0.8, -1.3, 0.5, -0.4]
VECTOR_WEIGHTS = [round(((i * 7) % 11 - 5) / 5.0, 1) for i in range(64)]

WS_SQL = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


# --- pieces of SQL ----------------------------------------------------------

def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_SQL}+|{WS_SQL}+$', '', 'g')"


def clean_sql(x: str) -> str:
    straight = f"translate({strip_sql(x)}, '“”‘’', '\"\"''''')"
    return f"regexp_replace({straight}, '{WS_SQL}+', ' ', 'g')"


def words_sql(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WS_SQL}+'), lambda w: w <> '')"


def count_sql(x: str, needle: str) -> str:
    return f"((length({x}) - length(replace({x}, '{needle}', ''))) // {len(needle)})"


def reward_sql(x: str) -> str:
    """Reward of a text under the fixed head."""
    a, b, c, d = TEXT_WEIGHTS
    return (
        f"({a} * (length({x}) / 1000.0::DOUBLE) + ({b}) * (len({words_sql(x)}) / 100.0::DOUBLE)"
        f" + {c} * ({count_sql(x, ',')} / 10.0::DOUBLE) + ({d}) * ({count_sql(x, '.')} / 10.0::DOUBLE))"
    )


def dot_sql(x: str, weights: list[float] | None = None) -> str:
    """Vector times fixed weights, added up from the left."""
    terms = [f"{x}[{i + 1}]::DOUBLE * ({w})" for i, w in enumerate(weights or VECTOR_WEIGHTS)]
    return "(" + " + ".join(["0.0::DOUBLE", *terms]) + ")"


# --- transcripts and pairs --------------------------------------------------

def raw_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two transcripts of each conversation, all its turns in order.

    The rejected one repeats the first assistant reply in place of the last.
    A conversation is one value to its reader, so one list per conversation has its natural size.
    """
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    replies = F.filter("turns", lambda t: t["role"] == "assistant")
    spans = turns.withColumns({
        "first_reply": F.try_element_at(replies, F.lit(1))["text"],
        "last_reply": F.try_element_at(replies, F.lit(-1))["turn"],
    })

    def transcript(text_of) -> Column:
        return F.array_join(F.transform("turns", lambda t: F.concat(_speaker(t["role"]), text_of(t))), "\n\n")

    swapped = transcript(lambda t: F.when(t["turn"] == F.col("last_reply"), F.col("first_reply")).otherwise(t["text"]))
    return spans.select(
        F.col("conv_id").alias("pair_id"),
        F.when(F.pmod("conv_id", F.lit(4)) == 0, "train").otherwise("test").alias("split"),
        transcript(lambda t: t["text"]).alias("chosen"),
        swapped.alias("rejected"),
    )


def _speaker(role: Column) -> Column:
    return F.when(role == "user", "H: ").when(role == "assistant", "A: ").otherwise("S: ")


_SPEAKER_SQL = "(CASE role WHEN 'user' THEN 'H: ' WHEN 'assistant' THEN 'A: ' ELSE 'S: ' END)"

RAW_PAIRS_SQL = f"""
marks AS (
  SELECT conv_id, max(turn) FILTER (role = 'assistant') AS last_reply,
         arg_min(text, turn) FILTER (role = 'assistant') AS first_reply
  FROM conversations GROUP BY ALL),
raw_pairs AS (
  SELECT conv_id AS pair_id, CASE WHEN conv_id % 4 = 0 THEN 'train' ELSE 'test' END AS split,
         string_agg({_SPEAKER_SQL} || text, chr(10) || chr(10) ORDER BY turn) AS chosen,
         string_agg({_SPEAKER_SQL} || CASE WHEN turn = last_reply THEN first_reply ELSE text END,
                    chr(10) || chr(10) ORDER BY turn) AS rejected
  FROM conversations JOIN marks USING (conv_id) GROUP BY conv_id)"""


def _turn_sql(t: str) -> str:
    return f"""
         instr({t}, 'H:') AS h_{t},
         CASE WHEN instr(substr({t}, instr({t}, 'H:')), chr(10)) > 0
              THEN instr({t}, 'H:') + instr(substr({t}, instr({t}, 'H:')), chr(10)) - 1
              ELSE length({t}) + 1 END AS e_{t}"""


PARSED_PAIRS_SQL = f"""
edged AS (
  SELECT pair_id, {strip_sql('chosen')} AS chosen, {strip_sql('rejected')} AS rejected
  FROM raw_pairs WHERE chosen IS NOT NULL AND rejected IS NOT NULL),
bounds AS (SELECT *, {_turn_sql('chosen')}, {_turn_sql('rejected')} FROM edged),
parsed_pairs AS (
  SELECT pair_id,
    CASE WHEN h_chosen > 0 THEN {strip_sql('substr(chosen, h_chosen + 2, e_chosen - h_chosen - 2)')}
         ELSE 'Continue the conversation:' END AS prompt,
    CASE WHEN h_chosen > 0 THEN {strip_sql('substr(chosen, e_chosen)')} ELSE chosen END AS chosen,
    CASE WHEN h_rejected > 0 THEN {strip_sql('substr(rejected, e_rejected)')} ELSE rejected END AS rejected
  FROM bounds),
valid_pairs AS (
  SELECT * FROM parsed_pairs WHERE chosen <> rejected AND chosen <> '' AND rejected <> ''),
clean_pairs AS (
  SELECT pair_id, {clean_sql('prompt')} AS prompt, {clean_sql('chosen')} AS chosen, {clean_sql('rejected')} AS rejected
  FROM valid_pairs)"""

PAIRS_SQL = f"{RAW_PAIRS_SQL},{PARSED_PAIRS_SQL}"


def pairs(spark: SparkSession, sf_dir: str, clean: bool = True) -> DataFrame:
    return prepare_pairs(raw_pairs(spark, sf_dir).drop("split"), limit=None, clean=clean)


def text_statistics(text: Column) -> Column:
    """Feature vector of a text for the fixed head."""
    return F.array(
        F.length(text) / 1000.0, n_words(text) / 100.0, count_of(text, ",") / 10.0, count_of(text, ".") / 10.0)


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned pairs with the reward of prompt + response on both sides."""
    sides = {"chosen": "chosen_reward", "rejected": "rejected_reward"}
    return score_texts(pairs(spark, sf_dir), text_statistics, TEXT_WEIGHTS, sides)


SCORED_PAIRS_SQL = f"""{PAIRS_SQL},
scored_pairs AS (
  SELECT *, {reward_sql("(prompt || ' ' || chosen)")} AS chosen_reward,
            {reward_sql("(prompt || ' ' || rejected)")} AS rejected_reward
  FROM clean_pairs)"""


def model_responses(spark: SparkSession, sf_dir: str, models: tuple[str, ...] = ("base", "ppo", "supervised"), reference: bool = False) -> DataFrame:
    """Responses per prompt, one row for each of ``models``: (prompt_id, model, prompt, response, reward); with ``reference`` also the chosen one."""
    scored = pairs(spark, sf_dir)
    plain = F.translate("chosen", ",", "")
    every = scored.select(
        F.col("pair_id").alias("prompt_id"), "prompt", *([F.col("chosen").alias("reference")] if reference else []),
        F.inline(F.array(
            F.struct(F.lit("base").alias("model"), F.col("rejected").alias("response")),
            F.struct(F.lit("ppo").alias("model"), F.col("chosen").alias("response")),
            F.struct(F.lit("supervised").alias("model"), plain.alias("response")))))
    rows = every.where(F.col("model").isin(*models))
    return score_texts(rows, text_statistics, TEXT_WEIGHTS, {"response": "reward"})


MODEL_RESPONSES_SQL = f"""{SCORED_PAIRS_SQL},
unscored AS (
  SELECT pair_id AS prompt_id, prompt, 'base' AS model, rejected AS response FROM scored_pairs
  UNION ALL SELECT pair_id, prompt, 'ppo', chosen FROM scored_pairs
  UNION ALL SELECT pair_id, prompt, 'supervised', replace(chosen, ',', '') FROM scored_pairs),
model_responses AS (
  SELECT *, {reward_sql("(prompt || ' ' || response)")} AS reward FROM unscored)"""


# --- step logs ---------------------------------------------------------------

def step_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a training log: run = user, epoch = day, step = event, loss and accuracy from its numbers."""
    k = F.get_json_object("props", "$.k").cast("int")
    origin = F.lit("2024-01-01").cast("date")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(origin.cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.datediff(F.to_date("ts"), origin).alias("epoch"),
        F.col("event_id").alias("step"),
        (micros / 1e6).alias("ts_seconds"),
        F.col("event_type").alias("name"),
        F.col("value").alias("num_value"),
        (F.col("value") / 10).alias("loss"),
        (k / 100).alias("accuracy"),
        k.cast("long").alias("correct"),
        F.lit(100).cast("long").alias("total"),
    )


STEP_LOG_SQL = """
step_log AS (
  SELECT user_id AS run_id, date_diff('day', DATE '2024-01-01', ts::DATE)::INT AS epoch, event_id AS step,
         (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6::DOUBLE AS ts_seconds, event_type AS name,
         value AS num_value, value / 10 AS loss, json_extract(props, '$.k')::INT / 100.0::DOUBLE AS accuracy,
         json_extract(props, '$.k')::BIGINT AS correct, 100::BIGINT AS total
  FROM events)"""


def rollout_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as a history of rollout losses."""
    v, a = F.col("num_value"), F.col("accuracy")
    return step_log(spark, sf_dir).select(
        "run_id", "step", (v / 100).alias("policy_loss"), (v / 50).alias("value_loss"),
        (v / 100 + v / 100 - a / 100).alias("total_loss"), (v / 1000).alias("kl_divergence"),
        a.alias("entropy"), (v * a).alias("grad_norm"))


HISTORY_SQL = STEP_LOG_SQL + """,
rollout_history AS (
  SELECT run_id, step, num_value / 100 AS policy_loss, num_value / 50 AS value_loss,
         num_value / 100 + num_value / 100 - accuracy / 100 AS total_loss, num_value / 1000 AS kl_divergence,
         accuracy AS entropy, num_value * accuracy AS grad_norm
  FROM step_log)"""


# --- rollouts ----------------------------------------------------------------

VOCABULARY = 8
#: Logits of a position: all components of the embedding, turned by the position.
LOGITS = 64
END_TOKEN = 0
ROLLOUT_BATCH = 8


def rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as recorded rollouts, a token for each component."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    ids = F.transform("e", lambda x: (F.floor(F.abs(x) * 1000).cast("int") % VOCABULARY))
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", e.alias("e")).select(
        F.col("vec_id").alias("rollout_id"),
        F.floor(F.col("vec_id") / ROLLOUT_BATCH).alias("batch_id"),
        ids.alias("full_ids"),
        (F.col("label") % VOCABULARY).alias("prompt_len"),
        F.col("e")[9].alias("old_logprob"), F.col("e")[10].alias("new_logprob"),
        F.abs(F.col("e")[11]).alias("kl"), F.col("e")[12].alias("value"),
        F.col("e")[13].alias("value_new"), (F.col("e")[14] * 10).alias("reward"),
        F.abs(F.col("e")[15]).alias("entropy"), "e",
    )


ROLLOUTS_SQL = f"""
vectors AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
rollouts AS (
  SELECT vec_id AS rollout_id, vec_id // {ROLLOUT_BATCH} AS batch_id,
         list_transform(e, lambda x: floor(abs(x) * 1000)::INT % {VOCABULARY}) AS full_ids,
         label % {VOCABULARY} AS prompt_len, e[10] AS old_logprob, e[11] AS new_logprob, abs(e[12]) AS kl,
         e[13] AS value, e[14] AS value_new, e[15] * 10 AS reward, abs(e[16]) AS entropy, e
  FROM vectors)"""


def distribution(e: Column, pos: Column, shift: int) -> Column:
    turn = ((pos * VOCABULARY + shift) % LOGITS).cast("int")
    return F.transform(F.concat(F.slice(e, turn + 1, LOGITS), F.slice(e, F.lit(1), turn)), lambda x: x * 10)


def token_logits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Policy and reference logits per response position (rollout_id, pos, token_id, logits)."""
    from prefloom.operators.rollouts import response_tokens

    base = rollouts(spark, sf_dir)
    tokens = response_tokens(base, END_TOKEN, carried=["e"])
    policy = tokens.withColumn("logits", distribution(F.col("e"), F.col("pos"), 0)).drop("e")
    reference = tokens.withColumn("logits", distribution(F.col("e"), F.col("pos"), 3)).drop("e")
    return policy, reference


def rollout_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollouts with the ids of their response and the policy's and the reference's logits for each, as arrays in one row."""
    from prefloom.functions.tokens import response_ids

    base = rollouts(spark, sf_dir).withColumn("ids", response_ids(F.col("full_ids"), F.col("prompt_len"), END_TOKEN))
    lists = lambda shift: F.transform("ids", lambda _, pos: distribution(F.col("e"), pos, shift))
    return base.select("rollout_id", "ids", lists(0).alias("logits_p"), lists(3).alias("logits_q"))


RESPONSE_TOKENS_SQL = f"""{ROLLOUTS_SQL},
tails AS (SELECT rollout_id, e, full_ids[prompt_len + 1:] AS tail FROM rollouts),
responses AS (
  SELECT rollout_id, e, CASE WHEN list_position(tail, {END_TOKEN}) > 0
         THEN tail[1:list_position(tail, {END_TOKEN}) - 1] ELSE tail END AS ids FROM tails),
response_tokens AS (
  SELECT rollout_id, e, unnest(range(len(ids))) AS pos, unnest(ids) AS token_id FROM responses)"""


def distribution_sql(pos: str, shift: int) -> str:
    return f"list_transform(range({LOGITS}), lambda i: e[(i + {pos} * {VOCABULARY} + {shift}) % {LOGITS} + 1] * 10)"


TOKEN_LOGITS_SQL = f"""{RESPONSE_TOKENS_SQL},
token_logits AS (
  SELECT rollout_id, pos, token_id, {distribution_sql('pos', 0)} AS lp, {distribution_sql('pos', 3)} AS lq FROM response_tokens),
normalizers AS (
  SELECT *, ln(list_sum(list_transform(lp, lambda x: exp(x)))) AS zp,
            ln(list_sum(list_transform(lq, lambda x: exp(x)))) AS zq FROM token_logits),
token_stats AS (
  SELECT rollout_id, pos, lp[token_id + 1] - zp AS logprob,
         list_sum(list_transform(range(1, {LOGITS + 1}), lambda i: exp(lp[i] - zp) * ((lp[i] - zp) - (lq[i] - zq)))) AS kl,
         -list_sum(list_transform(range(1, {LOGITS + 1}), lambda i: exp(lp[i] - zp) * (lp[i] - zp))) AS entropy
  FROM normalizers),
rollout_stats AS (
  SELECT rollout_id, coalesce(avg(s.logprob), 0.0) AS logprob, coalesce(avg(s.kl), 0.0) AS kl,
         coalesce(avg(s.entropy), 0.0) AS entropy
  FROM rollouts r LEFT JOIN token_stats s USING (rollout_id) GROUP BY rollout_id)"""


# --- vectors -----------------------------------------------------------------

def vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring embeddings as pairs: the one with the higher fixed score plus label counts as chosen."""
    base = table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / 2).alias("pair_id"), "vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    # Two rows per pair at most.
    ends = base.groupBy("pair_id").agg(
        F.max(F.struct("label", "vec_id", "v")).alias("c"), F.min(F.struct("label", "vec_id", "v")).alias("r"))
    return ends.where(F.col("c.vec_id") != F.col("r.vec_id")).select(
        "pair_id", F.col("c.v").alias("chosen"), F.col("r.v").alias("rejected"))


VECTOR_PAIRS_SQL = """
ranked AS (
  SELECT vec_id // 2 AS pair_id, embedding::DOUBLE[] AS v,
         row_number() OVER (PARTITION BY vec_id // 2 ORDER BY label DESC, vec_id DESC) AS k FROM embeddings),
vector_pairs AS (
  SELECT pair_id, c.v AS chosen, r.v AS rejected
  FROM ranked c JOIN ranked r USING (pair_id) WHERE c.k = 1 AND r.k = 2)"""


# --- predictions and references ----------------------------------------------

def documents_and_references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as predictions, each document's successor as its reference."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (
        docs.select(F.col("doc_id").alias("item_id"), "text"),
        docs.select((F.col("doc_id") - 1).alias("item_id"), "text"),
    )


DOCUMENT_PAIRS_SQL = """
text_pairs AS (
  SELECT p.doc_id AS item_id, p.text AS prediction, r.text AS reference
  FROM documents p JOIN documents r ON r.doc_id - 1 = p.doc_id)"""


def token_vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Token vectors of two sides: each embedding gives eight vectors of eight numbers to both sides of its item."""
    base = table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / 5).alias("item_id"), (F.col("vec_id") % 5).alias("part"),
        F.col("embedding").cast("array<double>").alias("e"))
    tokens = base.select("item_id", "part", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("e", i * 8 + 1, 8))).alias("i", "vec"))
    pos = F.col("part") * 4 + F.col("i") % 4
    return (
        tokens.where(F.col("i") < 4).select("item_id", pos.alias("pos"), "vec"),
        tokens.where(F.col("i") >= 4).select("item_id", pos.alias("pos"), "vec"),
    )


TOKEN_VECTORS_SQL = """
cut AS (
  SELECT vec_id // 5 AS item_id, vec_id % 5 AS part, i, (embedding::DOUBLE[])[i * 8 + 1:i * 8 + 8] AS vec
  FROM embeddings, range(8) t(i)),
vectors_p AS (SELECT item_id, part * 4 + i % 4 AS pos, vec FROM cut WHERE i < 4),
vectors_r AS (SELECT item_id, part * 4 + i % 4 AS pos, vec FROM cut WHERE i >= 4)"""
