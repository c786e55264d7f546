"""Queries: order, batches and token arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from prefloom.functions import tokens as K
from prefloom.operators import ordering as O, pairs as P, tokens as T, validation
from prefloom.plans import inputs as I
from prefloom.plans.registry import listed, registered, rounded, table

BATCH = 16
VOCABULARY = 500
LENGTH = 32
# Longest training example; longer ones are cut, as a trainer does.
EXAMPLE_LENGTH = 512

_INDEXED_SQL = "indexed AS (SELECT *, row_number() OVER (ORDER BY lang, doc_id) - 1 AS idx FROM documents)"


@registered(f"WITH {_INDEXED_SQL} SELECT doc_id, idx, idx // {BATCH} AS batch_id FROM indexed")
def document_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "doc_id")
    return O.assign_batches(docs, ["lang", "doc_id"], BATCH).select("doc_id", "idx", "batch_id")


@registered("""WITH n AS (SELECT floor(0.8 * count(*))::BIGINT AS size FROM documents),
r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS k FROM documents)
SELECT doc_id, CASE WHEN k <= size THEN 'train' ELSE 'eval' END AS part FROM r, n""")
def document_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.ordered_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@registered("SELECT doc_id, n_chars, row_number() OVER (ORDER BY md5('42:1:' || doc_id), doc_id) - 1 AS position FROM documents")
def epoch_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each row in an epoch's order."""
    return O.epoch_shuffle(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", seed=42, epoch=1)


@registered("SELECT event_id, value FROM events WHERE (event_id + 1) % 10 = 0")
def logged_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth step, counted from one."""
    return O.every_kth_step(table(spark, sf_dir, "events").select("event_id", "value"), 10, F.col("event_id") + 1)


@registered(f"""WITH {I.ROLLOUTS_SQL},
room AS (SELECT * FROM rollouts WHERE len(full_ids) - (prompt_len + 1) > 0),
b AS (SELECT batch_id, count(*) AS n FROM room GROUP BY batch_id),
c AS (SELECT batch_id, coalesce(sum(n) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b)
SELECT rollout_id, batch_id FROM room JOIN c USING (batch_id) WHERE before < 100""")
def capped_rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prefloom.operators.rollouts import with_room_for_response

    room = with_room_for_response(I.rollouts(spark, sf_dir))
    return O.cap_rollouts(room, 100).select("rollout_id", "batch_id")


@registered("""(SELECT 'first' AS side, doc_id, lang FROM documents ORDER BY doc_id LIMIT 5) UNION ALL
(SELECT 'last', doc_id, lang FROM documents ORDER BY doc_id DESC LIMIT 3)""")
def first_and_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    first = O.first_rows(docs, "doc_id", 5).select(F.lit("first").alias("side"), "doc_id", "lang")
    return first.unionByName(O.last_rows(docs, "doc_id", 3).select(F.lit("last").alias("side"), "doc_id", "lang"))


# --- tokens -----------------------------------------------------------------

def _vocabulary_sql(source: str) -> str:
    return f"""
tokens AS (SELECT unnest({I.words_sql('text')}) AS token FROM {source}),
counts AS (SELECT token, count(*) AS n FROM tokens GROUP BY token),
vocabulary AS (SELECT token, n, (row_number() OVER (ORDER BY n DESC, token) + 1)::INT AS token_id FROM counts
  ORDER BY n DESC, token LIMIT {VOCABULARY})"""


def _encoded_sql(source: str, key: str, text: str, suffix: str = "") -> str:
    return f"""
places{suffix} AS (SELECT {key}, unnest({I.words_sql(text)}) AS token, generate_subscripts({I.words_sql(text)}, 1) AS pos FROM {source}),
ids{suffix} AS (SELECT {key}, list(coalesce(token_id, 1) ORDER BY pos) AS ids
  FROM places{suffix} LEFT JOIN vocabulary USING (token) GROUP BY {key}),
encoded{suffix} AS (SELECT s.{key}, coalesce(ids, []::INT[]) AS ids FROM {source} s LEFT JOIN ids{suffix} USING ({key}))"""


@registered(f"WITH {_vocabulary_sql('documents')} SELECT token, n, token_id FROM vocabulary")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.build_vocabulary(table(spark, sf_dir, "documents"), "text", VOCABULARY)


def _documents_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return T.encode(docs, {"text": "input_ids"}, T.build_vocabulary(docs, "text", VOCABULARY), "doc_id")


_ENCODED = f"{_vocabulary_sql('documents')}, {_encoded_sql('documents', 'doc_id', 'text')}"


@registered(f"WITH {_ENCODED} SELECT doc_id, len(ids)::BIGINT AS n_tokens, md5(array_to_string(ids, ',')) AS ids FROM encoded")
def encoded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _documents_encoded(spark, sf_dir)
    return df.select("doc_id", F.size("input_ids").cast("long").alias("n_tokens"), F.md5(listed("input_ids")).alias("ids"))


@registered(f"WITH {_ENCODED} SELECT doc_id, len(ids)::BIGINT AS n_tokens, md5(array_to_string(ids, ',')) AS ids FROM encoded")
def encoded_documents_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route for vocabularies that are not to be sent to the tasks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = T.build_vocabulary(docs, "text", VOCABULARY)
    df = T.encode(docs, {"text": "input_ids"}, words, "doc_id", route="join")
    return df.select("doc_id", F.size("input_ids").cast("long").alias("n_tokens"), F.md5(listed("input_ids")).alias("ids"))


_PADDED_SQL = f"""{_ENCODED},
padded AS (
  SELECT doc_id, list_concat(ids[1:{LENGTH}], list_transform(range({LENGTH} - least(len(ids), {LENGTH})), lambda x: 0)) AS ids,
         list_concat(list_transform(range(least(len(ids), {LENGTH})), lambda x: 1),
                     list_transform(range({LENGTH} - least(len(ids), {LENGTH})), lambda x: 0)) AS mask
  FROM encoded)"""


def _padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.pad_fixed(_documents_encoded(spark, sf_dir), "input_ids", "attention_mask", LENGTH)


@registered(f"WITH {_PADDED_SQL} SELECT doc_id, array_to_string(ids, ',') AS ids, array_to_string(mask, ',') AS mask FROM padded")
def fixed_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _padded(spark, sf_dir)
    return df.select("doc_id", listed("input_ids").alias("ids"), listed("attention_mask").alias("mask"))


def _padded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, padded to the longest of their batch of neighbouring keys."""
    df = _documents_encoded(spark, sf_dir).withColumn("batch_id", F.floor(F.col("doc_id") / BATCH))
    return T.pad_to_longest(df, {"input_ids": "attention_mask"})


@registered(f"""WITH {_ENCODED}, widths AS (SELECT *, max(len(ids)) OVER (PARTITION BY doc_id // {BATCH}) AS width FROM encoded)
SELECT doc_id, len(ids)::BIGINT AS by_mask, len(list_filter(ids, lambda x: x <> 0))::BIGINT AS by_pad, width::BIGINT AS width FROM widths""")
def prompt_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _padded_batches(spark, sf_dir)
    by_pad = K.masked_length(K.mask_from_pad(F.col("input_ids"), 0))
    return df.select("doc_id", K.masked_length(F.col("attention_mask")).cast("long").alias("by_mask"),
                     by_pad.cast("long").alias("by_pad"), F.size("input_ids").cast("long").alias("width"))


@registered(f"""WITH {_ENCODED}, l AS (SELECT doc_id, unnest(ids) AS label FROM encoded)
SELECT doc_id, count(*) AS positions, sum(label)::BIGINT AS label_sum FROM l GROUP BY doc_id""")
def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels copied from the ids; padded positions are marked to be skipped."""
    df = T.causal_labels(_padded_batches(spark, sf_dir))
    marked = df.withColumn("labels", F.zip_with(
        "labels", "attention_mask", lambda x, m: F.when(m == 1, x).otherwise(F.lit(K.IGNORED_LABEL))))
    return T.scored_positions(marked, "doc_id").groupBy("doc_id").agg(
        F.count("*").alias("positions"), F.sum("label").alias("label_sum"))


_PAIR_TOKENS_SQL = f"""{I.PAIRS_SQL},
texts AS (SELECT prompt || ' ' || chosen || ' ' || rejected AS text FROM clean_pairs),
{_vocabulary_sql('texts')},
{_encoded_sql('clean_pairs', 'pair_id', 'chosen', '_c')},
{_encoded_sql('clean_pairs', 'pair_id', 'rejected', '_r')},
numbered AS (SELECT pair_id, c.ids AS c, r.ids AS r, (row_number() OVER (ORDER BY pair_id) - 1) // {BATCH} AS batch_id
  FROM encoded_c c JOIN encoded_r r USING (pair_id)),
widths AS (SELECT *, max(len(c)) OVER (PARTITION BY batch_id) AS wc, max(len(r)) OVER (PARTITION BY batch_id) AS wr FROM numbered)"""


def _pair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded pairs; the vocabulary covers prompts and both responses."""
    df = I.pairs(spark, sf_dir)
    return T.encode(
        df, {"chosen": "chosen_input_ids", "rejected": "rejected_input_ids"}, _pair_vocabulary(df), "pair_id")


def _fixed_sql(ids: str, length: int = LENGTH) -> str:
    cut = f"{ids}[1:{length}]"
    gap = f"({length} - least(len({ids}), {length}))"
    return f"array_to_string(list_concat({cut}, list_transform(range({gap}), lambda x: 0)), ',')"


_TEXT_TOKENS_SQL = f"""{I.SCORED_PAIRS_SQL},
texts AS (SELECT prompt || ' ' || chosen || ' ' || rejected AS text FROM clean_pairs),
{_vocabulary_sql('texts')},
sides AS (SELECT pair_id, prompt || ' ' || chosen AS chosen_text, prompt || ' ' || rejected AS rejected_text,
  prompt || CASE WHEN chosen_reward > rejected_reward THEN chosen ELSE rejected END AS best_text,
  abs(chosen_reward - rejected_reward) AS diff FROM scored_pairs),
{_encoded_sql('sides', 'pair_id', 'chosen_text', '_c')},
{_encoded_sql('sides', 'pair_id', 'rejected_text', '_r')},
{_encoded_sql('sides', 'pair_id', 'best_text', '_b')}"""


def _pair_vocabulary(pairs: DataFrame) -> DataFrame:
    texts = pairs.select(F.concat_ws(" ", "prompt", "chosen", "rejected").alias("text"))
    return T.build_vocabulary(texts, "text", VOCABULARY)


@registered(f"""WITH {_TEXT_TOKENS_SQL} SELECT pair_id, {_fixed_sql('c.ids')} AS chosen_ids, {_fixed_sql('r.ids')} AS rejected_ids,
  least(len(c.ids), {LENGTH})::BIGINT AS chosen_tokens, least(len(r.ids), {LENGTH})::BIGINT AS rejected_tokens
FROM encoded_c c JOIN encoded_r r USING (pair_id)""")
def tokenized_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt + response of both sides as ids and masks of fixed length."""
    pairs = P.pair_texts(I.pairs(spark, sf_dir))
    sides = {"chosen_text": "chosen_ids", "rejected_text": "rejected_ids"}
    df = T.encode(pairs, sides, _pair_vocabulary(pairs), "pair_id")
    for ids in sides.values():
        df = T.pad_fixed(df, ids, f"{ids}_mask", LENGTH)
    return df.select(
        "pair_id", listed("chosen_ids").alias("chosen_ids"), listed("rejected_ids").alias("rejected_ids"),
        K.masked_length(F.col("chosen_ids_mask")).cast("long").alias("chosen_tokens"),
        K.masked_length(F.col("rejected_ids_mask")).cast("long").alias("rejected_tokens"))


@registered(f"""WITH {_TEXT_TOKENS_SQL} SELECT pair_id, md5({_fixed_sql('b.ids', EXAMPLE_LENGTH)}) AS input_ids, md5({_fixed_sql('b.ids', EXAMPLE_LENGTH)}) AS labels,
  least(len(b.ids), {EXAMPLE_LENGTH})::BIGINT AS tokens, round(diff, 6) + 0.0 AS score_diff
FROM encoded_b b JOIN sides USING (pair_id) WHERE diff > 0.1""")
def ranked_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The better response of each clear pair as a tokenized example with labels."""
    from prefloom.operators.ranking import better_of_pair

    scored = I.scored_pairs(spark, sf_dir)
    encoded = T.encode(better_of_pair(scored), {"text": "input_ids"}, _pair_vocabulary(scored), "pair_id")
    df = T.causal_labels(T.pad_fixed(encoded, "input_ids", "mask", EXAMPLE_LENGTH))
    return rounded(df.select(
        "pair_id", F.md5(listed("input_ids")).alias("input_ids"), F.md5(listed("labels")).alias("labels"),
        K.masked_length(F.col("mask")).cast("long").alias("tokens"), "score_diff"))


def _padded_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _pair_tokens(spark, sf_dir).select("pair_id", "chosen_input_ids", "rejected_input_ids")
    # only the keys are put in order and written
    batches = O.assign_batches(I.pairs(spark, sf_dir).select("pair_id"), ["pair_id"], BATCH).select("pair_id", "batch_id")
    return T.pad_to_longest(tokens.join(batches, "pair_id"), {
        "chosen_input_ids": "chosen_attention_mask", "rejected_input_ids": "rejected_attention_mask"})


def _pad_sql(ids: str, width: str, fill: str = "0") -> str:
    return f"md5(array_to_string(list_concat({ids}, list_transform(range({width} - len({ids})), lambda x: {fill})), ','))"


@registered(f"""WITH {_PAIR_TOKENS_SQL} SELECT pair_id, batch_id, {_pad_sql('c', 'wc')} AS chosen_ids,
  {_pad_sql('list_transform(c, lambda x: 1)', 'wc')} AS chosen_mask, {_pad_sql('r', 'wr')} AS rejected_ids,
  {_pad_sql('list_transform(r, lambda x: 1)', 'wr')} AS rejected_mask FROM widths""")
def batch_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _padded_pairs(spark, sf_dir)
    return df.select(
        "pair_id", "batch_id", F.md5(listed("chosen_input_ids")).alias("chosen_ids"),
        F.md5(listed("chosen_attention_mask")).alias("chosen_mask"),
        F.md5(listed("rejected_input_ids")).alias("rejected_ids"),
        F.md5(listed("rejected_attention_mask")).alias("rejected_mask"))


@registered(f"""WITH {I.PAIRS_SQL}, numbered AS (
  SELECT *, (row_number() OVER (ORDER BY pair_id) - 1) // {BATCH} AS batch_id FROM clean_pairs)
SELECT batch_id, count(*) AS rows, md5(string_agg(prompt, '|' ORDER BY pair_id)) AS prompts,
  md5(string_agg(chosen, '|' ORDER BY pair_id)) AS chosen, md5(string_agg(rejected, '|' ORDER BY pair_id)) AS rejected
FROM numbered GROUP BY batch_id""")
def collated_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = T.collate(I.pairs(spark, sf_dir), ["pair_id"], BATCH, ["prompt", "chosen", "rejected"])
    return df.select(
        "batch_id", F.size("prompt").cast("long").alias("rows"),
        F.md5(F.array_join("prompt", "|")).alias("prompts"), F.md5(F.array_join("chosen", "|")).alias("chosen"),
        F.md5(F.array_join("rejected", "|")).alias("rejected"))


@registered(f"""WITH {_PAIR_TOKENS_SQL}, faults AS (
  SELECT batch_id, pair_id % 7 = 0 AS gone, pair_id % 5 = 3 AND len(r) > 0 AS cut, pair_id % 6 = 5 AS long FROM widths),
b AS (SELECT batch_id, count_if(gone) AS gone, count_if(cut OR long) AS differ,
  bool_or(long) AND NOT bool_and(long) AS ragged FROM faults GROUP BY batch_id)
SELECT unnest(['chosen_input_ids_null', 'rejected_input_ids_null', 'chosen_attention_mask_null', 'rejected_attention_mask_null',
  'chosen_input_ids_and_mask_differ', 'chosen_input_ids_ragged_batches', 'rejected_input_ids_and_mask_differ',
  'rejected_input_ids_ragged_batches', 'side_sizes_differ']) AS rule,
  unnest([sum(gone)::BIGINT, 0, 0, 0, 0, 0, sum(differ)::BIGINT, count_if(ragged), count_if(gone > 0)])::BIGINT AS violations FROM b""")
def batch_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches with planted faults: missing ids, masks that are too short, ids that are too long."""
    df = _padded_pairs(spark, sf_dir)
    key, mask = F.col("pair_id"), F.col("rejected_attention_mask")
    short = (key % 5 == 3) & (F.aggregate(mask, F.lit(0), lambda a, x: a + x) > 0)
    return validation.validate_batches(df.withColumns({
        "chosen_input_ids": F.when(key % 7 != 0, F.col("chosen_input_ids")),
        "rejected_attention_mask": F.when(short, F.slice(mask, 1, F.greatest(F.size(mask) - 1, F.lit(0)))).otherwise(mask),
        "rejected_input_ids": F.when(key % 6 == 5, F.concat("rejected_input_ids", F.array(F.lit(9)))).otherwise(F.col("rejected_input_ids"))}))


@registered(f"""WITH {I.RESPONSE_TOKENS_SQL}, before AS (
  SELECT rollout_id, pos, token_id, {I.distribution_sql('(prompt_len - 1 + pos)', 0)} AS logits
  FROM response_tokens JOIN (SELECT rollout_id, prompt_len FROM rollouts) USING (rollout_id) WHERE prompt_len > 0)
SELECT rollout_id, count(*) AS tokens, round(sum(logits[token_id + 1]), 6) + 0.0 AS chosen_logits, round(sum(list_sum(logits)), 6) + 0.0 AS all_logits
FROM before GROUP BY rollout_id""")
def response_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distributions that the response tokens were drawn from: one place before them, cut at the same end."""
    df = I.rollouts(spark, sf_dir).where("prompt_len > 0")
    every = F.transform(F.sequence(F.lit(0), F.size("full_ids") - 1), lambda p: I.distribution(F.col("e"), p, 0))
    ids = K.response_ids(F.col("full_ids"), F.col("prompt_len"), I.END_TOKEN)
    df = df.select("rollout_id", ids.alias("ids"), K.response_distributions(every, F.col("full_ids"), F.col("prompt_len"), I.END_TOKEN).alias("dists"))
    total = F.aggregate("dists", F.lit(0.0), lambda a, d: a + F.aggregate(d, F.lit(0.0), lambda b, x: b + x))
    chosen = F.aggregate(F.zip_with("dists", "ids", lambda d, i: F.get(d, i)), F.lit(0.0), lambda a, x: a + x)
    return rounded(df.where("ids is not null").select(
        "rollout_id", F.size("dists").cast("long").alias("tokens"), chosen.alias("chosen_logits"), total.alias("all_logits")))


@registered(f"""WITH {I.ROLLOUTS_SQL}, tails AS (SELECT rollout_id, full_ids[prompt_len + 1:] AS tail FROM rollouts)
SELECT rollout_id, array_to_string(CASE WHEN list_position(tail, {I.END_TOKEN}) > 0
  THEN tail[1:list_position(tail, {I.END_TOKEN}) - 1] ELSE tail END, ',') AS ids
FROM tails WHERE len(CASE WHEN list_position(tail, {I.END_TOKEN}) > 0
  THEN tail[1:list_position(tail, {I.END_TOKEN}) - 1] ELSE tail END) > 0""")
def response_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = K.response_ids(F.col("full_ids"), F.col("prompt_len"), I.END_TOKEN)
    df = I.rollouts(spark, sf_dir).select("rollout_id", listed(ids).alias("ids"))
    return df.where(F.col("ids").isNotNull())


@registered(f"""WITH {I.ROLLOUTS_SQL}
SELECT rollout_id, prompt_len::INT AS prompt_len FROM rollouts WHERE len(full_ids) - (prompt_len + 1) > 0""")
def rollouts_with_room(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prefloom.operators.rollouts import with_room_for_response

    return with_room_for_response(I.rollouts(spark, sf_dir)).select("rollout_id", "prompt_len")
