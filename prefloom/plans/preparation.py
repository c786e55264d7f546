"""Queries: sources, transcripts, text cleaning and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from prefloom.functions import text as X
from prefloom.operators import alignment, pairs as P, ranking, validation
from prefloom.plans import inputs as I
from prefloom.plans.registry import registered, table
from prefloom.sources import logs, results
from prefloom.sources.pairs import read_pairs
from prefloom.sources.scratch import scratch_path

HEAD_ROWS = 100


@registered(f"WITH {I.RAW_PAIRS_SQL} SELECT split, count(*) AS pairs, sum(length(chosen))::BIGINT AS chosen_chars, "
            "sum(length(rejected))::BIGINT AS rejected_chars FROM raw_pairs GROUP BY split")
def pairs_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pairs written by split, each split read back through the pair source."""
    path = scratch_path(spark, "raw-pairs")
    I.raw_pairs(spark, sf_dir).write.partitionBy("split").parquet(path)
    parts = [read_pairs(spark, "local/hh-rlhf", path, limit=None, split=s) for s in ("train", "test")]
    return parts[0].unionByName(parts[1]).groupBy("split").agg(
        F.count("*").alias("pairs"), F.sum(F.length("chosen")).alias("chosen_chars"),
        F.sum(F.length("rejected")).alias("rejected_chars"))


@registered(f"WITH {I.RAW_PAIRS_SQL} SELECT pair_id, md5(chosen) AS chosen, md5(rejected) AS rejected FROM raw_pairs "
            f"ORDER BY pair_id LIMIT {HEAD_ROWS}")
def first_raw_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered subset that is taken before any filter."""
    path = scratch_path(spark, "raw-pairs")
    I.raw_pairs(spark, sf_dir).write.json(path)
    df = read_pairs(spark, "HH-RLHF", path, limit=HEAD_ROWS, fmt="json", split=None)
    return df.select("pair_id", F.md5("chosen").alias("chosen"), F.md5("rejected").alias("rejected"))


@registered(f"WITH {I.PAIRS_SQL} SELECT pair_id, prompt, chosen, rejected FROM parsed_pairs")
def parsed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parse_pairs(I.raw_pairs(spark, sf_dir).drop("split"))


@registered(f"WITH {I.PAIRS_SQL} SELECT pair_id, prompt, chosen, rejected FROM valid_pairs")
def valid_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.pairs(spark, sf_dir, clean=False)


@registered(f"WITH {I.PAIRS_SQL} SELECT pair_id, prompt, chosen, rejected FROM clean_pairs")
def clean_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.pairs(spark, sf_dir)


@registered(f"""WITH {I.RAW_PAIRS_SQL}, edged AS (
  SELECT pair_id, {I.strip_sql('chosen')} AS c, {I.strip_sql('rejected')} AS r FROM raw_pairs)
SELECT pair_id, 'Continue the conversation:' AS prompt, md5(c) AS chosen, md5(r) AS rejected FROM edged
WHERE c <> r AND c <> '' AND r <> ''""")
def pairs_without_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the long marker the transcripts have no marked turn, so the fallback prompt applies."""
    raw = I.raw_pairs(spark, sf_dir).drop("split")
    df = P.valid_pairs(P.parse_pairs(raw, X.LONG_TURN_MARKER))
    return df.select("pair_id", "prompt", F.md5("chosen").alias("chosen"), F.md5("rejected").alias("rejected"))


@registered(f"""WITH {I.PAIRS_SQL}
SELECT pair_id, md5(prompt || ' ' || coalesce(chosen, '')) AS chosen_text,
       md5(prompt || coalesce(rejected, '')) AS rejected_text FROM clean_pairs""")
def composed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.pairs(spark, sf_dir)
    spaced = P.pair_texts(df).select("pair_id", F.md5("chosen_text").alias("chosen_text"))
    joined = P.pair_texts(df, sep="").select("pair_id", F.md5("rejected_text").alias("rejected_text"))
    return alignment.zip_by_key(spaced, joined, "pair_id")


@registered(f"""SELECT doc_id, length({I.strip_sql('text')})::BIGINT AS stripped_chars, md5({I.clean_sql('text')}) AS cleaned,
  {I.strip_sql('text')} = '' AS blank FROM documents""")
def cleaned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length(X.strip("text")).cast("long").alias("stripped_chars"),
        F.md5(X.clean_text("text")).alias("cleaned"), X.is_blank("text").alias("blank"))


# Raw generated replies: the prompt echoed, a leading human turn, or none, and turns that go on after the reply.
_REPLIES_SQL = f"""{I.PAIRS_SQL},
formatted AS (
  SELECT pair_id, prompt, chosen, CASE WHEN starts_with(prompt, 'Human:') THEN prompt
         ELSE 'Human: ' || prompt || chr(10) || chr(10) || 'Assistant:' END AS full_prompt FROM valid_pairs),
replies AS (
  SELECT pair_id, prompt, full_prompt, CASE pair_id % 3
      WHEN 0 THEN full_prompt || ' ' || chosen || chr(10) || ' Human: ' || prompt || chr(10) || 'Assistant: more'
      WHEN 1 THEN 'Human: again' || chr(10) || 'Assistant: ' || chosen || chr(10) || chr(10) || 'Assistant: and'
      ELSE 'Human: ' || prompt END AS reply
  FROM formatted)"""


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = P.with_prompt(I.pairs(spark, sf_dir, clean=False))
    full = X.generation_prompt("prompt")
    kind = F.pmod("pair_id", F.lit(3))
    reply = (
        F.when(kind == 0, F.concat(full, F.lit(" "), "chosen", F.lit("\n Human: "), "prompt", F.lit("\nAssistant: more")))
        .when(kind == 1, F.concat(F.lit("Human: again\nAssistant: "), "chosen", F.lit("\n\nAssistant: and")))
        .otherwise(F.concat(F.lit("Human: "), "prompt")))
    return df.select("pair_id", "prompt", full.alias("full_prompt"), reply.alias("reply"))


@registered(f"WITH {_REPLIES_SQL} SELECT pair_id, full_prompt FROM replies")
def generation_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replies(spark, sf_dir).select("pair_id", "full_prompt")


def _broken_sql(source: str, key: str, text: str) -> str:
    """(key, broken) of a text column, as CTEs ``word_share`` and ``broken``."""
    chars = " OR ".join(f"{I.count_sql(text, c)} > 20" for c in X.REPEATABLE_CHARS)
    nonsense = " OR ".join(f"{I.count_sql(text, w)} > 5" for w in X.NONSENSE_WORDS)
    return f"""
one_word AS (SELECT {key}, unnest({I.words_sql(text)}) AS w FROM {source}),
word_counts AS (SELECT {key}, w, count(*) AS c FROM one_word GROUP BY ALL),
word_share AS (SELECT {key}, max(c) AS top, sum(c) AS n FROM word_counts GROUP BY {key}),
broken AS (
  SELECT {key}, (length({text}) < 5 OR {chars} OR {nonsense} OR coalesce(n > 5 AND top > n * 0.3, false)) AS broken
  FROM {source} LEFT JOIN word_share USING ({key}))"""


_LINES = "string_split(lead, chr(10))"
_STRIPPED_LINES = f"list_transform({_LINES}, lambda x: {I.strip_sql('x')})"


@registered(f"""WITH {_REPLIES_SQL},
bare AS (SELECT pair_id, prompt, {I.strip_sql('CASE WHEN starts_with(reply, full_prompt) THEN substr(reply, length(full_prompt) + 1) ELSE reply END')} AS t FROM replies),
led AS (SELECT pair_id, prompt, CASE WHEN starts_with(t, 'Human:') AND instr(t, 'Assistant:') > 0
   THEN {I.strip_sql("substr(t, instr(t, 'Assistant:') + 10)")} WHEN starts_with(t, 'Human:') THEN '' ELSE t END AS lead FROM bare),
lined AS (SELECT pair_id, prompt, {_STRIPPED_LINES} AS lines FROM led),
stops AS (SELECT *, list_position(list_transform(lines, lambda x: starts_with(x, 'Human:')), true) AS stop FROM lined),
cleaned AS (SELECT pair_id, prompt, {I.strip_sql("coalesce(array_to_string(list_filter(CASE WHEN stop > 0 THEN lines[1:stop - 1] ELSE lines END, lambda x: x <> '' AND NOT starts_with(x, 'Assistant:')), ' '), '')")} AS cleaned FROM stops),
{_broken_sql('cleaned', 'pair_id', 'cleaned')}
SELECT pair_id, cleaned, broken, CASE WHEN broken THEN CASE pair_id % 5
    WHEN 0 THEN 'I''d be happy to help with that question.'
    WHEN 1 THEN 'That''s an interesting topic. Let me provide some helpful information.'
    WHEN 2 THEN 'I can help you with that. Here''s what I know:'
    WHEN 3 THEN 'That''s a good question. Let me explain:'
    ELSE 'I understand what you''re asking about.' END ELSE cleaned END AS response
FROM cleaned JOIN broken USING (pair_id)""")
def cleaned_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = P.clean_replies(_replies(spark, sf_dir), pick="pair_id")
    return df.select("pair_id", "cleaned", "broken", "response")


@registered(f"""WITH {_broken_sql('documents', 'doc_id', 'text')}
SELECT doc_id, broken FROM broken""")
def broken_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.is_broken("text").alias("broken"))


@registered("""SELECT conv_id, turn, (length(text) < 5 OR len(list_distinct(string_split(text, ''))) < 5) AS corrupt
FROM conversations""")
def corrupt_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.is_corrupt("text").alias("corrupt"))


@registered(f"""WITH {I.PAIRS_SQL} SELECT pair_id AS idx,
  CASE WHEN length(prompt) > 100 THEN substr(prompt, 1, 100) || '...' ELSE prompt END AS prompt,
  CASE WHEN length(chosen) > 200 THEN substr(chosen, 1, 200) || '...' ELSE chosen END AS response FROM clean_pairs""")
def sample_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.sample_table(I.pairs(spark, sf_dir), "pair_id", response="chosen")


@registered(f"""WITH {I.PAIRS_SQL}, s AS (SELECT pair_id AS idx, prompt, unnest([chosen, rejected]) AS response FROM clean_pairs)
SELECT idx, CASE WHEN length(prompt) > 100 THEN substr(prompt, 1, 100) || '...' ELSE prompt END AS prompt,
  CASE WHEN length(response) > 200 THEN substr(response, 1, 200) || '...' ELSE response END AS response FROM s""")
def samples_appended_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample tables of both responses, that of the chosen one appended twice under one write's name."""
    path, pairs = scratch_path(spark, "samples"), I.pairs(spark, sf_dir)
    for side in ("chosen", "chosen", "rejected"):
        logs.append_once(logs.sample_table(pairs, "pair_id", response=side), path, side)
    return logs.read_once(spark, path, "idx bigint, prompt string, response string")


@registered("""SELECT lang, avg(coalesce(quality, 0.0)) AS quality, avg(coalesce(toxic, 1.0)) AS toxic
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def metric_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent labels count with their default."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("double"), F.col("toxic").cast("double"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.join(labels, "doc_id", "left").groupBy("lang").agg(
        F.avg(X.default_metric("quality")).alias("quality"), F.avg(X.default_metric("toxic", 1.0)).alias("toxic"))


@registered(f"""WITH {I.PAIRS_SQL}, info AS (SELECT count(*) AS rows FROM valid_pairs)
SELECT rows, field, type FROM info, (VALUES ('pair_id', 'bigint'), ('prompt', 'string'), ('chosen', 'string'),
  ('rejected', 'string')) v(field, type)""")
def pair_table_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.dataset_info(I.pairs(spark, sf_dir, clean=False))


@registered(f"""WITH {I.PAIRS_SQL}, checked AS (
  SELECT count(*) AS n, count(*) FILTER (chosen IS NULL) AS cn, count(*) FILTER ({I.strip_sql('chosen')} = '') AS cb,
    count(*) FILTER (rejected IS NULL) AS rn, count(*) FILTER ({I.strip_sql('rejected')} = '') AS rb FROM parsed_pairs)
SELECT 'dataset_empty' AS rule, (n = 0)::BIGINT AS violations FROM checked UNION ALL
SELECT 'chosen_null', cn FROM checked UNION ALL SELECT 'chosen_blank', cb FROM checked UNION ALL
SELECT 'rejected_null', rn FROM checked UNION ALL SELECT 'rejected_blank', rb FROM checked""")
def pair_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = P.parse_pairs(I.raw_pairs(spark, sf_dir).drop("split"))
    return validation.validate_pairs(df, ("chosen", "rejected"))


@registered(f"""WITH {I.PAIRS_SQL}
SELECT count(*) AS pairs, count(*) FILTER (chosen <> rejected AND chosen <> '' AND rejected <> '') AS examples
FROM parsed_pairs""")
def pair_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, r = F.col("chosen"), F.col("rejected")
    kept = (c != r) & (c != "") & (r != "")
    return ranking.ranking_yield(P.parse_pairs(I.raw_pairs(spark, sf_dir)).withColumn("kept", kept))


@registered("""WITH d AS (SELECT lang, count(*)::DOUBLE AS n, avg(n_chars) AS chars FROM documents GROUP BY lang)
SELECT lang, n AS bleu, round(chars, 6) AS avg_response_length, 0.0::DOUBLE AS reward_std FROM d""")
def result_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested document per language, written as JSON and read back with its schema."""
    path = scratch_path(spark, "results")
    docs = table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count("*").cast("double").alias("n"), F.avg("n_chars").alias("chars"))
    nested = docs.select(
        F.struct(F.col("n").alias("bleu"), F.col("chars").alias("avg_response_length")).alias("model_quality"),
        F.struct(F.array("lang").alias("prompts")).alias("sample_generations"))
    results.write_documents(nested, path)
    back = results.read_documents(spark, path, results.EVALUATION_DOC)
    return back.select(
        F.col("sample_generations.prompts")[0].alias("lang"), "model_quality.bleu",
        F.round("model_quality.avg_response_length", 6).alias("avg_response_length"),
        X.default_metric("model_quality.reward_std").alias("reward_std"))


@registered("SELECT doc_id, quality::INT AS quality FROM labels")
def written_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write to the same place changes nothing unless it is forced."""
    path = scratch_path(spark, "once")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    results.write_once(labels.withColumn("quality", F.lit(-1)), path)
    results.write_once(labels, path, force=True)
    results.write_once(labels.where(F.lit(False)), path)
    return spark.read.schema(labels.schema).parquet(path)


@registered("""WITH daily AS (SELECT event_type AS run_id, date_diff('day', DATE '2024-01-01', ts::DATE) AS epoch, round(avg(value), 6) AS v,
    round(max(value), 6) AS top FROM events GROUP BY ALL),
c AS (SELECT run_id, 'mean' AS metric, list(v ORDER BY epoch) AS vals FROM daily GROUP BY run_id
  UNION ALL SELECT run_id, 'top', list(top ORDER BY epoch) FROM daily GROUP BY run_id)
SELECT run_id, metric, len(vals)::BIGINT AS points, round(list_sum(vals), 4) + 0.0 AS total FROM c""")
def history_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily curves of each event type, stored as one bare map per folder and read back; a type has one point a day."""
    root = scratch_path(spark, "histories")
    log = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    daily = log.groupBy("event_type", "day").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.max("value"), 6).alias("top"))
    curve = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("day", c))), lambda x: x[c])
    maps = daily.groupBy("event_type").agg(F.to_json(F.create_map(F.lit("mean"), curve("mean"), F.lit("top"), curve("top"))).alias("value"))
    maps.repartition("event_type").write.partitionBy("event_type").text(root)
    read = results.read_histories(spark, root, run="event_type").select("run_id", F.explode("history").alias("metric", "vals"))
    total = F.aggregate("vals", F.lit(0.0), lambda a, x: a + x)
    return read.select("run_id", "metric", F.size("vals").cast("long").alias("points"), (F.round(total, 4) + F.lit(0.0)).alias("total"))
