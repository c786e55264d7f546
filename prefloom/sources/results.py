"""Result documents (nested JSON) and write-once tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T, functions as F


def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


_TEXTS = T.ArrayType(T.StringType())
_QUALITY = _doubles("bleu", "rouge", "bertscore", "avg_response_length", "avg_reward_score", "reward_std")

EVALUATION_DOC = T.StructType([
    T.StructField("model_quality", _QUALITY),
    T.StructField("preference_alignment", _doubles(
        "preference_accuracy", "avg_reward_difference", "chosen_avg_reward", "rejected_avg_reward")),
    T.StructField("sample_generations", T.StructType([
        T.StructField("prompts", _TEXTS), T.StructField("responses", _TEXTS)])),
])

SCORES_DOC = T.StructType([
    T.StructField("prompts", _TEXTS),
    T.StructField("responses", _TEXTS),
    T.StructField("quality_metrics", _QUALITY),
    T.StructField("reward_scores", T.ArrayType(T.DoubleType())),
    T.StructField("average_reward_score", T.DoubleType()),
    T.StructField("response_quality_score", T.DoubleType()),
    T.StructField("average_perplexity", T.DoubleType()),
])

PIPELINE_DOC = T.StructType([
    T.StructField("pipeline_start_time", T.DoubleType()),
    T.StructField("pipeline_end_time", T.DoubleType()),
    T.StructField("total_pipeline_time", T.DoubleType()),
    T.StructField("total_training_time", T.DoubleType()),
    T.StructField("phases_completed", _TEXTS),
    T.StructField("phases_failed", _TEXTS),
    T.StructField("final_model_path", T.StringType()),
    T.StructField("performance_metrics", T.StructType([
        T.StructField("ppo_success", T.BooleanType()),
        T.StructField("supervised_success", T.BooleanType()),
        T.StructField("avg_reward_score", T.DoubleType()),
        T.StructField("avg_perplexity", T.DoubleType()),
        T.StructField("evaluation_results", SCORES_DOC),
    ])),
])

HISTORY = T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))


def read_histories(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """``(run_id, history)``: every file is one bare JSON map of curves; its name without the ending is the run, or a ``run`` column of its folders.

    An absent path gives an empty table.
    """
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], T.StructType([T.StructField("run_id", T.StringType()), T.StructField("history", HISTORY)]))
        raise
    name = F.col(run) if run else F.regexp_replace(F.element_at(F.split("_metadata.file_path", "/"), -1), r"\.[^.]*$", "")
    return files.select(name.alias("run_id"), F.from_json("value", HISTORY).alias("history"))


def read_documents(spark: SparkSession, path: str, schema: T.StructType, whole_files: bool = False) -> DataFrame:
    """JSON documents with a declared schema; an absent path gives an empty table.

    ``whole_files`` is for one pretty-printed document per file; tables written
    by :func:`write_documents` hold one document per line and can be split.
    """
    try:
        return spark.read.schema(schema).option("multiLine", whole_files).json(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def write_documents(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_once(df: DataFrame, path: str, force: bool = False) -> None:
    """Write unless the table is already there; ``force`` replaces it."""
    df.write.mode("overwrite" if force else "ignore").parquet(path)
