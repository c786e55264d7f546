import json

import pytest
from pyspark.sql import functions as F

from prefloom.sources import logs, results, scratch
from prefloom.sources.pairs import read_pairs


@pytest.fixture
def pair_path(spark, tmp_path):
    rows = [(i, f"c{i}", f"r{i}", "train" if i % 2 else "test") for i in range(20)]
    df = spark.createDataFrame(rows, "pair_id long, chosen string, rejected string, split string")
    df.write.partitionBy("split").parquet(str(tmp_path / "pq"))
    df.write.json(str(tmp_path / "js"))
    return tmp_path


def test_pair_source(spark, pair_path):
    df = read_pairs(spark, "org/HH-RLHF", str(pair_path / "pq"), limit=3)
    assert sorted(r.pair_id for r in df.collect()) == [1, 3, 5]
    assert "PartitionFilters: [isnotnull(split" in df._jdf.queryExecution().toString()
    assert read_pairs(spark, "hh-rlhf", str(pair_path / "js"), fmt="json").count() == 10
    assert read_pairs(spark, "hh-rlhf", str(pair_path / "pq"), split=None, limit=None).count() == 20
    with pytest.raises(ValueError):
        read_pairs(spark, "other", str(pair_path / "pq"))
    with pytest.raises(ValueError):
        read_pairs(spark, "hh-rlhf", str(pair_path / "pq"), loader="plain")


def test_result_documents(spark, tmp_path):
    assert results.read_documents(spark, str(tmp_path / "absent"), results.EVALUATION_DOC).count() == 0
    doc = {"model_quality": {"bleu": 0.5}, "sample_generations": {"prompts": ["a"], "responses": ["b"]}}
    (tmp_path / "one.json").write_text(json.dumps(doc, indent=2))
    row = results.read_documents(spark, str(tmp_path / "one.json"), results.EVALUATION_DOC, whole_files=True).first()
    assert row.model_quality.bleu == 0.5 and row.model_quality.rouge is None and row.preference_alignment is None
    df = results.read_documents(spark, str(tmp_path / "one.json"), results.EVALUATION_DOC, whole_files=True)
    results.write_documents(df, str(tmp_path / "out"))
    assert results.read_documents(spark, str(tmp_path / "out"), results.EVALUATION_DOC).first() == row
    phases = {"phases_completed": ["a", "b"], "performance_metrics": {"ppo_success": True, "evaluation_results": {"reward_scores": [1.0, 2.0]}}}
    (tmp_path / "run.json").write_text(json.dumps(phases))
    run = results.read_documents(spark, str(tmp_path / "run.json"), results.PIPELINE_DOC, whole_files=True).first()
    assert run.performance_metrics.evaluation_results.reward_scores == [1.0, 2.0]


def test_histories_are_bare_maps(spark, tmp_path):
    for run, curve in (("first", [1.0, 0.5]), ("second", [])):
        (tmp_path / f"{run}.json").write_text(json.dumps({"ppo_loss": curve}, indent=2))
    got = {r.run_id: r.history for r in results.read_histories(spark, str(tmp_path)).collect()}
    assert got == {"first": {"ppo_loss": [1.0, 0.5]}, "second": {"ppo_loss": []}}
    assert results.read_histories(spark, str(tmp_path / "none")).collect() == []


def test_write_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for n, force in ((1, False), (2, False), (3, True)):
        results.write_once(spark.range(n), path, force)
        assert spark.read.parquet(path).count() == (1 if n < 3 else 3)


def test_logs(spark, tmp_path):
    df = spark.createDataFrame([("r1", 1, 2.0, None), ("r2", 1, 3.0, 0.5)], "run_id string, step long, loss double, acc double")
    long = logs.long_metrics(df, ["run_id", "step"], ["loss", "acc"])
    for _ in range(2):
        logs.append_metrics(long, str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m"))
    assert back.count() == 6 and sorted(p.name for p in (tmp_path / "m").glob("run_id=*")) == ["run_id=r1", "run_id=r2"]
    sample = spark.createDataFrame([(7, "p" * 101, "r" * 201)], "i int, prompt string, response string")
    logs.append_samples(sample, str(tmp_path / "s"), "i")
    row = spark.read.parquet(str(tmp_path / "s")).first()
    assert (row.idx, len(row.prompt), len(row.response)) == (7, 103, 203)


def test_many_runs_share_folders(spark, tmp_path):
    """Files and folders do not grow with the runs; null runs, repeated rows and a second write are kept."""
    runs = spark.range(3000).selectExpr("nullif(id div 2, 7) AS run_id", "1L AS step", "'loss' AS name", "id / 2 AS num_value")
    path, shape = str(tmp_path / "m"), "run_id long, step long, name string, num_value double"
    both = runs.unionByName(runs.where("run_id = 5"))
    for _ in range(2):
        logs.append_metrics(both, path, folders=4)
    back = logs.read_metrics(spark, path, shape)
    assert back.columns == both.columns
    assert back.exceptAll(both.unionByName(both)).count() == 0 and back.count() == 2 * both.count()
    assert len(list((tmp_path / "m").glob("run_part=*"))) == 4
    assert len(list((tmp_path / "m").glob("*/*.parquet"))) <= 8


def test_registered_metrics_have_few_files(spark, tmp_path):
    from prefloom.plans import training_logs

    events = spark.range(600).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-02 03:00:00' AS ts", "id AS user_id", "'view' AS event_type",
        "id / 4 AS value", "concat('{\"k\": ', id % 100, '}') AS props")
    events.write.parquet(str(tmp_path / "events.parquet"))
    back = training_logs.appended_metrics(spark, str(tmp_path))
    assert back.count() == 1200 and len(back.inputFiles()) <= 2 * training_logs.METRIC_FOLDERS
    assert {tuple(r) for r in back.where("run_id = 599").collect()} == {(599, 1, 599, "loss", 14.975), (599, 1, 599, "accuracy", 0.99)}


def test_scratch_uses_the_session_folder(spark):
    df = scratch.written(spark.range(5).withColumn("x", F.lit("a")), "t")
    assert df.count() == 5 and scratch.checkpoint_folder(spark) in df.inputFiles()[0]


def test_a_write_counts_once(spark, tmp_path):
    from prefloom.sources import logs

    path, shape = str(tmp_path / "log"), "step int, v double"
    rows = lambda *values: spark.createDataFrame([(i, v) for i, v in enumerate(values)], shape)
    assert logs.read_once(spark, path, shape).collect() == []
    rows(9.0, 9.0).write.parquet(f"{path}/rows/write_id=b")  # a write that broke off before its name was listed
    assert logs.append_once(rows(1.0, 2.0), path, "a") and not logs.append_once(rows(5.0), path, "a")
    assert [tuple(r) for r in logs.read_once(spark, path, shape).orderBy("step").collect()] == [(0, 1.0), (1, 2.0)]
    assert logs.append_once(rows(3.0), path, "b")  # its retry replaces what was left
    assert sorted(r.v for r in logs.read_once(spark, path, shape).collect()) == [1.0, 2.0, 3.0]
    assert logs.append_once(rows(), path, "c") and logs.read_once(spark, path, shape).count() == 3
