import math

import pytest
from pyspark.sql import functions as F

from prefloom.operators import alignment as A, losses as L, ranking as R
from prefloom.operators.histograms import histogram

NAN = float("nan")


@pytest.fixture(scope="module")
def rewards(spark):
    return spark.createDataFrame([(1, 0.8, 0.3), (2, 0.6, 0.4)], "pair_id long, chosen_reward double, rejected_reward double")


@pytest.mark.parametrize("name, margin, value", [
    ("bradley_terry", 0.5, 0.15), ("hinge", 0.5, 0.15), ("log_sigmoid", 0.5, 0.773751), ("bradley_terry", 0.0, 0.536108)])
def test_losses(rewards, name, margin, value):
    row = L.loss_metrics(rewards, name, margin).first()
    assert row.loss_value == pytest.approx(value, abs=1e-6)
    assert row.preference_accuracy == 1.0 and row.reward_diff_mean == pytest.approx(0.35)


def test_margin_satisfaction_and_extreme_differences(spark):
    df = spark.createDataFrame([(1.0, 0.25), (1.0, 0.75)], "chosen_reward double, rejected_reward double")
    assert L.loss_metrics(df, "hinge", 0.5).first().margin_satisfaction == 0.5
    absent = spark.createDataFrame([(None, 1.0), (1.0, 0.0)], "chosen_reward double, rejected_reward double")
    assert L.loss_metrics(absent, "hinge", 3.0).first().loss_value == 2.0
    far = spark.createDataFrame([(-800.0, 0.0)], "chosen_reward double, rejected_reward double")
    assert L.loss_metrics(far, "bradley_terry").first().loss_value == 800.0


def test_loss_names_and_margins(spark):
    c, r = F.lit(1.0), F.lit(0.0)
    assert L.available_losses()[:3] == ["bradley_terry", "hinge", "log_sigmoid"]
    for name, margin in (("none", 0.0), ("hinge", 0.0), ("log_sigmoid", -1.0), ("hinge", "x"), ("hinge", True)):
        with pytest.raises(ValueError):
            L.loss_column(name, c, r, margin)
    with pytest.raises(ValueError):
        L.register_loss("bad", 3)
    L.register_loss("gap", lambda c, r, m: c - r)
    assert spark.range(1).select(L.loss_column("gap", c, r)).first()[0] == 1.0


def test_alignment_edges(spark):
    schema = "chosen_reward double, rejected_reward double"
    empty = A.preference_alignment(spark.createDataFrame([], schema)).first()
    assert empty.preference_accuracy == 0.0 and empty.avg_reward_difference is None
    df = spark.createDataFrame([(NAN, 0.0), (1.0, 1.0), (2.0, 1.0), (0.0, NAN)], schema)
    assert A.preference_alignment(df).first().preference_accuracy == 0.25
    one = spark.createDataFrame([("a b", 1.0)], "response string, reward double")
    assert tuple(A.response_stats(one).first()) == (2.0, 1.0, None)
    assert A.average_reward(one.limit(0)).first()[0] == 0.0


def test_better_of_pair(spark):
    rows = [(1, 1.0, 0.5), (2, 0.25, 1.0), (3, 1.0, 1.0), (4, 1.0, 0.95), (5, NAN, 0.0)]
    df = spark.createDataFrame([(i, "p", "c", "r", a, b) for i, a, b in rows],
                               "pair_id int, prompt string, chosen string, rejected string, chosen_reward double, rejected_reward double")
    got = {r.pair_id: (r.text, r.score, r.score_diff) for r in R.better_of_pair(df).collect()}
    assert got == {1: ("pc", 1.0, 0.5), 2: ("pr", 1.0, 0.75)}


def test_best_of_many_candidates(spark):
    # One prompt holds most rows.
    rows = [(0, i, float(i % 997)) for i in range(3000)] + [(1, 0, 1.0), (1, 1, 3.0), (1, 2, NAN), (2, 0, 1.0), (2, 1, 1.05), (3, 0, 9.0)]
    df = spark.createDataFrame(rows, "prompt_id int, candidate_id int, reward double").repartition(4)
    best = R.best_of_candidates(df)
    got = {r.prompt_id: (r.candidate_id, r.reward, r.score_diff) for r in best.collect()}
    assert got == {1: (1, 3.0, 2.0)}
    got = {r.prompt_id: (r.candidate_id, r.score_diff) for r in R.best_of_candidates(df, threshold=-1.0).collect()}
    assert got[0] == (996, 0.0) and set(got) == {0, 1, 2}
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and ", Partial" in plan


def test_comparisons_and_report(spark):
    rows = [(i, m, f"p{i}", f"{m} {i}", float(i * k)) for i in range(6) for m, k in (("base", 1), ("ppo", 2), ("supervised", 0))]
    df = spark.createDataFrame(rows, "prompt_id long, model string, prompt string, response string, reward double")
    base, ppo = df.where("model = 'base'"), df.where("model = 'ppo'")
    row = A.compare_two(ppo, base).first()
    assert row.win_rate_model_1 == pytest.approx(5 / 6)
    assert row.model_1_samples == ["ppo 0", "ppo 1", "ppo 2"] and row.model_2_metrics.avg_reward_score == 2.5
    wide = A.side_by_side(df, ["base", "ppo", "supervised"]).where("prompt_id = 3").first()
    assert (wide.base_response, wide.ppo_reward, wide.supervised_reward) == ("base 3", 6.0, 0.0)
    pairs = spark.createDataFrame([(1.0, 0.0)], "chosen_reward double, rejected_reward double")
    references = ppo.selectExpr("prompt_id", "response || ' and more' as reference")
    doc = A.evaluation_report(ppo, pairs, references, ["bleu"]).first()
    # two words have no four-grams
    assert doc.model_quality.bleu == 0.0 and doc.model_quality.avg_response_length == 2.0
    assert "bleu" not in A.model_quality(ppo).columns
    long = ppo.selectExpr("prompt_id", "response || ' one two three four' as response", "reward")
    assert A.model_quality(long, long.selectExpr("prompt_id", "response as reference"), ["bleu"]).first().bleu == pytest.approx(100.0)
    assert doc.preference_alignment.preference_accuracy == 1.0
    assert doc.sample_generations.prompts == [f"p{i}" for i in range(5)]


def test_histogram(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 1.0, 1.0, 4.0, NAN, None, float("inf")]], "x double")
    assert sorted(tuple(r) for r in histogram(df, "x", 4).collect()) == [(1, 0.0, 1), (2, 1.0, 2), (4, 3.0, 1)]
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [tuple(r) for r in histogram(same, "x", 4).collect()] == [(1, 2.0, 2)]
    assert histogram(same.limit(0), "x", 4).count() == 0


def test_yield(spark):
    df = spark.createDataFrame([(True,), (False,), (True,)], "kept boolean")
    assert tuple(R.ranking_yield(df).first()) == (3, 2)
    assert math.isclose(A.win_rate(spark.createDataFrame([(2.0, 1.0), (1.0, 1.0)], "a double, b double"), "a", "b").first()[0], 0.5)
