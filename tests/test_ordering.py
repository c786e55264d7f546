import random

import pytest
from pyspark.sql import functions as F

from prefloom.operators import ordering as O
from prefloom.operators.rollouts import with_room_for_response


def ids(df, key="id"):
    return sorted(r[key] for r in df.select(key).collect())


@pytest.mark.parametrize("spread", [1, 70_000, 2**45])
def test_prefix_cutoff_over_wide_keys(spark, spread):
    rng = random.Random(spread)
    keys = sorted(rng.sample(range(-1000, 1000), 200))
    keys = [k * spread for k in keys]
    df = spark.createDataFrame([(k,) for k in keys], "id long").repartition(5)
    for n in (1, 57, 199, 200):
        assert O.prefix_cutoff(df, "id", n) == keys[n - 1]
        assert ids(O.ordered_head(df, "id", n)) == keys[:n]
    assert O.prefix_cutoff(df, "id", 201) is None
    assert O.ordered_head(df, "id", 500).count() == 200
    assert O.ordered_head(df, "id", 0).count() == 0


def test_prefix_cutoff_extreme_keys(spark):
    keys = [-(2**63), -1, 0, 2**63 - 1]
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    assert [O.prefix_cutoff(df, "id", n) for n in range(1, 5)] == keys


def test_head_filter_reaches_the_scan(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    plan = O.ordered_head(spark.read.parquet(str(tmp_path / "t")), "id", 10)._jdf.queryExecution().toString()
    assert "LessThanOrEqual(id,9)" in plan


def test_dense_index_and_batches(spark):
    rows = [(i % 3, i) for i in range(1000)]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, id long").repartition(7)
    got = O.assign_batches(df, ["g", "id"], 16).orderBy("idx").collect()
    assert [(r.g, r.id) for r in got] == sorted(rows)
    assert [r.idx for r in got] == list(range(1000))
    assert all(r.batch_id == r.idx // 16 for r in got)
    assert O.dense_index(df.limit(0), ["g", "id"]).count() == 0


def test_dense_index_has_no_window_over_all_rows(spark):
    df = O.dense_index(spark.range(1000), ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step works on the per-part sizes.
    assert plan.count("SinglePartition") == 1
    assert plan.index("SinglePartition") < plan.index("sum(_rows")or "HashAggregate(keys=[_part" in plan


def test_split_shuffle_steps_and_samples(spark):
    df = spark.range(103).repartition(4)
    parts = {r.id: r.part for r in O.ordered_split(df, "id").collect()}
    assert sum(p == "train" for p in parts.values()) == int(0.8 * 103)
    assert all((p == "train") == (i < 82) for i, p in parts.items())
    a = [r.id for r in O.epoch_shuffle(df, "id", 1, 0).orderBy("position").collect()]
    assert a == [r.id for r in O.epoch_shuffle(df.repartition(2), "id", 1, 0).orderBy("position").collect()]
    assert a != [r.id for r in O.epoch_shuffle(df, "id", 1, 1).orderBy("position").collect()] and sorted(a) == list(range(103))
    assert ids(O.every_kth_step(df, 50, "id")) == [0, 50, 100]
    assert [r.id for r in O.first_rows(df, "id", 3).collect()] == [0, 1, 2]
    assert [r.id for r in O.last_rows(df, "id", 3).collect()] == [100, 101, 102]


def test_rollout_cap_keeps_whole_batches(spark):
    sizes = {1: 3, 2: 0, 3: 3, 4: 3, 5: 3}
    df = spark.createDataFrame([(b, i) for b, n in sizes.items() for i in range(n)], "batch_id long, i int")
    assert sorted({r.batch_id for r in O.cap_rollouts(df, 6).collect()}) == [1, 3]
    assert sorted({r.batch_id for r in O.cap_rollouts(df, 7).collect()}) == [1, 3, 4]
    assert O.cap_rollouts(df, 100).count() == 12


def test_room_for_response(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], 1), (2, [1, 2, 3], 2)], "id int, full_ids array<int>, prompt_len int")
    assert ids(with_room_for_response(df)) == [1]
