import collections

import pytest
from pyspark.sql import functions as F

from llm.brute import odd_documents
from prefloom.llm import mixing


def rows_of(spark, sizes):
    rows, key = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((key, source))
            key += 1
    return spark.createDataFrame(rows, "doc_id long, source string")


def test_less_than_one_block_from_the_weights(spark):
    df = rows_of(spark, {"a": 700, "b": 200, "c": 90, None: 40, "e": 5})
    got = mixing.mix_sources(df, block=2, frame=50).collect()
    assert len(got) == df.count() and len({r.doc_id for r in got}) == len(got)
    shares = {r.source: r.share for r in got}
    assert sum(shares.values()) == 50
    owner = {}
    for r in got:
        assert r.release <= r.slot < r.deadline and owner.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    blocks = collections.defaultdict(set)
    for slot, (source, block) in owner.items():
        blocks[source].add((slot, block))
    for source, own in blocks.items():
        slots = sorted(s for s, _ in own)
        assert [b for _, b in sorted(own)] == list(range(len(own)))
        for k, slot in enumerate(slots):
            for t, done in ((slot, k), (slot + 1, k + 1)):
                assert abs(done - t * shares[source] / 50) < 1


def test_rows_keep_their_columns(spark):
    docs = odd_documents(spark)
    mixed = mixing.mixed_rows(docs, block=1, frame=20)
    assert mixed.schema == docs.schema
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, docs.collect()))
    assert mixing.mix_sources(docs.limit(0)).collect() == mixing.mixed_rows(docs.limit(0)).collect() == []


def check_schedule(got, frame):
    """Every slot has one block inside its window, and no source is a block or more from its share."""
    owner = {}
    for r in got:
        assert r.release <= r.slot < r.deadline and owner.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
        assert (r.release, r.deadline) == (r.block * frame // r.share, -(-(r.block + 1) * frame // r.share))
    return {r.source: r.share for r in got}


def test_more_sources_than_slots(spark):
    df = rows_of(spark, {"hot": 400, **{f"site{i}": 1 + i % 3 for i in range(1200)}})
    got = mixing.mix_sources(df).collect()
    assert len(got) == df.count() and len({r.doc_id for r in got}) == len(got)
    frame = 3000
    shares = check_schedule(got, frame)
    total = sum((400 if s == "hot" else 1 + int(s[4:]) % 3) ** 0.5 for s in shares)
    assert len(shares) == 1201 and sum(shares.values()) == frame and abs(shares["hot"] - frame * 400 ** 0.5 / total) < 1


def test_many_small_sources_leave_the_hot_one_its_weight():
    shares, frame = mixing.weighted_shares([10_000_000 ** 0.5] + [100 ** 0.5] * 300, 1000)
    assert frame == 1000 == sum(shares) and shares[0] == 513 and min(shares) >= 1
    who, which = mixing.walk(shares, frame)
    done = [0] * 301
    for slot, (i, j) in enumerate(zip(who, which)):
        assert j == done[i] and j * frame // shares[i] <= slot < -(-(j + 1) * frame // shares[i])
        done[i] += 1
    assert done == shares
    shares, frame = mixing.weighted_shares([1e12, 1.0, 1.0], 1000)
    assert sum(shares) == frame >= mixing.MOST and shares[1:] == [1, 1]


def test_target_weights(spark):
    df = rows_of(spark, {"a": 300, "b": 300, None: 300})
    targets = spark.createDataFrame([("a", 0.7), ("b", 0.2), (None, 0.1), ("absent", 9.0)], "source string, weight double")
    got = mixing.mix_sources(df, block=1, frame=10, targets=targets).collect()
    assert len(got) == 900 and check_schedule(got, 10) == {"a": 7, "b": 2, None: 1}
    with pytest.raises(ValueError, match="positive target weight"):
        mixing.mix_sources(df, targets=targets.filter("source = 'a'"))


@pytest.mark.parametrize("keys", [lambda i: i, lambda i: None if i % 3 else i % 40])
def test_whole_rows_move_once(spark, keys):
    """In the order of the schedule, over several partitions, also where rows without a key or with equal ones lie in more than one of them."""
    rows = [(keys(i), f"t{i}", [None, "a", "a", "a", "b"][i % 5]) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mixed_rows(df)
    if keys(1) == 1:
        plan = mixed._jdf.queryExecution().executedPlan().toString()
        assert plan[:plan.index("BroadcastExchange")].count("Exchange ") == 1
    got = mixed.withColumn("part", F.spark_partition_id()).collect()
    assert len({r.part for r in got}) > 2 and [r.part for r in got] == sorted(r.part for r in got)
    want = mixing.mix_sources(df).orderBy("slot", "place").collect()
    assert [(r.source, r.doc_id) for r in got] == [(r.source, r.doc_id) for r in want]
    assert sorted(r.text for r in got) == sorted(r[1] for r in rows)
