import random
from collections import Counter

from pyspark.sql import functions as F

from prefloom.functions import tokens as K
from prefloom.operators import tokens as T, validation as V


def test_vocabulary_and_both_encoding_routes(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(60, None)], "id int, t string").repartition(4)
    words = T.build_vocabulary(df, "t", 5)
    counts = Counter(" ".join(texts).split())
    top = sorted(counts, key=lambda w: (-counts[w], w))[:5]
    ids = {w: i + 2 for i, w in enumerate(top)}
    assert {r.token: r.token_id for r in words.collect()} == ids
    want = {i: [ids.get(w, 1) for w in t.split()] for i, t in enumerate(texts)} | {60: None}
    for route in ("look_up", "join"):
        got = T.encode(df, {"t": "ids"}, words, "id", route=route)
        assert {r.id: r.ids for r in got.collect()} == want
        assert got.schema["ids"].dataType.simpleString() == "array<int>"


def test_the_join_moves_no_places(spark):
    """Repeated and null keys, rows without words or text; no list of places is shuffled."""
    rows = [(1, "a b a x"), (1, "b"), (2, "x y"), (3, ""), (4, None), (5, None), (5, "a a"), (None, "a b"), (6, "b b b")]
    df = spark.createDataFrame(rows, "id int, t string")
    words = spark.createDataFrame([("a", 2), ("b", 3)], "token string, token_id int")
    got = T.encode(df, {"t": "ids"}, words, "id", route="join")
    assert got.columns == ["id", "t", "ids"]
    assert sorted(((r.id, r.t, r.ids) for r in got.collect()), key=str) == sorted([
        (1, "a b a x", [2, 3, 3, 2, 1]), (1, "b", [2, 3, 3, 2, 1]), (2, "x y", [1, 1]), (3, "", []), (4, None, None),
        (5, None, [2, 2]), (5, "a a", [2, 2]), (None, "a b", []), (6, "b b b", [3, 3, 3])], key=str)
    assert "posexplode" not in got._jdf.queryExecution().executedPlan().toString()


def test_tokens_with_equal_hashes_and_an_empty_vocabulary(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(T, "_hashes", lambda tokens: np.array([len(t) for t in tokens.to_pylist()], np.uint64))
    table = T.TokenTable(pa.table({"token": ["aa", "b", "cc", "dd", "eee"], "token_id": pa.array([2, 3, 4, 5, 6], pa.int32())}))
    assert table.ids_of(pa.array(["dd", "aa", "xx", "b", "eee", "ffff", "cc"]), 1).tolist() == [5, 2, 1, 3, 6, 1, 4]
    assert T.TokenTable(pa.table({"token": pa.array([], pa.string()), "token_id": pa.array([], pa.int32())})).ids_of(pa.array(["a"]), 1).tolist() == [1]


def test_a_vocabulary_of_five_million_tokens(spark):
    n = 5_000_000
    texts = spark.range(0, n // 100, 1, 16).select(F.array_join(F.transform(
        F.sequence(F.col("id") * 100, F.col("id") * 100 + 99), lambda i: F.concat(F.lit("t"), i.cast("string"))), " ").alias("t"), "id")
    words = T.build_vocabulary(texts, "t", n)
    got = words.agg(F.count("*"), F.count_distinct("token_id"), F.min("token_id"), F.max("token_id")).first()
    assert tuple(got) == (n, n, 2, n + 1)
    few = spark.createDataFrame([(0, "t0 t1 t4999999 nowhere t77"), (1, None)], "id int, t string")
    want = {r.token: r.token_id for r in words.where(F.col("token").isin("t0", "t1", "t4999999", "t77")).collect()}
    assert want["t0"] == 2 and want["t1"] == 3  # equally frequent tokens by name
    for route in ("look_up", "join"):
        ids = {r.id: r.ids for r in T.encode(few, {"t": "ids"}, words, "id", route=route).collect()}
        assert ids == {0: [2, 3, want["t4999999"], 1, want["t77"]], 1: None}


def test_padding_and_masks(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, [4]), (3, [])], "id int, ids array<int>")
    got = {r.id: (r.ids, r.mask) for r in T.pad_fixed(df, "ids", "mask", 2, pad_id=9).collect()}
    assert got == {1: ([1, 2], [1, 1]), 2: ([4, 9], [1, 0]), 3: ([9, 9], [0, 0])}
    batched = df.withColumns({"b": F.lit(0), "other": F.slice("ids", 1, 1)})
    rows = T.pad_to_longest(batched, {"ids": "mask", "other": "omask"}, batch="b").collect()
    got = {r.id: (r.ids, r.mask, r.other, r.omask) for r in rows}
    assert got == {
        1: ([1, 2, 3], [1, 1, 1], [1], [1]), 2: ([4, 0, 0], [1, 0, 0], [4], [1]), 3: ([0, 0, 0], [0, 0, 0], [0], [0])}
    assert [r.n for r in df.select(K.masked_length(K.mask_from_pad(F.col("ids"), 2)).alias("n")).collect()] == [2, 1, 0]


def test_response_slice(spark):
    rows = [(1, [1, 2, 3, 7, 8, 0, 9], 3), (2, [1, 2, 3], 1), (3, [1, 0, 3], 1), (4, [1, 2], 2), (5, [1, 2], 9)]
    df = spark.createDataFrame(rows, "id int, ids array<int>, n int")
    got = {r.id: r.o for r in df.select("id", K.response_ids(F.col("ids"), F.col("n"), 0).alias("o")).collect()}
    assert got == {1: [7, 8], 2: [2, 3], 3: None, 4: None, 5: None}


def test_collate_and_labels(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2).repartition(3)
    rows = T.collate(df, ["id"], 4, ["id", "x"]).orderBy("batch_id").collect()
    assert [r.id for r in rows] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
    assert [r.x for r in rows] == [[0, 2, 4, 6], [8, 10, 12, 14], [16, 18]]
    labelled = spark.createDataFrame([(1, [5, -100, 6])], "id int, input_ids array<int>")
    got = T.scored_positions(T.causal_labels(labelled), "id").collect()
    assert [(r.pos, r.label) for r in got] == [(0, 5), (2, 6)]


def rules(df):
    return {r.rule: r.violations for r in df.collect() if r.violations}


def test_batch_validation(spark):
    schema = ", ".join(["batch_id long"] + [f"{s}_{k} array<int>" for s in ("chosen", "rejected") for k in ("input_ids", "attention_mask")])
    good = (1, [1, 2, 3], [1, 1, 1], [4, 5, 6], [1, 1, 1])
    assert rules(V.validate_batches(spark.createDataFrame([good], schema))) == {}
    bad = [good, (1, [1], [1, 1], None, [1])]
    assert rules(V.validate_batches(spark.createDataFrame(bad, schema))) == {
        "rejected_input_ids_null": 1, "chosen_input_ids_and_mask_differ": 1, "chosen_input_ids_ragged_batches": 1,
        "side_sizes_differ": 1}
    absent = spark.createDataFrame([good], schema).drop("chosen_input_ids")
    assert rules(V.validate_batches(absent)) == {"chosen_input_ids_missing_field": 1}


def test_pair_validation_and_info(spark):
    df = spark.createDataFrame([("a", " "), (None, "b"), ("c", "d")], "chosen_text string, rejected_text string")
    assert rules(V.validate_pairs(df)) == {"chosen_text_null": 1, "rejected_text_blank": 1}
    assert rules(V.validate_pairs(df.limit(0))) == {"dataset_empty": 1}
    assert rules(V.validate_pairs(df.select("chosen_text", F.lit(1).alias("rejected_text")))) == {
        "chosen_text_null": 1, "rejected_text_not_text": 3}
    assert rules(V.validate_pairs(df.drop("rejected_text")))["rejected_text_missing_field"] == 3
    info = V.dataset_info(df).collect()
    assert [(r.rows, r.field, r.type) for r in info] == [(3, "chosen_text", "string"), (3, "rejected_text", "string")]


def test_finite_check(spark):
    df = spark.createDataFrame([([1.0, float("nan")],), ([float("-inf"), None],)], "v array<double>")
    assert tuple(V.finite_check(df, "v").first()) == (3, 1, 1)
