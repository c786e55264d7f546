import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from prefloom.functions.stemming import stem
from prefloom.operators import text_metrics as M


def table(spark, rows):
    return spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(rows)], "item_id long, prediction string, reference string")


def test_bleu_tokens(spark):
    text = "It's 3.5-4, \"ok\" (yes)&amp;no -\nx.\n"
    row = spark.createDataFrame([(text,)], "t string").select(M.bleu_tokens("t")).first()
    assert row[0] == ["It's", "3.5", "-", "4", ",", '"', "ok", '"', "(", "yes", ")", "&", "no", "x", "."]


def test_bleu_hand_worked(spark):
    # 7 of 8, 5 of 7, 3 of 6, 1 of 5; the prediction is shorter by one token.
    rows = [("the cat sat on the mat very b", "the cat sat on a mat very very b")]
    counts = {r.n: (r.matched, r.total, r.total_ref) for r in M.bleu_counts(table(spark, rows)).collect()}
    assert counts == {1: (7, 8, 9), 2: (5, 7, 8), 3: (2, 6, 7), 4: (1, 5, 6)}
    want = 100 * math.exp(1 - 9 / 8) * (7 / 8 * 5 / 7 * 2 / 6 * 1 / 5) ** 0.25
    assert M.corpus_bleu(table(spark, rows)).first()[0] == pytest.approx(want)


def test_bleu_smoothing_and_edges(spark):
    rows = [("a b c d", "a x c y")]
    want = 100 * (2 / 4 * (1 / 2) / 3 * (1 / 4) / 2 * (1 / 8) / 1) ** 0.25
    assert M.corpus_bleu(table(spark, rows)).first()[0] == pytest.approx(want)
    assert M.corpus_bleu(table(spark, [("a b c d", "w x y z")])).first()[0] == 0.0
    assert M.corpus_bleu(table(spark, [("a b", "a b")])).first()[0] == 0.0
    assert M.corpus_bleu(table(spark, [("", "a b c d")])).first()[0] == 0.0
    assert M.corpus_bleu(table(spark, [])).first()[0] == 0.0
    assert M.corpus_bleu(table(spark, [("a b c d e", "a b c d e")])).first()[0] == pytest.approx(100.0)


def longest_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_length_agrees_with_the_table_method():
    rng = random.Random(11)
    for _ in range(200):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 70))] for _ in range(2))
        assert M.common_length(a, b) == longest_common(a, b)


def test_long_texts_are_taken_in_blocks(monkeypatch):
    rng = random.Random(12)
    for _ in range(200):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 70))] for _ in range(2))
        assert {M.common_length(a, b, block=k) for k in (1, 7, 64, 100)} == {longest_common(a, b)}
    import tracemalloc

    tracemalloc.start()
    assert M.common_length(list(range(30_000)), list(range(0, 30_000, 100))) == 300
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20  # one bit row per token of the whole text takes 60 MB


def test_numbers_are_made_in_runs(monkeypatch):
    """A batch of any size is numbered some rows at a time, with nulls, empty lists and a row longer than a run."""
    import pyarrow as pa

    monkeypatch.setattr(M, "RUN_TOKENS", 6)
    left, right = [["x", "y"], None, [], ["a."] * 9, ["q"]], [["y", "x"], ["z"], [], ["a", "."], None]
    p, r = (pa.array(x, pa.list_(pa.string())) for x in (left, right))
    assert len(list(M._runs(p, r))) == 3
    sizes = [(len(a), len(b)) for a, b in M._coded(p, r)]
    assert sizes == [(2, 2), (0, 1), (0, 0), (9, 2), (1, 0)]
    split = list(M._coded(p, r, parts=M.bleu_parts))
    assert [(len(a), len(b)) for a, b in split] == [(2, 2), (0, 1), (0, 0), (18, 2), (1, 0)]
    assert split[3][0].tolist() == split[3][1].tolist() * 9
    one = [(a.tolist(), b.tolist()) for a, b in M._coded(p.slice(0, 1), r.slice(0, 1), name=lambda t: "same")]
    assert one == [([0, 0], [0, 0])]


def test_tokens_of_words_are_the_tokens_of_the_text(spark):
    import pyarrow as pa

    rng = random.Random(13)
    signs = [*".,.,--<>&/(){}[]'\"~!:;@`^_ab19é\u4e00", " ", " ", "\n", "\t", "\u00a0", "&quot;", "<skipped>", "-\n"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", M.bleu_tokens("t").alias("whole"), M.bleu_words("t").alias("words")).collect()
    for r in rows:
        tokens, starts, widths = M.bleu_parts(pa.array(r.words, pa.string()))
        assert [t.as_py() for s, n in zip(starts, widths) for t in tokens[s:s + n]] == r.whole, r.t


def test_shared_grams_of_many_different_tokens():
    rng = np.random.default_rng(14)
    for n in (0, 3, 50, 60_000):
        a, b = np.arange(n), np.concatenate([np.arange(n)[n // 2:], rng.integers(0, max(n, 1), n // 3) + 10**9])
        want = [max(n - n // 2 - k, 0) for k in range(4)]
        assert M.shared_grams(a, b) == want


def test_rouge_l(spark):
    rows = [("The cats were running!", "the cat was run"), ("", "x"), ("a b c", "c b a")]
    got = {r.item_id: r.rouge_l for r in M.rouge_l_scores(table(spark, rows)).collect()}
    assert got == pytest.approx({0: 0.75, 1: 0.0, 2: 1 / 3})
    plain = {r.item_id: r.rouge_l for r in M.rouge_l_scores(table(spark, rows), stemming=False).collect()}
    assert plain[0] == pytest.approx(0.25)
    assert M.rouge_l(table(spark, rows)).first()[0] == pytest.approx((0.75 + 1 / 3) / 3)
    assert M.rouge_l(table(spark, [])).first()[0] == 0.0


@pytest.mark.parametrize("word, root", [
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"),
    ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"),
    ("sized", "size"), ("hopping", "hop"), ("falling", "fall"), ("hissing", "hiss"), ("failing", "fail"), ("filing", "file"),
    ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("conditional", "condit"), ("digitizer", "digit"),
    ("radically", "radic"), ("vietnamization", "vietnam"), ("hopefulness", "hope"), ("sensibility", "sensibl"),
    ("triplicate", "triplic"), ("formative", "form"), ("electrical", "electr"), ("goodness", "good"), ("revival", "reviv"),
    ("adjustment", "adjust"), ("adoption", "adopt"), ("probate", "probat"), ("cease", "ceas"), ("controll", "control"),
    ("roll", "roll"), ("dying", "die"), ("geology", "geolog"), ("enjoy", "enjoy"), ("spied", "spi"), ("died", "die"),
    ("generously", "gener"), ("by", "by"), ("says", "say"),
])
def test_stems(word, root):
    assert stem(word) == root


def vectors(rng, sizes, dim=4):
    return {item: rng.normal(size=(n, dim)) for item, n in sizes.items()}


@pytest.mark.parametrize("block, cell", [(512, 4), (8, 2), (8, 1)])
def test_embedding_match_with_one_long_item(spark, block, cell):
    rng = np.random.default_rng(12)
    pred, ref = vectors(rng, {0: 70, 1: 3, 2: 9}), vectors(rng, {0: 45, 1: 5, 2: 1, 3: 2})
    frames = [spark.createDataFrame([(i, p, list(map(float, v))) for i, m in side.items() for p, v in enumerate(m)],
                                    "item_id long, pos long, vec array<double>").repartition(3) for side in (pred, ref)]
    rows = M.embedding_match_scores(*frames, block=block, cell=cell).collect()
    assert {r.item_id for r in rows} == {0, 1, 2}
    for r in rows:
        a, b = (m[r.item_id] / np.linalg.norm(m[r.item_id], axis=1, keepdims=True) for m in (pred, ref))
        sims = a @ b.T
        p, q = sims.max(axis=1).mean(), sims.max(axis=0).mean()
        assert (r.precision, r.recall, r.f1) == pytest.approx((p, q, 2 * p * q / (p + q)))


def test_selection_and_perplexity(spark):
    df = table(spark, [("a b c d e", "a b c d e")])
    vecs = spark.createDataFrame([(0, 0, [1.0, 0.0])], "item_id long, pos long, vec array<double>")
    got = {r.metric: r.value for r in M.compute_all(df, token_vectors=(vecs, vecs)).collect()}
    assert got == pytest.approx({"bleu": 100.0, "rouge": 1.0, "bertscore": 1.0})
    with pytest.raises(ValueError):
        M.compute_all(df, ["meteor"])
    with pytest.raises(ValueError):
        M.compute_all(df, ["bertscore"])
    flat = spark.createDataFrame([([0.0] * 4, 1), ([0.0] * 4, 3), ([9.0, 0.0, 0.0, 0.0], -100)], "logits array<double>, label int")
    assert tuple(M.perplexity(flat).first()) == pytest.approx((4.0, math.log(4)))
    joined = M.pair_by_item(df.select("item_id", F.col("prediction").alias("text")), df.select("item_id", F.col("reference").alias("text")))
    assert joined.columns == ["item_id", "prediction", "reference"]


def test_a_long_item_spreads_over_its_own_grid(spark):
    rng = np.random.default_rng(7)
    side = lambda: spark.createDataFrame([(0, p, rng.normal(size=2).tolist()) for p in range(400)], "item_id long, pos long, vec array<double>")
    p, r = side(), side()
    blocks, last = M._blocks(p, ["item_id"], 4), p.groupBy("item_id").agg(F.max(F.floor(F.col("pos") / 4)).alias("last"))
    assert blocks.count() == 100 and last.first()["last"] == 99
    plan = M.embedding_match_scores(p, r, block=4, cell=4)._jdf.queryExecution().executedPlan().toString()
    assert "row" in plan and "col" in plan  # joined by item, row and column: 25 x 25 cells
    got = M.embedding_match_scores(p, r, block=4, cell=4).first()
    a, b = (np.array([x.vec for x in f.orderBy("pos").collect()]) for f in (p, r))
    sims = (a / np.linalg.norm(a, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
    assert (got.precision, got.recall) == pytest.approx((sims.max(1).mean(), sims.max(0).mean()))


def test_many_models_in_one_scan(spark):
    rows = [("m1", 0, "a b c d e", "a b c d e", 1.0), ("m1", 1, "x y", "a b c d e", 2.0), ("m1", 2, "z z", None, 6.0), ("m2", 0, "a b c d f", "a b c d e", 0.0),
            ("m3", 9, None, "a b", 0.0)]
    df = spark.createDataFrame(rows, "model string, item_id long, prediction string, reference string, reward double")
    vec = lambda rows: spark.createDataFrame(rows, "model string, item_id long, pos long, vec array<double>")
    p, r = vec([("m1", 0, 0, [1.0, 0.0]), ("m2", 0, 0, [0.0, 1.0]), ("m2", 0, 1, [1.0, 1.0])]), vec([("-", 0, 0, [1.0, 0.0])]).drop("model")
    got = {x.model: x for x in M.quality_by(df, ["model"], [F.avg("reward").alias("reward")], ["bleu", "rouge", "bertscore"], (p, r)).collect()}
    assert set(got) == {"m1", "m2", "m3"} and got["m1"].reward == 3.0
    for m in ("m1", "m2"):
        own = df.where((F.col("model") == m) & F.col("reference").isNotNull())
        assert got[m].bleu == pytest.approx(M.corpus_bleu(own).first()[0]) and got[m].rouge == pytest.approx(M.rouge_l(own).first()[0])
        assert got[m].bertscore == pytest.approx(M.embedding_match(p.where(F.col("model") == m).drop("model"), r).first()[0])
    assert (got["m3"].bleu, got["m3"].rouge, got["m3"].bertscore) == (0.0, 0.0, None)
    assert M.chosen_metrics(None, None) == ["bleu", "rouge"]
    with pytest.raises(ValueError):
        M.chosen_metrics(["bertscore"], None)
