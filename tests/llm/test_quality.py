"""The rule ensemble: rules against a plain reading of the trees, the score against plain arithmetic, and held-out accuracy."""

import math
import random
import zlib

from pyspark.sql import functions as F

from prefloom.llm import quality_rules as Q


def corpus(spark, n=1500, seed=4):
    rnd = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "of", "the", "delta", "and", "über"]
    rows = []
    for i in range(n):
        own = [rnd.choice(words) + rnd.choice(["", "s", "ing", "ed"]) for _ in range(rnd.randint(20, 120))]
        good = i % 4 != 0
        text = " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(own)) + "."
        if not good:
            text = [text.upper().replace(" ", "!! "), " ".join([own[0]] * len(own)), text.replace(" ", "%%% "), " | ".join(own)][i // 4 % 4]
        rows.append((i, text, int(good)))
    return rows


def plain_statistics(text):
    import regex

    words, lines = [w for w in regex.split(r"[ \t-\r]+", text) if w], [w for w in regex.split(r"[\n\r]+", text) if w]
    share = lambda p: (len(text) - len(regex.sub(p, "", text))) / max(len(text), 1)
    return {
        "log_chars": math.log1p(len(text)), "log_words": math.log1p(len(words)), "word_length": len(text) / max(len(words), 1),
        "line_length": len(text) / max(len(lines), 1), "distinct_words": len(set(words)) / max(len(words), 1),
        "distinct_lines": len(set(lines)) / max(len(lines), 1), "upper": share(r"\p{Lu}+"), "digits": share(r"\p{N}+"), "stops": share(r"[.,;:]+"),
        "cries": share(r"[!?]+"), "symbols": share(r"(?:(?![.,;:!?'\"()-])[\p{P}\p{S}])+"),
        "stopped_lines": sum(x[-1] in ".!?" for x in lines) / max(len(lines), 1)}


def plain_score(text, model):
    s = plain_statistics(text or "")
    held = [w for rule, w in model.rules if all((a is None or s[n] > a) and (b is None or s[n] <= b) for n, a, b in rule)]
    return 1 / (1 + math.exp(-(model.bias + sum(held)))), len(held)


def test_scores_and_held_out_accuracy(spark):
    rows = corpus(spark)
    odd = [(9000, None), (9001, ""), (9001, ""), (None, "no key here"), (9002, "x " * 100_000), (9003, "a\tb\r\n\nc. d!\n" * 50), (9004, "ÀÉ ß ½ ٣ — € \U0001F600 \U00010400 «x»\u2028y\x1cz.")]
    docs = spark.createDataFrame([(*r[:2], 3, "c", 0.5) for r in rows] + [(*x, None, None, None) for x in odd], "doc_id long, text string, good int, upper string, score double")
    labels = spark.createDataFrame([(k, g) for k, _, g in rows] + [(7, None), (None, 1), (77777, 0), (4, 0), (1, 9)], "doc_id long, quality int")
    model = Q.fit_quality(docs, labels)
    assert 0 < len(model.rules) < 200 and all(1 <= len(rule) <= Q.DEPTH for rule, _ in model.rules)
    got = Q.score_quality(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    text = {k: t for k, t, _ in rows} | dict(odd)
    for r in got:
        score, held = plain_score(text[r.doc_id], model)
        assert math.isclose(r.score, score, rel_tol=1e-9) and r.rules == held and 0 <= r.score <= 1
    fresh = [(r.score, g) for r in got for k, _, g in rows if r.doc_id == k and zlib.crc32(str(k).encode()) % 4 == 2]
    assert len(fresh) > 250 and sum((s >= 0.7) == (g == 1) for s, g in fresh) >= 0.97 * len(fresh)
    assert Q.score_quality(docs.limit(0), model).collect() == []
    flipped = labels.withColumn("quality", F.when(F.expr("crc32(cast(doc_id as string)) % 4 = 2"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert Q.fit_quality(docs, flipped) == model  # held-out labels are never read


def test_few_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.score_quality(docs, Q.fit_quality(docs, none)).collect()} == {0.5}
    assert Q.fit_quality(docs.limit(0), none).rules == ()
    one = spark.createDataFrame([(k, 1) for k in range(10)], "doc_id long, quality int")
    scores = {r.score for r in Q.score_quality(docs, Q.fit_quality(docs, one)).collect()}
    assert len(scores) == 1 and min(scores) > 0.5


def test_rules_are_the_paths_of_the_trees(spark):
    class Split:
        def __init__(self, f, t):
            self.featureIndex, self.threshold = lambda: f, lambda: t

    class Node:
        def __init__(self, split=None, left=None, right=None):
            self.split, self.leftChild, self.rightChild = lambda: split, lambda: left, lambda: right
            self.numDescendants = lambda: 0 if split is None else 2

    tree = Node(Split(0, 5.0), Node(Split(0, 2.0), Node(), Node()), Node(Split(1, 1.0), Node(), Node()))
    found = Q._paths(tree, ["a", "b"], {})
    assert sorted(map(str, found)) == sorted(map(str, [
        (("a", None, 5.0),), (("a", None, 2.0),), (("a", 2.0, 5.0),), (("a", 5.0, None),), (("a", 5.0, None), ("b", None, 1.0)), (("a", 5.0, None), ("b", 1.0, None))]))


def test_the_lasso_is_optimal(spark):
    import numpy as np

    rng = np.random.default_rng(6)
    x = np.column_stack([np.ones(600), (rng.random((600, 12)) < 0.4).astype(float)])
    x[:, 12] = x[:, 11]  # a rule that holds where another does
    d = x * np.where(rng.random(600) < 1 / (1 + np.exp(-(x[:, 1] * 2 - x[:, 2] - 0.3))), 1, -1)[:, None]
    rows = spark.createDataFrame([(r.tolist(),) for r in d], "d array<double>").repartition(3)
    w = Q.fit_lasso(rows, "d", 13, 0.02, 3)
    cost = lambda w: np.logaddexp(0, -(d @ w)).mean() + 0.02 * np.abs(w[1:]).sum()
    assert (w[3:] == 0).sum() >= 6 and w[1] > 0.5 and w[2] < 0
    for j in range(13):
        assert all(cost(w) <= cost(w + s * np.eye(13)[j]) + 1e-7 for s in (-0.01, 0.01))
