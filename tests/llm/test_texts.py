"""Joins and models over whole texts."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm.brute import WORD, components, folded, odd_documents, repeats, shingles
from prefloom.llm import jaccard, katz, substrings, toxicity
from prefloom.llm.words import word_slices


def test_words():
    texts = ["  Ab\tc", None, "", "é x y", "z"]
    words = list(word_slices(pa.array(texts), limit=3))
    assert sum(len(w) for w in words) == 5
    got = [bytes(w.raw[a:b]).decode() for w in words for a, b in zip(w.starts, w.ends)]
    assert got == ["Ab", "c", "é x", "y", "z"]
    same = next(word_slices(pa.array(["ab AB ba", "ab"]))).hashes(True)
    assert same[0] == same[1] == same[3] != same[2]


def test_jaccard_join(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = [(k, shingles(t)) for k, t in rows if k is not None]
    links = [(a, b) for a, x in sets for b, y in sets if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    root = components({k for k, _ in sets}, links)
    want = collections.Counter((k, len(shingles(t)), root.get(k)) for k, t in rows)
    got = collections.Counter(map(tuple, jaccard.jaccard_join(docs).collect()))
    assert got == want and len(set(root.values())) < len(root) - 10
    assert jaccard.jaccard_join(docs.limit(0)).collect() == []


def test_jaccard_moves_no_sets_of_unlike_texts(spark, monkeypatch):
    # long texts in reach of each other by 512 counts: one half shares a sentence, the other a tenth of its words
    common = [f"c{i}" for i in range(800)]
    rows = [(k, " ".join((common[:9] if k < 12 else common) + [f"w{k}x{i}" for i in range(8000 - (9 if k < 12 else 800))])) for k in range(24)]
    rows += [(50, rows[3][1] + " and more"), (51, rows[20][1] + " and more")]
    sizes, write = {}, jaccard.written

    def counted(df, name):
        out = write(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k for k in range(24)} | {50: 3, 51: 20}
    # of the first half two are left, and the last pass gets nothing
    assert sizes["chosen"] == 3 + 12 and sizes["promising"] == 0


def test_tree_join_loses_no_pair():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 6, (40, jaccard.GROUPS))
    points = np.concatenate([base, np.maximum(base + rnd.integers(-1, 2, base.shape) * (rnd.random(base.shape) < 0.1), 0), base[:5] * 3]).astype(np.uint8)
    sizes, more = points.sum(1, dtype=np.int64), np.zeros(len(points), np.int64)
    tree = jaccard._Tree(points, more, sizes)
    x, y = jaccard.tree_pairs(tree, tree, 75)
    bound = np.minimum(points[:, None].astype(int), points[None].astype(int)).sum(2)
    want = np.argwhere(bound >= jaccard._needed(sizes[:, None], sizes[None], 75))
    assert sorted(zip(x.tolist(), y.tolist())) == sorted(map(tuple, want.tolist())) and len(want) > len(points)


def test_repeats(spark):
    docs = odd_documents(spark)
    got = substrings.remove_repeats(docs).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == repeats([(r.doc_id, r.text) for r in docs.collect()])
    assert all(sum(s.end - s.start for s in r.repeats) == r.n_removed for r in got) and sum(r.n_removed for r in got) > 500
    assert substrings.remove_repeats(docs.limit(0)).collect() == []


def test_repeats_with_two_texts_under_one_key(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a), (2, "short " + b), (2, a), (3, a + " more of it"), (3, "only a few words"), (4, b), (4, a), (4, a), (5, "x " + b[:200]), (5, None), (6, "short " + b), (6, "own " * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(docs).collect())
    assert got == repeats(rows) and sum(n * r[2] for r, n in got.items()) > 300


def test_katz_scores(spark):
    docs = odd_documents(spark).where("doc_id is not null")
    rows = [(r.doc_id, WORD.findall(folded(r.text)) + ["</s>"]) for r in docs.collect()]
    trained = lambda k: zlib.crc32(str(k).encode()) % 5 != 1
    words, pairs, after = collections.Counter(), collections.Counter(), collections.Counter()
    for k, t in rows:
        if trained(k):
            words.update(t)
            for a, b in zip(["<s>", *t], t):
                pairs[a, b] += 1
                after[a] += 1
    n, v = sum(words.values()), len(words)
    single, double = (np.append(katz.discounts(collections.Counter(c.values())), 1.0) for c in (words, pairs))
    chance = lambda w: single[min(words[w], 6)] * words[w] / (n + 1)
    rest = 1 - sum(map(chance, words))
    size = {h: c + (c > 5) for h, c in after.items()}

    def backoff(h):
        own = [w for a, w in pairs if a == h]
        return (1 - sum(double[min(pairs[h, w], 6)] * pairs[h, w] / size[h] for w in own)) / (1 - sum(map(chance, own)))

    def log(h, w):
        if pairs[h, w]:
            return math.log10(double[min(pairs[h, w], 6)] * pairs[h, w] / size[h])
        return math.log10((chance(w) if words[w] else rest) * (backoff(h) if h in after else 1))

    for h in list(after)[:20]:
        total = sum(10 ** log(h, w) for w in words) + rest * backoff(h)
        assert abs(total - 1) < 1e-9
    got = katz.score_texts(docs, F.expr("crc32(cast(doc_id as string)) % 5 <> 1")).collect()
    by_key = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for k, t in rows:
        r = by_key[k]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.train) == (len(t), sum(w in words for w in t), n, trained(k))
        assert math.isclose(r.base_score, sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), rel_tol=1e-9)
        assert math.isclose(r.score, sum(log(h, w) for h, w in zip(["<s>", *t], t)), rel_tol=1e-9)
    assert katz.score_texts(docs.limit(0), F.lit(True)).collect() == []
    assert katz.score_texts(docs, F.lit(False)).where("n_known > 0").count() == 0


def test_toxicity(spark):
    clean = ["the cat sat. It was calm!\nAll is well", "a day. nothing happened here. more text"]
    rows = [(i, (clean[i % 2] + f" w{i % 9}. ") * 4 + ("You stupid fool. " if i % 5 == 0 else "") + clean[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows + [(1000, None), (1001, ""), (1001, ""), (None, "you STUPID thing")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(5, None), (None, 1), (7777, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels, passes=40)
    scored = toxicity.score_toxicity(docs, model).collect()
    assert len(scored) == docs.count()
    text = dict(rows)
    for r in scored:
        assert 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 400:
            assert (r.score >= 0.5) == (r.doc_id % 5 == 0)
            assert [text[r.doc_id][s.start:s.end] for s in r.sentences] == (["You stupid fool"] if r.doc_id % 5 == 0 else [])
    kept = toxicity.without_toxic(docs, model)
    assert kept.schema == docs.schema and kept.where("text is null or text = ''").count() == 3
    nothing = toxicity.fit_toxicity(docs, labels.limit(0))
    assert toxicity.score_toxicity(docs, nothing).selectExpr("count(distinct round(score, 9))").first()[0] == 1
    assert toxicity.score_toxicity(docs.limit(0), model).collect() == []


def test_toxic_words_in_unseen_forms(spark):
    # every form is rare, and those of the held-out fold occur nowhere else
    plain = [f"word{k * 7 % 31} then some{k % 13} more" for k in range(400)]
    rows = [(i, f"{t}. a {'scorn' if i % 4 == 0 else 'grain'}{i}x thing, and {t}") for i, t in enumerate(plain)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert {i for i, s in scores.items() if s >= 0.5} == set(range(0, 400, 4))
