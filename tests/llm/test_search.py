"""Lexical search against all pairs scored one by one."""

import collections
import math
import re

import numpy as np
from pyspark.sql import functions as F

from llm.brute import folded, odd_documents
from prefloom.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k=10):
    texts = [(key, collections.Counter(TERM.findall(folded(t)))) for key, t in docs]
    texts = [(key, c) for key, c in texts if c]
    n, total = len(texts), sum(sum(c.values()) for _, c in texts)
    df = collections.Counter(t for _, c in texts for t in c)
    out = collections.Counter()
    for item, text in set(items):
        found = []
        for key, c in texts:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(TERM.findall(folded(text))) if t in c)
            if score > 0:
                found.append((-score, key is not None, key, score))
        out.update((item, i + 1, key, score) for i, (_, _, key, score) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k]))
    return out


def test_search_equals_scoring_all_pairs(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(i, t) for i, (_, t) in enumerate(rows[::2])] + [(3, rows[6][1]), (3, rows[6][1]), (None, "Alpha beta1"), (90, None), (91, " . "), (92, "nowhere at all"), (93, "THE the x")]
    asked = spark.createDataFrame([(*x, 1, "q") for x in items], "item_id long, text string, rank int, doc string")
    want = ranked(rows, items)
    got = lexical_search.search_items(docs, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter(map(tuple, got.collect())) == want and sum(want.values()) > 200
    small = lexical_search.search_items(docs, asked, block_terms=40)  # many blocks of items
    assert collections.Counter(map(tuple, small.collect())) == want
    assert lexical_search.search_items(docs.limit(0), asked).collect() == []
    assert lexical_search.search_items(docs, asked.limit(0)).collect() == []


def test_long_texts_copies_and_small_trees(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "TREE_ENTRIES", 300)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(words, n, p=np.arange(60, 0, -1) / 1830))
    rows = [(int(k), text(int(rng.integers(1, 80)))) for k in rng.permutation(400)] + [(1000 + k, "w1 w2 w59") for k in range(300)] + [(2000, text(200_000) + " rare")]
    items = [(i, text(30)) for i in range(12)] + [(50, "rare w59"), (51, "w1 w2 w59")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lexical_search.search_items(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert collections.Counter(map(tuple, got.collect())) == ranked(rows, items)


def test_the_tree_leaves_most_documents_unvisited():
    rng = np.random.default_rng(5)
    lists = [np.unique(np.concatenate([rng.integers(0, 20, 6), rng.integers(20, 2000, 8)])) for _ in range(3000)]
    bounds = np.cumsum([0] + [len(x) for x in lists])
    tree = lexical_search.DocumentTree(bounds, np.concatenate(lists), np.ones(bounds[-1], np.int64), np.full(3000, 100), np.arange(3000))
    weights = np.concatenate([np.full(20, 900), np.full(1980, 7000)])
    terms = np.sort(lists[17])
    walk = lexical_search._Walk(tree, terms, np.array([0]), weights, np.ones(1, np.int64), 10)
    scores = np.array([sum(weights[t] * (10**9 // 1800) for t in np.intersect1d(x, terms)) for x in lists])
    best = np.lexsort((np.arange(3000), -scores))[:10]
    assert walk.docs[0].tolist() == best.tolist() and walk.scores[0].tolist() == scores[best].tolist()
    leaves = sum(not c for c in tree.children)
    assert walk.visited < 0.5 * len(tree.ranges) and leaves > 100
