import collections
import hashlib
import importlib

import pytest

corpus_pipeline = importlib.import_module("corpus_pipeline")

from llm.brute import odd_documents


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    docs = odd_documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    extra = spark.createDataFrame([(900, "my token=abcdef123 is here", "en", "s1", 26)], docs.schema)
    docs.unionByName(extra).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, 0), (4, 1), (7, 0)], "doc_id long, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_stages(spark, folder):
    docs = start = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.schema == start.schema
        rows = out.collect()
        docs = spark.createDataFrame(rows, start.schema)
        if name == "ngram_jaccard_join":
            keys = [r.doc_id for r in rows if r.doc_id is not None]
            assert len(keys) == len(set(keys)) and 19 in keys and 25 not in keys and 28 not in keys
        if name == "secret_scan":
            assert [(r.text, r.n_chars) for r in rows if r.doc_id == 900] == [("my <assign> is here", 19)]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.count() == docs.count() and last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 20


def test_rows_without_copies_stay_where_they_are(spark, tmp_path):
    words = lambda i: " ".join(f"w{(i * 37 + k * k * 11) % 9973}x{i}" for k in range(20))
    rows = [(i, words(i)) for i in range(60)]
    rows += [(100 + i, words(i)) for i in range(5)] + [(200, words(7) + " end"), (10, words(10)), (11, words(61)), (2, words(1)), (None, words(3)), (None, None), (300, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/d")
    got = corpus_pipeline.stages.drop_near_copies(spark, spark.read.parquet(f"{tmp_path}/d"), "")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan[:plan.index("Scan parquet")]
    # of equal rows one stays, and rows of one key with different texts both do unless one is a copy of a smaller key's
    want = collections.Counter([(i, words(i)) for i in range(60)] + [(11, words(61)), (None, words(3)), (None, None), (300, None)])
    want += collections.Counter([(2, words(1))])
    assert collections.Counter((r.doc_id, r.text) for r in got.collect()) == want


def pfair_walk(rows, block=10, frame=1000):
    """Keys of ``(key, source)`` in the order of a plain walk over the slots of one frame."""
    own = collections.defaultdict(list)
    for key, source in rows:
        own[source].append(key)
    w = {s: round(len(keys) ** 0.5, 9) for s, keys in own.items()}
    exact = {s: round((frame - len(w)) * v / sum(w.values()), 6) for s, v in w.items()}
    share = {s: int(e) + 1 for s, e in exact.items()}
    for s in sorted(share, key=lambda s: (int(exact[s]) - exact[s], s))[:frame - sum(share.values())]:
        share[s] += 1
    queue = {s: sorted(keys, key=lambda k: (hashlib.md5(str(k).encode()).hexdigest(), k)) for s, keys in own.items()}
    done, out = dict.fromkeys(share, 0), []
    for slot in range(frame):
        ready = [s for s, k in share.items() if done[s] < k and done[s] * frame // k <= slot]
        s = min(ready, key=lambda s: (-(-(done[s] + 1) * frame // share[s]), s))
        out += queue[s][done[s] * block:(done[s] + 1) * block]
        done[s] += 1
    return out


def test_run_keeps_the_mixed_order(spark, tmp_path):
    names = ["p"] * 150 + ["q"] * 90 + ["r"] * 40 + ["s"] * 25
    rows = [(i, " ".join(f"w{(i * 37 + k * k * 11) % 9973}x{i}" for k in range(8 + i % 30)), "en", s, 100) for i, s in enumerate(names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0), (4, 1), (7, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    keys = [r.doc_id for r in got]
    assert len(keys) > 100 and len(set(keys)) == len(keys) and len({r.position >> 43 for r in got}) > 2
    assert [r.position for r in got] == sorted({r.position for r in got})
    assert keys == pfair_walk([(k, names[k]) for k in keys])
