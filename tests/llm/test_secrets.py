import random
import re

import pyarrow as pa

from llm.brute import odd_documents
from prefloom.llm import secret_scan as S
from prefloom.llm.automaton import Automaton

KEYS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))


def plain(text):
    rules = [("assign", rf"""({KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)]
    found = [(kind, m.start(), m.end(), k) for k, (kind, p, g, least) in enumerate(rules) for m in re.finditer(p, text or "") if len(m[g]) >= least]
    return [s[:3] for s in sorted(found, key=lambda s: (s[1], s[3]))]


def odd_texts():
    rnd = random.Random(3)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", "=", ":", " ", "'", '"', "abc", "AKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "deadbeef", "\n", ",", "é",
             "x.y/z", "ghp_", "a" * 30, " PRIVATE KEY-----", "-----BEGIN", "ſ", "K"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(3000)] + [None, "", "a" * 10000, ("0" * 5000 + "token=") * 3, "é" * 50 + "token=123456"]


def test_spans_are_those_of_plain_rules():
    texts = odd_texts()
    spans = S._scanner(S.RULES).spans(pa.array(texts))
    base = {r.kind for r in S.BASE}
    assert [[s for s in own if s[0] in base] for own in spans] == [plain(t) for t in texts]


def test_automaton_marks_what_occurs():
    patterns = ["ab+c", "[0-9]{3}", "x(y|zz)?w"]
    a = Automaton(patterns)
    rnd = random.Random(1)
    for _ in range(500):
        text = "".join(rnd.choice("abc0123xyzw ") for _ in range(rnd.randint(1, 30))).encode()
        raw = pa.py_buffer(text)
        import numpy as np

        mark = int(a.scan(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(text)]))[0])
        first = min((m.end() for p in patterns for m in [re.search(p.encode(), text)] if m), default=None)
        assert (mark > 0) == (first is not None)
    assert a.table.shape[0] < 40


def test_operators(spark):
    docs = odd_documents(spark)
    docs = docs.unionByName(docs.limit(1).selectExpr("1000L as doc_id", "'x token=abcdef12 y' as text", "lang", "source", "n_chars", "key", "node", "score"))
    got = {(r.doc_id, tuple(map(tuple, r.spans))) for r in S.find_secrets(docs).collect()}
    assert (1000, (("assign", 2, 16),)) in got and len(got) >= 10
    redacted = S.redact_secrets(docs)
    assert redacted.schema == docs.schema and redacted.count() == docs.count()
    assert redacted.where("doc_id = 1000").first().text == "x <assign> y"
    assert S.find_secrets(docs.limit(0)).collect() == []
    assert S.without_spans("abcdefgh", [("p", 1, 4), ("q", 2, 3), ("r", 3, 6), ("s", 6, 7)]) == "a<p><s>h"
