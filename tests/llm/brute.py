"""Plain versions of the operators, and rows with every odd case."""

import collections
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def odd_documents(spark, seed=1):
    """Nulls, empty and long texts, repeated rows, copies, near copies, shared passages, and columns with clashing names."""
    rnd = random.Random(seed)
    words = ["Alpha", "beta", "gamma,", "délta", "x", "the", "of", "and", "zeta.", "eta!", "théta", "iota", "kappa", "mu"]
    some = lambda n: " ".join(rnd.choice(words) + rnd.choice(["", "", "1", "b", "cd"]) for _ in range(n))
    passage, base = some(40), some(120)
    texts = [None, "", " \t\n", "one", "a b c", "A  b\tc", base, base.upper(), base, base + " end", "start " + base, some(3000), passage, some(30) + " " + passage,
             passage + "\n" + some(50), some(13), some(12), "x " * 40, "x " * 60, " a b \x1c c \U0001F600"]
    texts += [some(rnd.randint(0, 60)) for _ in range(25)]
    near = base.split()
    for _ in range(12):
        own = list(near)
        own[rnd.randrange(len(own))] = some(1)
        own[rnd.randrange(len(own))] = some(1)
        texts.append(" ".join(own))
    rows = [(i * 3 + 1, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or ""), "k", 1, "n") for i, t in enumerate(texts)]
    rows += [rows[6], rows[1], (None, "a lonely text without a key", "en", "s1", 5, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, node int, score string")


def components(ids, pairs):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, size=5):
    w = WORD.findall(folded(text))
    return frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def repeats(rows, length=13):
    """Per (key, text) its words and which of them go."""
    first = {}
    for key, text in rows:
        w = WORD.findall(text or "")
        for k in range(len(w) - length + 1):
            if key is not None:
                first[tuple(w[k:k + length])] = min(key, first.get(tuple(w[k:k + length]), key))
    out = []
    for key, text in rows:
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if key is not None and first[tuple(w[k:k + length])] < key:
                gone[k:k + length] = [True] * length
        out.append((key, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return collections.Counter(out)
