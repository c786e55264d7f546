import random

import pytest
from pyspark.sql import functions as F

from prefloom.functions import text as X
from prefloom.operators import pairs as P

BLANKS = [" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", chr(0x2003), chr(0x3000), chr(0x200B)]


def run(spark, values, expr):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r[0] for r in df.select("i", expr(F.col("t")).alias("o")).orderBy("i").select("o").collect()]


def noise(rng, parts, size):
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, size))) for _ in range(400)]


def test_strip_words_and_clean_agree_with_python(spark):
    texts = noise(random.Random(1), BLANKS + ["a", "é", "“", "”", "‘", "’", "word"], 12)
    assert run(spark, texts, X.strip) == [t.strip() for t in texts]
    assert run(spark, texts, X.words) == [t.split() for t in texts]
    quotes = str.maketrans("“”‘’", "\"\"''")
    squeezed = [" ".join(("|" + t.strip().translate(quotes) + "|").split())[1:-1] for t in texts]
    assert run(spark, texts, X.clean_text) == squeezed


@pytest.mark.parametrize("transcript, prompt, response", [
    ("H: hi\n\nA: yo", "hi", "A: yo"),
    ("x H: a\nH: b\nA: c", "a", "H: b\nA: c"),
    ("H: only", "only", ""),
    ("Human: q\n\nAssistant: r", "Continue the conversation:", "Human: q\n\nAssistant: r"),
    ("  H:\nA: z ", "", "A: z"),
    ("aH:bH:c\n d", "bH:c", "d"),
])
def test_transcript_parts(spark, transcript, prompt, response):
    df = spark.createDataFrame([(1, transcript, transcript)], "pair_id long, chosen string, rejected string")
    row = P.parse_pairs(df).first()
    assert (row.prompt, row.chosen, row.rejected) == (prompt, response, response)


def test_prepare_takes_the_subset_before_the_filter(spark):
    rows = [
        (1, "H: a\nA: x", "H: a\nA: x"), (2, "H: a\nA: x", "H: a\nA: y"), (3, None, "H: a\nA: y"),
        (4, "H: a\nA: x ‘q’", "H: a\nA:  x"), (5, "H: a", "H: a\nA: y"),
    ]
    df = spark.createDataFrame(rows, "pair_id long, chosen string, rejected string")
    assert [r.pair_id for r in P.prepare_pairs(df, limit=3).collect()] == [2]
    cleaned = {r.pair_id: (r.chosen, r.rejected) for r in P.prepare_pairs(df, limit=None, clean=True).collect()}
    assert cleaned == {2: ("A: x", "A: y"), 4: ("A: x 'q'", "A: x")}
    assert P.with_prompt(df.withColumn("prompt", F.col("chosen"))).count() == 4


def reply_lines(reply, prompt):
    reply = (reply[len(prompt):] if reply.startswith(prompt) else reply).strip()
    if reply.startswith("Human:"):
        _, found, rest = reply.partition("Assistant:")
        reply = rest.strip() if found else ""
    kept = []
    for line in map(str.strip, reply.split("\n")):
        if line.startswith("Human:"):
            break
        if line and not line.startswith("Assistant:"):
            kept.append(line)
    return " ".join(kept).strip()


def test_reply_cleanup_agrees_with_python(spark):
    replies = noise(random.Random(2), ["Human:", "Assistant:", "\n", " ", "a", "b c", "\t", "Human: p"], 10)
    assert run(spark, replies, lambda c: X.clean_reply(c, F.lit("Human: p"))) == [
        reply_lines(r, "Human: p") for r in replies]


def shows_breakdown(text):
    words = text.split()
    return (
        len(text) < 5
        or any(text.count(c) > 20 for c in X.REPEATABLE_CHARS)
        or (len(words) > 5 and max(words.count(w) for w in words) > len(words) * 0.3)
        or any(text.count(w) > 5 for w in X.NONSENSE_WORDS)
    )


def test_broken_agrees_with_python(spark):
    rng = random.Random(3)
    texts = noise(rng, ["a ", "b ", "c ", "dd ", "stairs", ". ", "...", " ee", "…"], 30)
    texts += ["abcd", "x" + "." * 20, "x" + "." * 21, "a b c d e a", "a a a a a", "stairs" * 5, "stairs" * 6, ""]
    for n in range(6, 40):
        top = int(n * 0.3)
        for count in (top, top + 1):
            words = ["w"] * count + [f"v{i}" for i in range(n - count)]
            rng.shuffle(words)
            texts.append(" ".join(words))
    assert run(spark, texts, X.is_broken) == [shows_breakdown(t) for t in texts]
    assert run(spark, texts, X.is_corrupt) == [len(t) < 5 or len(set(t)) < 5 for t in texts]


def test_small_text_columns(spark):
    texts = ["Human: x", "x", None, " \t", "y" * 101]
    assert run(spark, texts[:2], X.generation_prompt) == ["Human: x", "Human: x\n\nAssistant:"]
    assert run(spark, texts, X.default_text)[2] == ""
    assert run(spark, texts, X.is_blank)[3] is True
    assert run(spark, texts, lambda c: X.preview(c, 100))[4] == "y" * 100 + "..."
    assert run(spark, ["y" * 100], lambda c: X.preview(c, 100)) == ["y" * 100]
    picks = run(spark, ["bad", "bad"], lambda c: X.with_fallback(c, F.lit(True), F.col("i") + 4))
    assert picks == [X.FALLBACK_REPLIES[4], X.FALLBACK_REPLIES[0]]
    assert run(spark, ["aaaa", "abab"], lambda c: X.count_of(c, "aa")) == [2, 0]


def test_pair_texts(spark):
    df = spark.createDataFrame([("p", "c", None)], "prompt string, chosen string, rejected string")
    assert P.pair_texts(df).first()[3:] == ("p c", "p ")
    assert P.pair_texts(df, sep="").first()[3:] == ("pc", "p")
    assert P.pair_texts(df, include_prompt=False).first()[3:] == ("c", "")
