"""Scoring texts with a Katz backoff bigram model.

``P(w | h) = d(c) c(h w) / n(h)`` where h w was seen in training, else ``a(h) P(w)``; ``P(w) = d(c) c(w) / (N + 1)``, the rest for unknown words. d are Good-Turing
discounts for counts up to 5. ``n(h) = c(h)``, plus one beyond 5, so that some mass is always left; ``a(h)`` gives unseen words exactly that
rest. Histories not seen in training leave the word to ``P(w)``. A text's first history is a begin mark, its last token an end mark.

Texts are cut into chunks; each chunk sends its pairs, with the texts they stand in, to buckets by word. A bucket therefore holds all counts of its words and
pairs, and scores its tokens as if their history's part were known: that part is ``-log n(h)``, which the history's own bucket adds. Only unseen
pairs need more, the backoff weight of their history; they leave the bucket as rows that are joined with the table of weights. Pairs of
very frequent words are spread over buckets by their history, with the word's count sent along.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from prefloom.llm.batches import give_back, small_batches
from prefloom.llm.keys import only_keys
from prefloom.llm.words import mix, word_slices
from prefloom.sources.scratch import written

TOP = 5
BEGIN, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
#: Texts of a chunk at most (two bytes number them and hold a bit), and bytes of text.
CHUNK_TEXTS, CHUNK_BYTES = 1 << 15, 6 << 20
_T = [f"t{r}" for r in range(1, TOP + 1)]


def _word_counts(batches):
    """Training counts of the words of every slice."""
    for batch in batches:
        train = batch.column(1).to_numpy(zero_copy_only=False)
        for words in word_slices(batch.column(0)):
            own = words.hashes(True)[train[words.first + words.owner()]]
            distinct, n = np.unique(own, return_counts=True)
            yield pa.record_batch([pa.array(distinct.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])
        give_back()


def discounts(counts: dict[int, int]) -> np.ndarray:
    """Good-Turing discounts d(0..TOP) from the numbers of things seen 1 to TOP + 1 times; (r - 1/2) / r where they give no proper value."""
    n = [counts.get(r, 0) for r in range(TOP + 2)]
    out = np.ones(TOP + 1)
    common = (TOP + 1) * n[TOP + 1] / n[1] if n[1] else 1.0
    for r in range(1, TOP + 1):
        ratio = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        value = (ratio - common) / (1 - common) if common != 1 else 0.0
        out[r] = value if 0 < value < 1 else (r - 0.5) / r
    return out


def _small(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, packed; the first byte tells how many."""
    kind = np.uint8 if not len(values) or values.max() < 256 else np.uint16 if values.max() < 65536 else np.uint32
    return zlib.compress(bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes(), 1)


def _wide(data: bytes) -> np.ndarray:
    data = zlib.decompress(data)
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.uint32}[data[0]], offset=1).astype(np.int64)


def _buckets(words: np.ndarray, before: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    """The bucket of each token: by its word, of a very frequent word by its history too."""
    if len(hot):
        at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        words = np.where(hot[at] == words, mix(words ^ (before >> np.uint64(1))), words)
    return (mix(words + np.uint64(1)) % np.uint64(parts)).astype(np.int64)


def _chunks(sent, parts: int):
    """For every chunk and bucket the words, histories and texts of its tokens; for every chunk its texts' keys."""

    def pack(chunk, tokens, before, texts, keys, train, hot):
        names, ids = np.unique(np.concatenate([tokens, before]), return_inverse=True)
        word, past = ids[:len(tokens)], ids[len(tokens):]
        bucket = _buckets(tokens, before, hot, parts)
        order = np.argsort(bucket * len(names) + word, kind="stable")
        word, past, texts, bucket = word[order], past[order], texts[order], bucket[order]
        borders = np.searchsorted(bucket, np.arange(parts + 1))
        lists = [[] for _ in range(6)]
        for k in np.flatnonzero(np.diff(borders)).tolist():
            own = slice(borders[k], borders[k + 1])
            own_words, runs = np.unique(word[own], return_counts=True)
            own_past, at = np.unique(past[own], return_inverse=True)
            for cell, value in zip(lists, (k, names[own_words].tobytes(), _small(runs), names[own_past].tobytes(), _small(at), _small(texts[own] * 2 + train[texts[own]]))):
                cell.append(value)
        n = len(lists[0])
        rows = [pa.array([*lists[0], chunk % parts], pa.int32()), pa.array([chunk] * (n + 1), pa.int64()), *(pa.array([*cells, None], pa.binary()) for cells in lists[1:]),
                pa.array([None] * n + [keys], pa.list_(pa.struct([("id", pa.int64()), ("tokens", pa.int64()), ("train", pa.bool_())])))]
        return pa.record_batch(rows, names=["bucket", "chunk", "words", "runs", "past", "at", "texts", "keys"])

    def run(batches):
        hot, chunk = sent.value, (TaskContext.get().partitionId() if TaskContext.get() else 0) << 24
        for batch in batches:
            ids, train = batch.column(0).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False)
            first, held, size, total = 0, [], 0, 0
            stream = _bounded_slices(batch.column(1))
            following = next(stream, None)
            while following is not None:
                (rows, raw, tokens, before, texts, n), following = following, next(stream, None)
                held.append((tokens, before, texts + total, n))
                total, size = total + rows, size + raw
                if following is None or size + following[1] > CHUNK_BYTES or total + following[0] > CHUNK_TEXTS:
                    lengths = np.concatenate([h[3] for h in held])
                    keys = [{"id": i, "tokens": int(n), "train": bool(t)} for i, n, t in zip(ids[first:first + total], lengths.tolist(), train[first:first + total].tolist())]
                    yield pack(chunk, *(np.concatenate([h[j] for h in held]) for j in range(3)), keys, train[first:first + total].astype(np.int64), hot)
                    chunk, first, held, size, total = chunk + 1, first + total, [], 0, 0
                    give_back()

    return run


def _bounded_slices(column: pa.Array):
    """Tokens of slices of texts: their number, bytes, token and history hashes, texts and tokens per text."""
    for at in range(0, len(column), 4096):
        for words in word_slices(column.slice(at, 4096)):
            hashes, n = words.hashes(True), len(words)
            tokens = np.insert(hashes, words.bounds[1:], END)
            before = np.empty_like(tokens)
            before[1:] = tokens[:-1]
            lengths = np.diff(words.bounds) + 1
            before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = BEGIN
            yield n, len(words.raw), tokens, before, np.repeat(np.arange(n), lengths), lengths


_OUT = ("kind int, chunk long, past long, n long, " + ", ".join(f"{t} long" for t in _T)
        + ", mass double, text int, texts binary, sums binary, marks binary, keys array<struct<id long, tokens long, train boolean>>")


def _score_bucket(sent):
    """What one bucket knows: scores of its tokens by text, the types and mass seen after each history, unseen pairs, counts of pair counts."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        facts = score(frame)
        give_back()
        return facts

    def score(frame: pd.DataFrame) -> pd.DataFrame:
        hot, hot_counts, unigram, known_total = sent.value
        keys = frame[frame["words"].isna()]
        out = [pd.DataFrame({"kind": 0, "chunk": keys["chunk"], "keys": keys["keys"]})]
        frame = frame[frame["words"].notna()]
        if len(frame):
            own_words = [np.frombuffer(b, np.uint64) for b in frame["words"]]
            own_past = [np.frombuffer(b, np.uint64) for b in frame["past"]]
            words, word_at = np.unique(np.concatenate(own_words), return_inverse=True)
            pasts, past_at = np.unique(np.concatenate(own_past), return_inverse=True)
            word_cut, past_cut = np.cumsum([0, *map(len, own_words)]), np.cumsum([0, *map(len, own_past)])
            w = np.concatenate([np.repeat(word_at[word_cut[k]:word_cut[k + 1]], _wide(b)) for k, b in enumerate(frame["runs"])]).astype(np.int32)
            h = np.concatenate([past_at[past_cut[k]:past_cut[k + 1]][_wide(b)] for k, b in enumerate(frame["at"])]).astype(np.int32)
            marks = [_wide(b) for b in frame["texts"]]
            train = np.concatenate([m & 1 for m in marks]).astype(bool)
            text = np.concatenate([(k << 15) + (m >> 1) for k, m in enumerate(marks)])
            texts, text = np.unique(text, return_inverse=True)
            text = text.astype(np.int32)
            del marks, own_words, own_past, word_at, past_at
            count = np.bincount(w[train], minlength=len(words))
            if len(hot):
                at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
                count = np.where(hot[at] == words, hot_counts[at], count)
            pair = w.astype(np.int64) * len(pasts) + h
            pairs, which = np.unique(pair, return_inverse=True)
            which = which.astype(np.int32)
            del pair
            seen = np.bincount(which, train, len(pairs)).astype(np.int64)
            pair_word, pair_past = pairs // len(pasts), pairs % len(pasts)
            # sums by text
            c, s = count.astype(np.int32)[w], seen.astype(np.int32)[which]
            del which
            ends = words[w] == END
            own = np.where(s > 0, np.log10(np.maximum(s, 1)), np.log10(np.maximum(c, 1)))
            own -= np.where((c > 0) & ~ends, np.log10(np.maximum(c + (c > TOP), 1)), 0)
            base = np.bincount(text, np.log10(c + 0.5), len(texts))
            fixed = np.bincount(text, own, len(texts))
            tally = [np.bincount(text[c > 0], minlength=len(texts))]
            tally += [np.bincount(text[s == r], minlength=len(texts)) for r in range(1, TOP + 1)]
            tally += [np.bincount(text[(s == 0) & (c == r)], minlength=len(texts)) for r in range(TOP + 1)]
            tally.append(np.bincount(text[s == 0], minlength=len(texts)))
            tally = np.stack(tally, 1).astype(np.int32)
            chunks = frame["chunk"].to_numpy()
            cuts = np.searchsorted(texts >> 15, np.arange(len(chunks) + 1))
            parts = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
            out.append(pd.DataFrame({"kind": 1, "chunk": chunks, "texts": [(texts[p] & 0x7FFF).astype(np.uint16).tobytes() for p in parts],
                                     "sums": [np.stack([base[p], fixed[p]]).tobytes() for p in parts], "marks": [_small(tally[p].T.reshape(-1)) for p in parts]}))
            # types after each history
            live = seen > 0
            of, r, size = pair_past[live], seen[live], count[pair_word[live]]
            mass = np.bincount(of, unigram[np.minimum(size, TOP + 1)] * size / known_total, len(pasts))
            kinds = [np.bincount(of[r == k], minlength=len(pasts)) for k in range(1, TOP + 1)]
            total = np.bincount(of, r, len(pasts)).astype(np.int64)
            used = np.flatnonzero(total)
            out.append(pd.DataFrame({"kind": 2, "past": pasts[used].view(np.int64), "n": total[used], "mass": mass[used], **{t: k[used] for t, k in zip(_T, kinds)}}))
            # unseen pairs
            new = np.flatnonzero(s == 0)
            if len(new):
                event, n = np.unique(h[new].astype(np.int64) * len(texts) + text[new], return_counts=True)
                name = texts[event % len(texts)]
                out.append(pd.DataFrame({"kind": 3, "past": pasts[event // len(texts)].view(np.int64), "chunk": chunks[name >> 15], "text": name & 0x7FFF, "n": n}))
            sizes = np.bincount(np.minimum(seen, TOP + 2), minlength=TOP + 3)
            out.append(pd.DataFrame({"kind": 4, "past": np.arange(1, TOP + 2), "n": sizes[1:TOP + 2]}))
        return pd.concat([_filled(part) for part in out if len(part)])

    return run


_COLUMNS = ["kind", "chunk", "past", "n", *_T, "mass", "text", "texts", "sums", "marks", "keys"]
_TYPES = {"kind": "int32", **{c: "Int64" for c in ["chunk", "past", "n", *_T]}, "mass": "float64", "text": "Int32", "texts": "object", "sums": "object", "marks": "object", "keys": "object"}


def _filled(part: pd.DataFrame) -> pd.DataFrame:
    """All columns of a fact, null where it has none."""
    return pd.DataFrame({c: part[c].astype(_TYPES[c]) if c in part else pd.Series([None] * len(part), index=part.index, dtype=_TYPES[c]) for c in _COLUMNS})


def _by_text(pair: np.ndarray, unigram: np.ndarray, begin: float, base: float, rest: float, known_total: float):
    """The texts of a chunk: what the buckets know of them, summed up and put into logarithms."""
    logs = np.log10(pair[1:])
    down = np.log10(np.concatenate([[rest], unigram[1:TOP + 1] / known_total, [1 / known_total]]))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        keys = frame.loc[frame["kind"] == 0, "keys"].iat[0]
        n = len(keys)
        sums, marks = np.zeros((2, n)), np.zeros((2 + 2 * TOP + 1, n), np.int64)
        for texts, own, counts in frame.loc[frame["kind"] == 1, ["texts", "sums", "marks"]].itertuples(index=False):
            at = np.frombuffer(texts, np.uint16)
            sums[:, at] += np.frombuffer(own).reshape(2, -1)
            marks[:, at] += _wide(counts).reshape(len(marks), -1)
        known, seen, below, unseen = marks[0], marks[1:TOP + 1], marks[TOP + 1:2 * TOP + 2], marks[-1]
        often = unseen - below.sum(0)
        score = sums[1] + logs @ seen + down[:TOP + 1] @ below + down[-1] * often - begin
        tokens = np.array([k["tokens"] for k in keys])
        return pd.DataFrame({"chunk": frame["chunk"].iat[0], "text": np.arange(n), "id": pd.array([k["id"] for k in keys], "Int64"), "train": [k["train"] for k in keys],
                             "n_tokens": tokens, "n_known": known, "base_score": sums[0] - tokens * base, "part": score})

    return run


def score_texts(df: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, train boolean, n_tokens, n_known, train_tokens long, base_score, score double)`` for every row: a Katz bigram model of the rows with ``train``, and
    the smoothed unigram score ``sum log10((c + 0.5) / (N + 0.5 (V + 1)))``, both over the words with A-Z folded and one end mark.

    Keys are whole numbers. Null and empty texts have the end mark only; rows with a null ``train`` are not learned from; repeated rows count as
    often as they stand; without training rows all is unknown; an empty table gives no rows. Only key, text and what ``train`` names are read.
    """
    with small_batches(df.sparkSession):
        return _scored(df, train, key, text)


def _scored(df: DataFrame, train: Column, key: str, text: str) -> DataFrame:
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    words = written(docs.select("text", "train").mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "unigrams")
    learned = docs.filter("train").count()
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = total + learned, distinct + (learned > 0)
    sizes = {r["n"]: r["count"] for r in words.filter(F.col("n") <= TOP + 1).groupBy("n").count().collect()}
    if 0 < learned <= TOP + 1:
        sizes[learned] = sizes.get(learned, 0) + 1
    unigram = np.append(discounts(sizes), 1.0)
    known_total = total + 1.0
    # at most 4 words for each bucket
    often = words.filter(F.col("n") >= total / (4 * parts) + 1).select("word", "n").collect()
    hot = {np.uint64(int(r["word"]) & (2**64 - 1)): r["n"] for r in often} | ({END: learned} if learned >= total / (4 * parts) + 1 else {})
    names = np.array(sorted(hot), np.uint64)
    sc = spark.sparkContext
    chunks = docs.mapInArrow(_chunks(sc.broadcast(names), parts), "bucket int, chunk long, words binary, runs binary, past binary, at binary, texts binary, keys array<struct<id long, tokens long, train boolean>>")
    known = sc.broadcast((names, np.array([hot[x] for x in names], np.int64), unigram, known_total))
    facts = written(chunks.groupBy("bucket").applyInPandas(_score_bucket(known), _OUT), "facts")
    pair = discounts({r["past"]: r["n"] for r in facts.filter("kind = 4").groupBy("past").agg(F.sum("n").alias("n")).collect()})
    # the mass that known words leave to unknown ones
    left = 1 - sum(unigram[r] * r * sizes.get(r, 0) for r in range(1, TOP + 1)) / known_total - (total - sum(r * sizes.get(r, 0) for r in range(1, TOP + 1))) / known_total
    events = facts.filter("kind = 3").select("past", "chunk", "text", "n")
    asked = written(events.select("past").distinct(), "histories")
    weights = _weights(only_keys(facts.filter("kind = 2").select("past", "n", "mass", *_T), asked, "past"), pair)
    raised = events.join(weights, "past").groupBy("chunk", "text").agg(F.sum(F.col("n") * F.col("weight")).alias("more"))
    lowest = np.log10(total + 0.5 * (distinct + 1))
    begin = float(np.log10(learned + (learned > TOP))) if learned else 0.0
    shape = "chunk long, text int, id long, train boolean, n_tokens long, n_known long, base_score double, part double"
    texts = facts.filter("kind <= 1").select("kind", "chunk", "texts", "sums", "marks", "keys").groupBy("chunk").applyInPandas(
        _by_text(pair, unigram, begin, float(lowest), float(left), known_total), shape)
    return texts.join(raised, ["chunk", "text"], "left").select(
        F.col("id").cast(df.schema[key].dataType).alias(key), "train", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score",
        (F.col("part") + F.coalesce("more", F.lit(0.0))).alias("score"))


def _weights(seen: DataFrame, pair: np.ndarray) -> DataFrame:
    """``(past, weight)``: the logarithm of each history's backoff weight, with the ``-log n(h)`` taken back that its bucket has added."""
    rows = seen.groupBy("past").agg(F.sum("n").alias("n"), F.sum("mass").alias("mass"), *[F.sum(t).alias(t) for t in _T])
    total = F.col("n") + (F.col("n") > TOP).cast("long")
    free = sum(((1 - float(pair[r])) * r * F.col(f"t{r}") for r in range(1, TOP + 1)), total - F.col("n"))
    return rows.select("past", (F.log10(free / total) - F.log10(1 - F.col("mass")) + F.log10(total.cast("double"))).alias("weight"))
