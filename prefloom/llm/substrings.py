"""Passages that stand in an earlier document already: seeds on winnowed anchors, extended to windows, merged to maximal repeats.

Every window of ``length`` words holds ``length - seed + 1`` runs of ``seed`` words; the one with the smallest hash is its anchor. The anchor
depends on the window alone, so equal windows have equal anchors, and a repeat can only lie around an anchor that two documents
share. Those anchors are joined back to their documents and extended both ways to the windows they stand for; a window is a repeat if its word
sequence also starts in a document with a smaller key, and overlapping repeats are merged into the longest spans.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from prefloom.llm.keys import only_keys, split_keys
from prefloom.llm.words import Words, window_hashes, word_slices
from prefloom.sources.scratch import written


def _windows(words: Words, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every window of the slice its first word, its text, its anchor and its own hash."""
    hashes = words.hashes(False)
    n = len(hashes) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    seeds = window_hashes(hashes, seed)
    anchor, done = seeds[:n].copy(), 1
    runs = length - seed + 1
    least = seeds
    while done * 2 <= runs:  # minima over twice as many runs at each step
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    anchor = np.minimum(least[:n], least[runs - done:runs - done + n])
    owner = words.owner()
    inside = np.flatnonzero(owner[:n] == owner[length - 1:])
    return inside, owner[inside], anchor[inside], window_hashes(hashes, length)[inside]


def _anchors(length: int, seed: int):
    """The distinct anchors of every text."""

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for words in word_slices(batch.column(1)):
                _, text, anchor, _ = _windows(words, length, seed)
                new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]) if len(anchor) else np.zeros(0, bool)
                text, anchor = text[new], anchor[new]
                yield pa.record_batch([pa.array(anchor.view(np.int64)), pa.array(keys[words.first + text], pa.int64())], names=["anchor", "key"])

    return run


def _extended(length: int, seed: int):
    """The windows around shared anchors: their hash, key, and first word below the checksum of its text, as texts may have one key."""

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            shared, sums = batch.column(2), batch.column(3).to_numpy()
            flat = shared.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = np.array([0 if v is None else v for v in shared.value_lengths().to_pylist()], np.int64)
            of = np.repeat(np.arange(batch.num_rows), sizes)
            known = np.unique(flat ^ (of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            for words in word_slices(batch.column(1)):
                first, text, anchor, window = _windows(words, length, seed)
                mark = anchor ^ ((words.first + text).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                at = np.minimum(np.searchsorted(known, mark), max(len(known) - 1, 0))
                keep = np.flatnonzero(known[at] == mark) if len(known) else np.zeros(0, np.int64)
                yield pa.record_batch([pa.array(window[keep].view(np.int64)), pa.array(keys[words.first + text[keep]], pa.int64()),
                                       pa.array((sums[words.first + text[keep]] << 31) | (first[keep] - words.bounds[text[keep]]))], names=["window", "key", "first"])

    return run


def _without(length: int):
    """Words and spans of every text without its repeats."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            firsts = batch.column(2)
            flat = firsts.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(firsts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            copy, sums = batch.column(3).to_numpy(zero_copy_only=False), batch.column(4).fill_null(0).to_numpy()
            for words in word_slices(batch.column(1)):
                raw = words.raw.tobytes()
                total, removed, kept, spans = [], [], [], []
                for k in range(len(words)):
                    a, b, row = int(words.bounds[k]), int(words.bounds[k + 1]), words.first + k
                    n = b - a
                    own = np.arange(max(n - length + 1, 0)) if copy[row] else flat[at[row]:at[row + 1]]
                    if not copy[row] and len(own):
                        own = own[own >> 31 == sums[row]] & ((1 << 31) - 1)
                    cover = np.zeros(n + 1, np.int32)
                    np.add.at(cover, own, 1)
                    np.add.at(cover, own + length, -1)
                    gone = np.cumsum(cover[:n]) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    total.append(n)
                    removed.append(int(gone.sum()))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)])
                    stay = np.flatnonzero(~gone) + a
                    kept.append(b" ".join([raw[x:y] for x, y in zip(words.starts[stay].tolist(), words.ends[stay].tolist())]).decode())
                yield pa.record_batch([batch.column(0).slice(words.first, len(words)), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                       pa.array(kept, pa.string()), pa.array(spans, span)], names=["key", "n_words", "n_removed", "kept", "repeats"])

    return run


def remove_repeats(df: DataFrame, length: int = 13, seed: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words long, n_removed long, kept string, repeats array<struct<start, end>>)`` for every row: its words but those covered by a window
    of ``length`` words that also starts in a row with a smaller key, joined by one blank, and the removed spans in words, end exclusive.

    Windows are judged on the input. Keys are whole numbers. Only the key and the text are read. Null and empty texts have no words; rows with a
    null key, and rows with one key, are never earlier than each other, also where one key has several texts; equal texts under a larger key are
    repeats as a whole, and only the smallest key of equal texts goes through the join; an empty table gives no rows.
    """
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    known = docs.filter("key is not null and text is not null")
    # equal texts: the smallest key stands for all
    same = F.struct(F.xxhash64("text"), F.crc32("text"), F.length("text"))
    heads = known.groupBy(same.alias("same")).agg(F.min("key").alias("key"))
    classes = written(known.select(same.alias("same"), F.col("key").alias("own")).join(heads, "same").groupBy("own").agg(F.min(F.col("own") > F.col("key")).alias("copy")), "copies")
    copies = classes.filter("copy").select(F.col("own").alias("key"))
    maybe, never = split_keys(known, copies)
    lead = never.unionByName(maybe.join(copies, "key", "left_anti"))
    # dealt out by anchor, and later by window, once for the smallest key and for the join
    anchors = lead.mapInArrow(_anchors(length, seed), "anchor long, key long").repartition("anchor")
    several = anchors.groupBy("anchor").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high").select("anchor")
    shared = written(anchors.join(several.hint("shuffle_hash"), "anchor").groupBy("key").agg(F.collect_set("anchor").alias("anchors")), "anchors")
    found = only_keys(known, shared).join(shared, "key").select("key", "text", "anchors", F.crc32("text").alias("sum")).mapInArrow(
        _extended(length, seed), "window long, key long, first long")
    windows = found.repartition("window")
    earliest = windows.groupBy("window").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high").select("window", "low")
    # at most one entry for each word of the texts under a key
    starts = windows.join(earliest.hint("shuffle_hash"), "window").filter("key > low").groupBy("key").agg(F.sort_array(F.collect_list("first")).alias("firsts"))
    touched = written(starts.withColumn("copy", F.lit(False)).unionByName(
        copies.select("key", F.lit(None).cast("array<long>").alias("firsts"), F.lit(True).alias("copy"))), "repeats")
    maybe, never = split_keys(docs, touched)
    whole = never.select("key", "text", F.lit(None).cast("array<long>").alias("firsts"), F.lit(False).alias("copy"))
    cut = maybe.join(touched, "key", "left").select("key", "text", "firsts", F.coalesce("copy", F.lit(False)).alias("copy")).unionByName(whole)
    out = cut.withColumn("sum", F.crc32("text")).mapInArrow(_without(length), "key long, n_words long, n_removed long, kept string, repeats array<struct<start long, end long>>")
    return out.select(F.col("key").cast(df.schema[key].dataType).alias(key), "n_words", "n_removed", "kept", "repeats")
