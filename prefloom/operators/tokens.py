"""Vocabulary, encoding, padding and batches of token arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from prefloom.functions import tokens as K
from prefloom.operators.ordering import assign_batches, dense_index, prefix_cutoff
from prefloom.sources.scratch import written


def build_vocabulary(df: DataFrame, text: str, size: int, reserved: int = 2) -> DataFrame:
    """The ``size`` most frequent tokens with ids from ``reserved`` on, ``(token, n, token_id)``; of equally frequent ones the smaller come first.

    Counts are combined before the shuffle, so a very frequent token costs one row per task. Tokens that are too rare to have an id are
    left out by counting ranges of counts; the others are ranked by a range shuffle and the sizes of its parts. No task and no driver
    holds the vocabulary, whatever its size.
    """
    counts = df.select(F.explode(K.token_texts(text)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    held = written(counts.withColumn("rare", -F.col("n")), "token-counts")
    least = prefix_cutoff(held, "rare", size)
    often = held if least is None else held.where(F.col("rare") <= least)
    ranked = dense_index(often, ["rare", "token"], "rank").where(F.col("rank") < size)
    return ranked.select("token", "n", (F.col("rank") + reserved).cast("int").alias("token_id"))


def encode(
    df: DataFrame, texts: dict[str, str], vocabulary: DataFrame, key: str,
    unknown_id: int = 1, route: str = "look_up",
) -> DataFrame:
    """Add token ids per text column (``texts``: text -> ids); unknown tokens get ``unknown_id``.

    The caller picks the route: ``look_up`` writes the vocabulary as one file, which Spark hands to the executors and each Python worker reads once
    (about 30 bytes a token), and shuffles no text; ``join`` meets it by token, for vocabularies that are too large for a worker.
    """
    if route == "join":
        for text, ids in texts.items():
            df = _encode_by_join(df, text, ids, vocabulary, key, unknown_id)
        return df
    file = written(vocabulary.select("token", "token_id").coalesce(1), "look-up").inputFiles()[0]
    df.sparkSession.sparkContext.addFile(file)
    look_up = _lookup(file.rsplit("/", 1)[-1], unknown_id)
    return df.withColumns({ids: look_up(K.token_texts(text)) for text, ids in texts.items()})


class TokenTable:
    """Tokens sorted by a 64-bit hash: two numbers and the text for each, found by binary search and compared by text."""

    def __init__(self, rows: pa.Table) -> None:
        tokens = rows["token"].combine_chunks()
        hashes = _hashes(tokens)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.ids = hashes[order], rows["token_id"].to_numpy()[order].astype(np.int32)
        self.tokens = tokens.take(pa.array(order))

    def ids_of(self, tokens: pa.Array, unknown: int) -> np.ndarray:
        out, left = np.full(len(tokens), unknown, np.int32), np.arange(len(tokens))
        hashes = _hashes(tokens)
        at = np.searchsorted(self.hashes, hashes)
        while len(left):  # again only where other tokens have the same hash
            inside = at[left] < len(self.hashes)
            left = left[inside]
            left = left[self.hashes[at[left]] == hashes[left]]
            same = pc.equal(self.tokens.take(pa.array(at[left])), tokens.take(pa.array(left))).to_numpy(zero_copy_only=False)
            out[left[same]] = self.ids[at[left[same]]]
            left = left[~same]
            at[left] += 1
        return out


def _hashes(tokens: pa.Array) -> np.ndarray:
    parts = [tokens.slice(at, 1 << 16).to_pylist() for at in range(0, len(tokens), 1 << 16)]
    return np.concatenate([np.zeros(0, np.uint64), *(pd.util.hash_array(np.array(p, object), categorize=False) for p in parts)])


_tables: dict[str, TokenTable] = {}


def _lookup(name: str, unknown_id: int):
    @F.arrow_udf("array<int>")
    def look_up(tokens: pa.Array) -> pa.Array:
        # one table for each Python worker and vocabulary
        if name not in _tables:
            _tables.clear()
            _tables[name] = TokenTable(pq.read_table(SparkFiles.get(name)))
        coded = tokens.flatten().dictionary_encode()
        ids = pa.array(_tables[name].ids_of(coded.dictionary, unknown_id)).take(coded.indices)
        sizes = pc.fill_null(pc.list_value_length(tokens), 0)
        ends = pc.cumulative_sum(sizes.cast(pa.int32()))
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        return pa.ListArray.from_arrays(offsets, ids, mask=tokens.is_null())

    return look_up


def _encode_by_join(
    df: DataFrame, text: str, ids: str, vocabulary: DataFrame, key: str, unknown_id: int
) -> DataFrame:
    """Each row's different tokens meet the vocabulary; those found go back to their row, where places are filled in.

    A frequent token meets the vocabulary once per row, and the join, whose
    vocabulary side is unique, may be split where one token has most rows.
    Unknown tokens do not come back, and places are never shuffled. Rows with the same key share one list, in the order of the places.
    """
    tokens = df.select(key, F.explode(F.array_distinct(K.token_texts(text))).alias("token")).where(F.col(key).isNotNull())
    matched = tokens.join(vocabulary.select("token", F.col("token_id").cast("int").alias("token_id")), "token")
    found = matched.groupBy(key).agg(F.collect_list(F.struct("token", "token_id")).alias("_found"))
    fill = _filled(unknown_id)
    own = fill(K.token_texts(text), F.col("_found.token"), F.col("_found.token_id"))
    rows = df.join(found, key, "left").withColumn("_own", F.when(F.col(key).isNotNull(), own)).drop("_found")
    lists = rows.withColumn("_lists", F.collect_list("_own").over(W.partitionBy(key))).drop("_own")
    placed = F.transform("_lists", lambda x: F.transform(x, lambda i, pos: F.struct(pos.alias("pos"), i.alias("id"))))
    merged = F.transform(F.array_sort(F.flatten(placed)), lambda x: x["id"])
    empty = F.array().cast("array<int>")
    all_ids = F.when(F.size("_lists") > 1, merged).otherwise(F.coalesce(F.try_element_at("_lists", F.lit(1)), empty))
    # A row without a text has a list only where a row of the same key has words.
    return lists.withColumn(ids, F.when(F.col(text).isNotNull() | (F.size(all_ids) > 0), all_ids)).drop("_lists")


def _filled(unknown_id: int):
    @F.arrow_udf("array<int>")
    def fill(tokens: pa.Array, words: pa.Array, ids: pa.Array) -> pa.Array:
        # A token has one id, so the words found for any row of a batch serve all.
        known = words.flatten().dictionary_encode()
        id_of = np.full(len(known.dictionary) + 1, unknown_id, np.int32)
        id_of[known.indices.to_numpy(zero_copy_only=False)] = ids.flatten().to_numpy(zero_copy_only=False)
        coded = tokens.flatten().dictionary_encode()
        at = pc.fill_null(pc.index_in(coded.dictionary, value_set=known.dictionary), len(known.dictionary)).to_numpy(zero_copy_only=False)
        filled = pa.array(id_of[at][coded.indices.to_numpy(zero_copy_only=False)], pa.int32())
        ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(tokens), 0).cast(pa.int32()))
        return pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int32()), ends]), filled, mask=tokens.is_null())

    return fill


def pad_fixed(df: DataFrame, ids: str, mask: str, max_length: int, pad_id: int = 0) -> DataFrame:
    """Truncate and pad every row to ``max_length``, with its mask."""
    cut = K.truncate(F.col(ids), max_length)
    return df.withColumns({ids: K.pad(cut, max_length, pad_id), mask: K.attention_mask(cut, max_length)})


def pad_to_longest(
    df: DataFrame, columns: dict[str, str], batch: str = "batch_id", max_length: int | None = None, pad_id: int = 0
) -> DataFrame:
    """Pad each id column (``columns``: ids -> mask) to its longest row in the batch.

    Lengths are reduced per batch before the shuffle and joined back; a batch
    of any size is split by adaptive execution rather than held by one task.
    """
    if max_length is not None:
        df = df.withColumns({c: K.truncate(F.col(c), max_length) for c in columns})
    longest = df.groupBy(batch).agg(*[F.max(F.size(c)).alias(f"_len_{c}") for c in columns])
    joined = df.join(longest, batch)
    padded: dict[str, Column] = {}
    for ids, mask in columns.items():
        length = F.col(f"_len_{ids}")
        padded[ids] = K.pad(F.col(ids), length, pad_id)
        padded[mask] = K.attention_mask(F.col(ids), length)
    return joined.withColumns(padded).drop(*[f"_len_{c}" for c in columns])


def collate(df: DataFrame, keys: list[str], batch_size: int, columns: list[str]) -> DataFrame:
    """One row per batch with a column of stacked values for each of ``columns``.

    Batches are assigned here, so no group exceeds ``batch_size`` rows.
    """
    batched = assign_batches(df.select(*dict.fromkeys(keys + columns)), keys, batch_size)
    item = F.struct("idx", *columns)
    stacked = batched.groupBy("batch_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return stacked.select("batch_id", *[F.col(f"items.{c}").alias(c) for c in columns])


def causal_labels(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    return df.withColumn("labels", F.col(ids))


def scored_positions(df: DataFrame, key: str, labels: str = "labels") -> DataFrame:
    """One row per position whose label counts in the loss."""
    positions = df.select(key, F.posexplode(labels).alias("pos", "label"))
    return positions.where(F.col("label") != K.IGNORED_LABEL)
