"""Corpus BLEU, ROUGE-L, embedding match and perplexity."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from prefloom.functions import stemming
from prefloom.functions.numeric import piece_of, token_logprob
from prefloom.functions.text import words
from prefloom.functions.tokens import IGNORED_LABEL

# The UDFs below travel with their code, so executors need no installed copy of this package.
for _module in (sys.modules[__name__], stemming):
    cloudpickle.register_pickle_by_value(_module)

MAX_ORDER = 4

# The 13a tokenization rules, in order. (Blanks are left out of the first
# pattern's class: they separate tokens anyway.)
BLEU_RULES = [
    ("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"),
]
BLEU_PATTERNS = [
    (r"([\{-\~\[-\`!-\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]
# Words without any of these characters are one token.
_BLEU_MARKS = r"[{-~\[-`!-&(-+:-@/.,-]"
# Tokens of at most this many letters are not stemmed.
UNSTEMMED_LENGTH = 3

# Token vectors per block of one item in the embedding match, and blocks of either side that meet in one task.
VECTOR_BLOCK = 512
CELL_BLOCKS = 4

# Tokens of both sides that a worker turns into numbers at a time, names it keeps meanwhile, and tokens of a text per block of bits.
RUN_TOKENS = 1 << 18
KEPT_NAMES = 1 << 16
LCS_BLOCK = 4096


def pair_by_item(predictions: DataFrame, references: DataFrame, key: str = "item_id") -> DataFrame:
    """Predictions and references of the same item in one row.

    The metrics cost far more than moving their texts, so both sides are
    shuffled to all cores by key, also where one of them could be broadcast.
    """
    left = predictions.select(key, F.col("text").alias("prediction"))
    return left.join(references.select(key, F.col("text").alias("reference")).hint("merge"), key)


def _runs(left: pa.ListArray, right: pa.ListArray) -> Iterator[tuple[pa.ListArray, pa.ListArray, np.ndarray, np.ndarray]]:
    """Both columns and the sizes of their lists, cut into runs of rows with about ``RUN_TOKENS`` tokens; a longer row is a run by itself."""
    n, m = (pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False) for x in (left, right))
    ends = np.cumsum(n + m)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, before + RUN_TOKENS, side="right")), at + 1)
        yield left.slice(at, to - at), right.slice(at, to - at), n[at:to], m[at:to]
        at = to


def _coded(
    left: pa.ListArray, right: pa.ListArray, name: Callable[[str], str] | None = None,
    parts: Callable[[pa.Array], tuple[pa.Array, np.ndarray, np.ndarray]] | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The token lists of both columns as arrays of numbers, row by row.

    Equal tokens of a row have equal numbers. ``name`` is applied to the different tokens of a run; ``parts`` cuts them as words into tokens and
    gives these with the start and the number for each word. A worker holds the numbers of one run, whatever the size of the batch.
    """
    kept: dict[str, str] = {}

    def of(token: str) -> str:
        if token not in kept:
            if len(kept) >= KEPT_NAMES:
                kept.clear()
            kept[token] = name(token)
        return kept[token]

    for p, r, n, m in _runs(left, right):
        encoded = pa.concat_arrays([p.flatten(), r.flatten()]).dictionary_encode()
        numbers = encoded.indices.to_numpy(zero_copy_only=False)
        sizes = np.concatenate([n, m])
        if name is not None:
            names = pa.array([of(t) for t in encoded.dictionary.to_pylist()], pa.string())
            numbers = names.dictionary_encode().indices.to_numpy(zero_copy_only=False)[numbers]
        if parts is not None:
            tokens, starts, widths = parts(encoded.dictionary)
            starts, widths = starts[numbers], widths[numbers]
            ends = np.concatenate([[0], np.cumsum(widths)])
            ids = tokens.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            numbers = ids[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], widths)]
            sizes = np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])
        rows = np.split(numbers.astype("int64"), np.cumsum(sizes)[:-1])
        yield from zip(rows[: len(p)], rows[len(p):])
        del encoded, numbers, rows
    pa.default_memory_pool().release_unused()


# --- BLEU ------------------------------------------------------------------

def bleu_tokens(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    for old, new in BLEU_RULES:
        col = F.replace(col, F.lit(old), F.lit(new))
    col = F.concat(F.lit(" "), col, F.lit(" "))
    for pattern, new in BLEU_PATTERNS:
        col = F.regexp_replace(col, pattern, new)
    return words(col)


def bleu_words(col: Column | str) -> Column:
    """Blank-separated words after the fixed replacements; ``bleu_parts`` gives the tokens of a word."""
    col = F.col(col) if isinstance(col, str) else col
    for old, new in BLEU_RULES:
        col = F.replace(col, F.lit(old), F.lit(new))
    return words(col)


def bleu_parts(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Tokens of different words, and for each word the start and the number of its own.

    The patterns look at neighbouring characters only and take all blanks for the same, so a text's tokens are those of its words.
    """
    marked = pc.match_substring_regex(words, _BLEU_MARKS)
    plain, cut = words.filter(pc.invert(marked)), words.filter(marked)
    cut = pc.binary_join_element_wise(" ", cut, " ", "")
    for pattern, new in BLEU_PATTERNS:
        cut = pc.replace_substring_regex(cut, pattern, new.replace("$", "\\"))
    split = pc.split_pattern_regex(pc.utf8_trim(cut, " "), " +")
    marks = marked.to_numpy(zero_copy_only=False).astype(bool)
    starts, widths = np.empty(len(words), np.int64), np.ones(len(words), np.int64)
    starts[~marks] = np.arange(len(plain))
    widths[marks] = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    starts[marks] = len(plain) + np.cumsum(widths[marks]) - widths[marks]
    return pa.concat_arrays([plain, split.flatten()]), starts, widths


def shared_grams(a: np.ndarray, b: np.ndarray) -> list[int]:
    """N-grams two token lists have in common, with repetition, for orders 1 to 4."""
    distinct, dense = np.unique(np.concatenate([a, b]), return_inverse=True)
    tokens, width = (dense[: len(a)], dense[len(a):]), len(distinct)
    places, keys, shared = [np.arange(len(t)) for t in tokens], list(tokens), []
    for n in range(1, MAX_ORDER + 1):
        if n > 1:
            distinct, dense = np.unique(np.concatenate(keys), return_inverse=True)
            keys = [dense[: len(keys[0])], dense[len(keys[0]):]]
        counts = [np.bincount(k, minlength=len(distinct)) for k in keys]
        shared.append(int(np.minimum(*counts).sum()))
        # An n-gram of both lists begins with an (n-1)-gram of both, and has one more token.
        for side in (0, 1):
            goes_on = (counts[1 - side][keys[side]] > 0) & (places[side] + n < len(tokens[side]))
            places[side] = places[side][goes_on]
            keys[side] = keys[side][goes_on] * width + tokens[side][places[side] + n]
    return shared


@F.arrow_udf(T.ArrayType(T.LongType()))
def _gram_counts(p: pa.Array, r: pa.Array) -> pa.Array:
    """Tokens of the words in both lists, then the n-grams they share by order; null where a list is."""
    known = pc.and_(p.is_valid(), r.is_valid()).to_pylist()
    return pa.array([[len(a), len(b), *shared_grams(a, b)] if k else None for k, (a, b) in zip(known, _coded(p, r, parts=bleu_parts))], pa.list_(pa.int64()))


def _grams(prediction: str, reference: str) -> Column:
    """Token counts of both texts and the n-grams they share, per row; null where a text is missing."""
    return _gram_counts(bleu_words(prediction), bleu_words(reference))


def _gram_sums(grams: str) -> dict[str, Column]:
    """Twelve sums over rows with gram counts: matched, total and total_ref for each order."""
    sums = {}
    for n in range(1, MAX_ORDER + 1):
        sums[f"matched_{n}"] = F.coalesce(F.sum(F.col(grams)[n + 1]), F.lit(0))
        for name, place in (("total", 0), ("total_ref", 1)):
            sums[f"{name}_{n}"] = F.coalesce(F.sum(F.greatest(F.col(grams)[place] - (n - 1), F.lit(0))), F.lit(0))
    return sums


def _bleu_of_sums() -> Column:
    """Corpus BLEU (0 to 100) of the twelve sums, with brevity penalty and exponential smoothing."""
    # Lengths in tokens are the unigram totals. A zero count halves the precision once more each time.
    logs, zeros, any_match = F.lit(0.0), F.lit(0), F.lit(0)
    for n in range(1, MAX_ORDER + 1):
        hit, total = F.col(f"matched_{n}"), F.col(f"total_{n}")
        zeros = zeros + F.when(hit == 0, 1).otherwise(0)
        any_match = any_match + hit
        share = F.when(hit > 0, hit).otherwise(F.pow(F.lit(2.0), -zeros))
        logs = logs + F.log(F.when(total > 0, 100.0 * share / F.nullif(total, F.lit(0))))
    length_p, length_r = F.col("total_1"), F.col("total_ref_1")
    penalty = F.when(length_p >= length_r, F.lit(1.0)).otherwise(
        F.exp(1.0 - length_r / F.nullif(length_p, F.lit(0))))
    return F.when(any_match > 0, F.coalesce(penalty * F.exp(logs / MAX_ORDER), F.lit(0.0))).otherwise(F.lit(0.0))


def bleu_counts(pairs: DataFrame) -> DataFrame:
    """Per order: matched and total n-grams of the predictions, and n-grams of the references.

    Both texts of an item are in one row, so n-grams are counted where they are
    and only twelve sums per task are shuffled.
    """
    sums = pairs.select(_grams("prediction", "reference").alias("g")).agg(*[c.alias(n) for n, c in _gram_sums("g").items()])
    orders = [F.struct(F.lit(n).alias("n"), *[F.col(f"{c}_{n}").alias(c) for c in ("matched", "total", "total_ref")]) for n in range(1, MAX_ORDER + 1)]
    return sums.select(F.inline(F.array(*orders)))


def corpus_bleu(pairs: DataFrame) -> DataFrame:
    """Corpus BLEU (0 to 100) with brevity penalty and exponential smoothing."""
    sums = pairs.select(_grams("prediction", "reference").alias("g")).agg(*[c.alias(n) for n, c in _gram_sums("g").items()])
    return sums.select(_bleu_of_sums().alias("bleu"))


# --- ROUGE-L ---------------------------------------------------------------

def rouge_tokens(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    spaced = F.regexp_replace(F.lower(col), "[^a-z0-9]+", " ")
    return F.array_remove(F.split(spaced, " "), "")


def common_length(a: list, b: list, block: int | None = None) -> int:
    """Length of the longest common subsequence, one bit per token of ``a``.

    ``a`` is taken in blocks, which hand their carries on by token of ``b``, so memory does not grow with the square of a long text.
    """
    size = block or LCS_BLOCK
    common, carries = 0, bytearray(len(b))
    for start in range(0, len(a), size):
        part = a[start:start + size]
        places: dict = {}
        for i, token in enumerate(part):
            places[token] = places.get(token, 0) | (1 << i)
        full = (1 << len(part)) - 1
        row = full
        for j, token in enumerate(b):
            hits = row & places.get(token, 0)
            if hits or carries[j]:
                total = row + hits + carries[j]
                row, carries[j] = (total | (row - hits)) & full, total >> len(part)
        common += len(part) - row.bit_count()
    return common


def _root(token: str) -> str:
    return stemming.stem(token) if len(token) > UNSTEMMED_LENGTH else token


@F.arrow_udf(T.LongType())
def _common_stemmed(p: pa.Array, r: pa.Array) -> pa.Array:
    return pa.array([common_length(a.tolist(), b.tolist()) for a, b in _coded(p, r, _root)], pa.int64())


@F.arrow_udf(T.LongType())
def _common_plain(p: pa.Array, r: pa.Array) -> pa.Array:
    return pa.array([common_length(a.tolist(), b.tolist()) for a, b in _coded(p, r)], pa.int64())


def _f_measure(np: Column, nr: Column, common: Column) -> Column:
    """2PR/(P+R) with P = common/np and R = common/nr."""
    return F.when(common > 0, 2.0 * common / (np + nr)).otherwise(F.lit(0.0))


def rouge_l_scores(pairs: DataFrame, stemming: bool = True, key: str = "item_id") -> DataFrame:
    """F-measure of the longest common subsequence per item."""
    tokens = pairs.select(key, rouge_tokens("prediction").alias("p"), rouge_tokens("reference").alias("r"))
    common = (_common_stemmed if stemming else _common_plain)(F.col("p"), F.col("r"))
    lengths = tokens.select(key, F.size("p").alias("np"), F.size("r").alias("nr"), common.alias("common"))
    return lengths.withColumn("rouge_l", _f_measure(F.col("np"), F.col("nr"), F.col("common")))


def rouge_l(pairs: DataFrame, stemming: bool = True, key: str = "item_id") -> DataFrame:
    return rouge_l_scores(pairs, stemming, key).agg(F.coalesce(F.avg("rouge_l"), F.lit(0.0)).alias("rouge"))


# --- embedding match -------------------------------------------------------

_BESTS = T.StructType([T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("rows", "cols")])


@F.pandas_udf(_BESTS)
def _best_cosines(p: pd.Series, r: pd.Series) -> pd.DataFrame:
    rows, cols = [], []
    for left, right in zip(p, r):
        a, b = (np.array([np.asarray(v, dtype=float) for v in m]) for m in (left, right))
        a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
        b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
        sims = a @ b.T
        rows.append(sims.max(axis=1))
        cols.append(sims.max(axis=0))
    return pd.DataFrame({"rows": rows, "cols": cols})


def _blocks(tokens: DataFrame, keys: list[str], size: int) -> DataFrame:
    item = F.struct("pos", "vec")
    grouped = tokens.groupBy(*keys, piece_of("pos", size).alias("block")).agg(
        F.array_sort(F.collect_list(item)).alias("items"))
    return grouped.select(
        *keys, "block",
        F.transform("items", lambda x: x["pos"]).alias("pos"), F.transform("items", lambda x: x["vec"]).alias("vecs"))


def embedding_match_scores(
    predicted: DataFrame, reference: DataFrame, key: str = "item_id", block: int = VECTOR_BLOCK, cell: int = CELL_BLOCKS,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Greedy cosine match of token vectors (item, pos, vec): precision, recall, F1 per item, and per value of the predicted side's ``by``.

    Vectors travel in blocks of at most ``block`` and are matched by matrix
    products; single vector pairs are never rows. The blocks of an item meet in a grid with as many
    cells as the item needs: a cell has ``cell`` blocks of either side, so no task grows with an item.
    """
    def side_of(blocks: DataFrame, keys: list[str], own: str, other: str, place: str) -> DataFrame:
        """Blocks in their own line of the grid, once for each line of the other side."""
        lines = F.explode(F.sequence(F.lit(0).cast("long"), piece_of("last", cell))).alias(other)
        return blocks.select(*keys, piece_of("block", cell).alias(own), lines, F.col("pos").alias(f"{place}p"), F.col("vecs").alias(f"{place}v"))

    last = lambda side: side.groupBy(key).agg(F.max(piece_of("pos", block)).alias("last"))
    p = side_of(_blocks(predicted, [key, *by], block).join(last(reference), key), [key, *by], "row", "col", "p")
    r = side_of(_blocks(reference, [key], block).join(last(predicted), key), [key], "col", "row", "r")
    met = p.join(r, [key, "row", "col"]).select(key, *by, "pp", "rp", _best_cosines("pv", "rv").alias("best"))

    def side(name: str, pos: str, values: Column) -> Column:
        return F.transform(F.arrays_zip(F.col(pos).alias("i"), values.alias("v")),
                           lambda x: F.struct(F.lit(name).alias("_side"), x["i"].alias("i"), x["v"].alias("v")))

    both = F.concat(side("p", "pp", F.col("best.rows")), side("r", "rp", F.col("best.cols")))
    per_token = met.select(key, *by, F.inline(both)).groupBy(key, *by, "_side", "i").agg(F.max("v").alias("v"))
    per_item = per_token.groupBy(key, *by).agg(
        F.avg(F.when(F.col("_side") == "p", F.col("v"))).alias("precision"),
        F.avg(F.when(F.col("_side") == "r", F.col("v"))).alias("recall"))
    total = F.col("precision") + F.col("recall")
    f1 = F.when(total != 0, 2 * F.col("precision") * F.col("recall") / F.nullif(total, F.lit(0.0)))
    return per_item.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def embedding_match(predicted: DataFrame, reference: DataFrame, key: str = "item_id", by: tuple[str, ...] = ()) -> DataFrame:
    return embedding_match_scores(predicted, reference, key, by=by).groupBy(*by).agg(F.avg("f1").alias("bertscore"))


# --- several models at once --------------------------------------------------

def quality_by(
    rows: DataFrame, by: list[str], aggregates: list[Column], metrics: list[str], token_vectors: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """One row per group of ``rows (prediction, reference, ...)``: the named metrics and the caller's ``aggregates``, from one scan.

    BLEU comes from twelve sums and ROUGE-L from a mean, which stand beside the aggregates; rows without a reference count for these
    only. Token vectors ``(predicted with by, reference)`` are matched once for all groups. ``rows`` is read once.
    """
    per_row, sums = {}, []
    if "bleu" in metrics:
        per_row["_grams"] = _grams("prediction", "reference")
        sums += [c.alias(n) for n, c in _gram_sums("_grams").items()]
    if "rouge" in metrics:
        p, r = rouge_tokens("prediction"), rouge_tokens("reference")
        score = _f_measure(F.size(p), F.size(r), _common_stemmed(p, r))
        per_row["_rouge"] = F.when(F.col("prediction").isNotNull() & F.col("reference").isNotNull(), score)
        sums.append(F.coalesce(F.avg("_rouge"), F.lit(0.0)).alias("rouge"))
    grouped = rows.withColumns(per_row).groupBy(*by).agg(*sums, *aggregates) if per_row else rows.groupBy(*by).agg(*aggregates)
    names = [c for c in grouped.columns if c not in by and not c.startswith(("matched_", "total_")) and c != "rouge"]
    wide = grouped.withColumn("bleu", _bleu_of_sums()) if "bleu" in metrics else grouped
    if "bertscore" in metrics:
        match = embedding_match(*_need(token_vectors), by=tuple(by))
        wide = wide.join(match, by, "left") if by else wide.join(match)
    return wide.select(*by, *[m for m in METRICS if m in metrics], *names)


# --- selection -------------------------------------------------------------

METRICS: dict[str, Callable[..., DataFrame]] = {
    "bleu": lambda pairs, **_: corpus_bleu(pairs),
    "rouge": lambda pairs, **_: rouge_l(pairs),
    "bertscore": lambda pairs, token_vectors=None, **_: embedding_match(*_need(token_vectors)),
}


def _need(token_vectors):
    if token_vectors is None:
        raise ValueError("bertscore needs token_vectors=(predicted, reference)")
    return token_vectors


def chosen_metrics(metrics: list[str] | None, token_vectors: tuple[DataFrame, DataFrame] | None) -> list[str]:
    """The named metrics, or all that the given inputs allow; a name that is unknown or lacks its vectors raises."""
    names = [m for m in METRICS if m != "bertscore" or token_vectors is not None] if metrics is None else metrics
    if unknown := [m for m in names if m not in METRICS]:
        raise ValueError(f"unknown metric: {unknown[0]}")
    if "bertscore" in names:
        _need(token_vectors)
    return names


def compute_all(
    pairs: DataFrame, metrics: list[str] | None = None, token_vectors: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """(metric, value) rows of the named metrics; all three by default."""
    names = metrics or list(METRICS)
    unknown = [m for m in names if m not in METRICS]
    if unknown:
        raise ValueError(f"unknown metric: {unknown[0]}")
    tables = [
        METRICS[m](pairs, token_vectors=token_vectors).select(F.lit(m).alias("metric"), F.col(m).alias("value"))
        for m in names
    ]
    return reduce(lambda a, b: a.unionByName(b), tables)


def perplexity(positions: DataFrame, logits: str = "logits", label: str = "label") -> DataFrame:
    """exp of the mean cross-entropy over the positions whose label counts."""
    loss = F.avg(-token_logprob(F.col(logits), F.col(label)))
    return positions.where(F.col(label) != IGNORED_LABEL).agg(F.exp(loss).alias("perplexity"), loss.alias("loss"))
