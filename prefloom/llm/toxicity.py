"""Toxic documents by multiple-instance learning: sentence scores, joined by noisy-or, are trained from document labels.

A document is toxic if one of its sentences is: ``score = 1 - (1 - leak) * prod(1 - p_s)`` with ``p_s`` a logistic score of the words of
sentence s. Labels are known for documents only; the gradient of their likelihood passes through the noisy-or to the sentences, which is
what locates the offending ones. The leak is the chance of a label that no sentence explains: without it wrong labels would be laid on
every sentence, and long clean documents would add up to toxic ones. Words are runs of letters, digits and bytes over 0x7F with A-Z folded; sentences end at ``. ! ?`` and line ends.

Besides whole words their beginnings are weighed: an inflected or compound word is rare in every one of its forms, its beginning is not.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from prefloom.llm.batches import give_back
from prefloom.llm.words import mix, word_slices
from prefloom.sources.scratch import written

_BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_STOP = np.zeros(256, bool)
_STOP[[10, 13, 33, 46, 63]] = True
#: Bounds of the fit: labelled documents it reads, words it weighs, and passes over the sample.
SAMPLE_DOCS, FEATURES, PASSES = 20_000, 4096, 60
#: Bytes of the beginning of a longer word.
BEGINNING = 5
SENTENCES = "array<struct<start long, end long, score double>>"
_SENTENCES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


@dataclass(frozen=True)
class ToxicModel:
    """Sorted hashes of words and beginnings, their weights, the log-odds of a sentence without any of them, and those of a document without sentences."""

    words: np.ndarray
    weights: np.ndarray
    bias: float
    leak: float

    def features(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes have a weight, and their numbers."""
        if not len(self.words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = np.flatnonzero(self.words[at] == hashes)
        return known, at[known]


def _terms(words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, then of the beginnings of the longer ones, and the word of each."""
    n, longer = len(words.starts), np.flatnonzero(words.ends - words.starts > BEGINNING)
    begun = words.starts[longer]
    hashes = replace(words, starts=np.concatenate([words.starts, begun]), ends=np.concatenate([words.ends, begun + BEGINNING])).hashes(True)
    hashes[n:] = mix(hashes[n:] + np.uint64(1))  # apart from whole words
    return hashes, np.concatenate([np.arange(n), longer])


def _sentences(words) -> tuple[np.ndarray, np.ndarray]:
    """For every word the number of its sentence, counted over the slice, and for every sentence its text."""
    ended = np.cumsum(_STOP[words.raw], dtype=np.int64)
    owner = words.owner()
    key = ended[words.starts] + owner
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    return np.cumsum(new) - 1, owner[new]


def _labelled(docs: DataFrame, labels: DataFrame, sample: int, key: str, text: str) -> DataFrame:
    """``(text, toxic)`` of at most ``sample`` labelled documents outside the held-out fold, chosen by a hash of their key."""
    fold = labels.select(F.col("doc_id").alias("k"), F.col("toxic")).filter("k is not null and toxic in (0, 1) and crc32(cast(k as string)) % 5 <> 0")
    chosen = fold.groupBy("k").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("k"), "k").limit(sample)
    # bounded by the sample's parameter
    return docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(chosen), "k").select("text", "toxic")


def _word_counts(batches):
    """Per part of the sample: in how many toxic and other texts each word or beginning occurs."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for words in word_slices(batch.column(0), blank=_BETWEEN):
            hashes, word = _terms(words)
            owner = words.owner()[word]
            order = np.lexsort((owner, hashes))
            hashes, owner = hashes[order], owner[order]
            once = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]) if len(hashes) else np.zeros(0, bool)
            hashes, bad = hashes[once], toxic[words.first + owner[once]] == 1
            distinct, at = np.unique(hashes, return_inverse=True)
            yield pa.record_batch([pa.array(distinct.view(np.int64)), pa.array(np.bincount(at, bad, len(distinct)).astype(np.int64)),
                                   pa.array(np.bincount(at, ~bad, len(distinct)).astype(np.int64))], names=["word", "bad", "good"])


def _choose_words(sample: DataFrame, features: int) -> pd.DataFrame:
    """The words that point to toxic documents most surely: smoothed log-odds of 1 and three times their deviation at least."""
    n_bad, n_good = (sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first())
    counts = sample.mapInArrow(_word_counts, "word long, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (n_bad - F.col("bad") + 0.5)) - F.log((F.col("good") + 0.5) / (n_good - F.col("good") + 0.5))
    spread = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    return (counts.filter("bad + good >= 5").select("word", odds.alias("odds"), (odds / spread).alias("z"))
            .filter("odds >= 1 and z >= 3").orderBy(F.desc("z"), "word").limit(features).toPandas())


def _packed(model: ToxicModel):
    def run(batches):
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for words in word_slices(batch.column(0), blank=_BETWEEN):
                sentence, text = _sentences(words)
                hashes, word = _terms(words)
                known, feature = model.features(hashes)
                cells = [feature.astype(np.int32), sentence[word[known]].astype(np.int32), text.astype(np.int32), toxic[words.first:words.first + len(words)].astype(np.int32)]
                yield pa.record_batch([pa.array([c.tobytes()], pa.binary()) for c in cells], names=["feature", "sentence", "text", "toxic"])

    return run


def _log_rest(z: np.ndarray) -> np.ndarray:
    """log(1 - sigmoid(z))."""
    return -np.logaddexp(0, z)


def _gradient(weights: np.ndarray, bias: float, leak: float):
    """Sums over a part of the sample: the gradient of the documents' negative log-likelihood, and their number."""

    def run(frames):
        total, slope, leaking, n = np.zeros(len(weights)), 0.0, 0.0, 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                feature, sentence, text, toxic = (np.frombuffer(b, np.int32) for b in row)
                z = bias + np.bincount(sentence, weights[feature], len(text))
                clean = _log_rest(leak) + np.bincount(text, _log_rest(z), len(toxic))  # log of the product of 1 - p
                clean = np.minimum(clean, -1e-12)
                seen = np.where(toxic == 1, -np.exp(clean) / -np.expm1(clean), 1.0)
                pull = seen[text] * np.exp(-np.logaddexp(0, -z))
                total += np.bincount(feature, pull[sentence], len(weights))
                slope += pull.sum()
                leaking += seen.sum() * np.exp(-np.logaddexp(0, -leak))
                n += len(toxic)
        yield pd.DataFrame({"gradient": [total.tobytes()], "slope": [slope], "leaking": [leaking], "n": [n]})

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, features: int = FEATURES, passes: int = PASSES,
                 key: str = "doc_id", text: str = "text") -> ToxicModel:
    """Fit on at most ``sample`` labelled documents whose ``crc32(key) mod 5`` is not 0; only their text and label are read.

    Every pass sums the gradient over the parts of the packed sample; the driver holds the weights alone. Without labelled documents, or with
    one label only, all documents score alike. Labels for unknown documents and null labels are left out; of several labels the larger counts.
    """
    rows = written(_labelled(docs, labels, sample, key, text), "toxic-sample")
    chosen = _choose_words(rows, features).sort_values("word", key=lambda w: w.to_numpy().view(np.uint64) if len(w) else w)
    words = chosen["word"].to_numpy().astype(np.int64).view(np.uint64)
    model = ToxicModel(words, np.zeros(len(words)), 0.0, 0.0)
    packed = written(rows.mapInArrow(_packed(model), "feature binary, sentence binary, text binary, toxic binary"), "toxic-packed")
    weights, bias, leak = np.minimum(chosen["odds"].to_numpy(float), 4) if len(words) else np.zeros(0), -6.0 if len(words) else -40.0, -3.0
    first, second, rate, decay = np.zeros(len(words) + 2), np.zeros(len(words) + 2), 0.15, 1e-4
    for k in range(1, passes + 1):
        parts = packed.mapInPandas(_gradient(weights, bias, leak), "gradient binary, slope double, leaking double, n long").collect()
        n = sum(p["n"] for p in parts)
        if not n:
            break
        slope = np.append(sum(np.frombuffer(p["gradient"]) for p in parts), [sum(p["slope"] for p in parts), sum(p["leaking"] for p in parts)]) / n
        slope[:-2] += decay * weights
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        change = rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-6)
        weights, bias, leak = weights - change[:-2], bias - change[-2], leak - change[-1]
    return ToxicModel(words, weights, float(bias), float(leak))


def _scored(model: ToxicModel, column: pa.Array):
    """Slices of whole texts: their words, the score of every text, and of every sentence its number, text and log-odds."""
    for words in word_slices(column, blank=_BETWEEN):
        sentence, text_of = _sentences(words)
        hashes, word = _terms(words)
        known, feature = model.features(hashes)
        z = model.bias + np.bincount(sentence[word[known]], model.weights[feature], len(text_of))
        clean = _log_rest(model.leak) + np.bincount(text_of, _log_rest(z), len(words))
        yield words, -np.expm1(clean), sentence, text_of, z


def _spans(words, sentence: np.ndarray, text_of: np.ndarray, z: np.ndarray, threshold: float) -> list[list[dict]]:
    """Per text its sentences that reach the threshold on their own."""
    spans, chance = [[] for _ in range(len(words))], np.exp(-np.logaddexp(0, -z))
    if len(bad := np.flatnonzero(chance >= threshold)):
        letters = np.concatenate([[0], np.cumsum((words.raw & 0xC0) != 0x80)])
        opening, closing = np.searchsorted(sentence, bad), np.searchsorted(sentence, bad, "right") - 1
        for k, a, b in zip(bad.tolist(), words.starts[opening].tolist(), words.ends[closing].tolist()):
            base = letters[words.text_starts[text_of[k]]]
            spans[text_of[k]].append({"start": int(letters[a] - base), "end": int(letters[b] - base), "score": float(chance[k])})
    return spans


def score_toxicity(docs: DataFrame, model: ToxicModel, threshold: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score double, sentences array<struct<start, end, score>>)``: the chance that a document is toxic, and the code points of its
    sentences that reach ``threshold`` on their own.

    Only the key and the text are read. Null and empty texts score the leak alone; repeated rows are kept; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for words, scores, *sentences in _scored(shared.value, batch.column(1)):
                yield pa.record_batch([batch.column(0).slice(words.first, len(words)), pa.array(scores), pa.array(_spans(words, *sentences, threshold), _SENTENCES)],
                                      names=["key", "score", "sentences"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, score double, sentences {SENTENCES}").withColumnRenamed("key", key)


def without_toxic(docs: DataFrame, model: ToxicModel, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that score under ``threshold``; rows with a null or empty text stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                for words, scores, *_ in _scored(shared.value, part.column(at)):
                    empty = np.diff(words.text_starts) == 0
                    yield part.slice(words.first, len(words)).filter(pa.array((scores < threshold) | empty))
                give_back()

    return docs.mapInArrow(run, docs.schema)
