"""Document quality by a sparse ensemble of rules over text statistics.

Shallow trees are grown on a bounded sample of labelled documents. Every path from a root to a node is a rule: a conjunction of bounds on
statistics, true or false for a document. A logistic regression with a lasso penalty weighs the rules and sets most weights to zero;
what is left is compiled into one Spark column expression over the statistics.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from prefloom.llm.words import Words, word_slices
from prefloom.operators.newton import logistic_point
from prefloom.sources.scratch import written

#: Bounds of the fit: labelled documents that it reads, trees, bounds in a rule, and passes; and the lasso penalty.
SAMPLE_DOCS, TREES, DEPTH, PASSES, PENALTY = 20_000, 30, 3, 40, 1e-3

#: Statistics of a whole text that do not depend on its language; shares are of its characters, words or lines.
STATISTICS = ["log_chars", "log_words", "word_length", "line_length", "distinct_words", "distinct_lines", "upper", "digits", "stops", "cries", "symbols", "stopped_lines"]
_CLASSES = ["upper", "digits", "stops", "cries", "symbols"]
_BREAK = np.zeros(256, bool)
_BREAK[[10, 13]] = True

#: A rule: for each statistic in it the bound that it must exceed and the one that it must not exceed (None: no bound).
Rule = tuple[tuple[str, float | None, float | None], ...]


@lru_cache(1)
def _class_of() -> np.ndarray:
    """For every code point the place of its class in ``_CLASSES``, from the categories of Unicode; others have the next number."""
    classes = np.full(sys.maxunicode + 1, len(_CLASSES), np.uint8)
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))
        if kind == "Lu":
            classes[code] = 0
        elif kind[0] == "N":
            classes[code] = 1
        elif kind[0] in "PS":
            classes[code] = 4
    for place, chars in ((2, ".,;:"), (3, "!?"), (len(_CLASSES), "'\"()-")):
        classes[[ord(c) for c in chars]] = place
    return classes


def _distinct(words: Words) -> np.ndarray:
    """Distinct words of each text."""
    order = np.lexsort((hashes := words.hashes(False), owner := words.owner()))
    hashes, owner = hashes[order], owner[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]) if len(owner) else np.zeros(0, bool)
    return np.bincount(owner[new], minlength=len(words))


def text_statistics(column: pa.Array):
    """Slices of a text column, ``(first, statistics)``: one array for each of ``STATISTICS``; null texts count as empty."""
    for words, lines in zip(word_slices(column), word_slices(column, blank=_BREAK)):
        letters = np.concatenate([[0], np.cumsum((words.raw & 0xC0) != 0x80)])[words.text_starts]
        codes = np.frombuffer(words.raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        kinds, chars = _class_of()[codes], np.diff(letters)
        share = lambda count, of: count / np.maximum(of, 1)
        n_words, n_lines = np.diff(words.bounds), np.diff(lines.bounds)
        out = {"log_chars": np.log1p(chars), "log_words": np.log1p(n_words), "word_length": share(chars, n_words), "line_length": share(chars, n_lines),
               "distinct_words": share(_distinct(words), n_words), "distinct_lines": share(_distinct(lines), n_lines)}
        for place, name in enumerate(_CLASSES):
            out[name] = share(np.diff(np.concatenate([[0], np.cumsum(kinds == place)])[letters]), chars)
        stopped = np.isin(lines.raw[lines.ends - 1], [33, 46, 63])
        out["stopped_lines"] = share(np.bincount(lines.owner()[stopped], minlength=len(lines)), n_lines)
        yield words.first, [out[name] for name in STATISTICS]


def with_statistics(df: DataFrame, text: str) -> DataFrame:
    """``df`` with its text replaced by a column for each of ``STATISTICS``."""
    kept = [c for c in df.columns if c != text]

    def run(batches):
        for batch in batches:
            for first, values in text_statistics(batch.column(len(kept))):
                own = batch.slice(first, len(values[0]))
                yield pa.record_batch([*own.columns[:-1], *map(pa.array, values)], names=[*kept, *STATISTICS])

    shape = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), *(f"{n} double" for n in STATISTICS)])
    return df.select(*kept, text).mapInArrow(run, shape)


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules and the log-odds of a document for which none holds."""

    rules: tuple[tuple[Rule, float], ...]
    bias: float

    def score(self) -> Column:
        """The chance of good quality, as an expression over columns named as the statistics."""
        odds = reduce(lambda z, r: z + F.when(rule_column(r[0]), r[1]).otherwise(0.0), self.rules, F.lit(float(self.bias)))
        return 1 / (1 + F.exp(-odds))


def rule_column(rule: Rule) -> Column:
    """Whether all bounds of a rule hold."""
    parts = [F.col(name) > low for name, low, _ in rule if low is not None] + [F.col(name) <= high for name, _, high in rule if high is not None]
    return reduce(lambda a, b: a & b, parts)


def _paths(node, names: list[str], bounds: dict[str, tuple[float | None, float | None]]) -> list[Rule]:
    """The rules of all nodes below a node of a fitted tree."""
    if node.numDescendants() == 0:
        return []
    split, out = node.split(), []
    name, at = names[split.featureIndex()], float(split.threshold())
    low, high = bounds.get(name, (None, None))
    for child, own in ((node.leftChild(), (low, at if high is None else min(at, high))), (node.rightChild(), (at if low is None else max(at, low), high))):
        below = {**bounds, name: own}
        out += [tuple((n, *below[n]) for n in names if n in below), *_paths(child, names, below)]
    return out


def extract_rules(forest, names: list[str]) -> list[Rule]:
    """The distinct rules of a fitted forest, in a fixed order."""
    found = {rule for tree in forest.trees for rule in _paths(tree._java_obj.rootNode(), names, {})}
    return sorted(found, key=repr)


def _labelled(docs: DataFrame, labels: DataFrame, sample: int, key: str, text: str) -> DataFrame:
    """Statistics and ``good`` of at most ``sample`` labelled documents outside the held-out fold, chosen by a hash of their key."""
    fold = labels.select(F.col("doc_id").alias("k"), F.col("quality").alias("good")).filter(
        "k is not null and good in (0, 1) and crc32(cast(k as string)) % 4 <> 2")
    chosen = fold.groupBy("k").agg(F.min("good").cast("double").alias("good")).orderBy(F.xxhash64("k"), "k").limit(sample)
    # bounded by the sample's parameter
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(chosen), "k")
    one = with_statistics(rows, "text").groupBy("k", "good").agg(F.min(F.struct(*STATISTICS)).alias("s"))
    return one.select("k", "good", "s.*").repartitionByRange(4, "k").sortWithinPartitions("k").drop("k")


def _shrunk(w: np.ndarray, gradient: np.ndarray, gram: np.ndarray, penalty: float) -> np.ndarray:
    """Weights that minimize the quadratic model around ``w`` plus ``penalty`` times the absolute weights but the first, by coordinates."""
    new, slope, curve = w.copy(), gradient.copy(), np.diag(gram) + 1e-12
    for _ in range(300):
        most = 0.0
        for j in range(len(w)):
            free = new[j] - slope[j] / curve[j]
            value = free if j == 0 else math.copysign(max(abs(free) - penalty / curve[j], 0.0), free)
            if change := value - new[j]:
                slope += gram[:, j] * change
                new[j] = value
                most = max(most, abs(change) * curve[j] ** 0.5)
        if most < 1e-7:
            break
    return new


def fit_lasso(rows: DataFrame, column: str, size: int, penalty: float, tasks: int, passes: int = PASSES) -> np.ndarray:
    """Weights that minimize the mean of ``log(1 + exp(-w . d))`` plus ``penalty`` times the absolute weights but the first.

    Every pass sums gradient and Gram matrix over the rows; the driver solves the penalized quadratic model and halves steps that do not descend.
    """
    cost = lambda p: p.loss + penalty * float(np.abs(p.weights[1:]).sum())
    best, done = logistic_point(rows, column, np.zeros(size), 0.0, tasks), 1
    while done < passes:
        target, share, found = _shrunk(best.weights, best.gradient, best.gram, penalty), 1.0, None
        while found is None and done < passes and share > 1e-4:
            w = target if share == 1.0 else best.weights + share * (target - best.weights)
            point, done, share = logistic_point(rows, column, w, 0.0, tasks), done + 1, share / 2
            found = point if cost(point) < cost(best) else None
        if found is None or cost(best) - cost(found) < 1e-7:
            return (found or best).weights
        best = found
    return best.weights


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY,
                key: str = "doc_id", text: str = "text") -> RuleModel:
    """Fit on at most ``sample`` labelled documents whose ``crc32(key) mod 4`` is not 2; only their text and ``quality`` are read.

    Labels for unknown documents and labels other than 0 and 1 are left out; of several labels the smaller counts, and of several texts
    under one key the one with the smallest statistics. Without labelled documents all score one half, with one label only all score alike.
    """
    rows = written(_labelled(docs, labels, sample, key, text), "quality-sample")
    n, good = rows.agg(F.count("*"), F.coalesce(F.sum("good"), F.lit(0.0))).first()
    odds = math.log((good + 0.5) / (n - good + 0.5))
    if not 0 < good < n:
        return RuleModel((), odds)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, labelCol="good", featuresCol="x", featureSubsetStrategy="onethird")
    rules = extract_rules(forest.fit(rows.select("good", array_to_vector(F.array(*STATISTICS)).alias("x"))), STATISTICS)
    if not rules:
        return RuleModel((), odds)
    signed = F.transform(F.array(F.lit(1.0), *[rule_column(r).cast("double") for r in rules]), lambda x: x * (2 * F.col("good") - 1))
    held = written(rows.select(signed.alias("d")), "quality-rules")
    weights = fit_lasso(held, "d", 1 + len(rules), penalty, tasks=4)
    return RuleModel(tuple((r, float(w)) for r, w in zip(rules, weights[1:]) if w), float(weights[0]))


def score_quality(docs: DataFrame, model: RuleModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score double, rules int)``: the chance of good quality, and how many weighted rules hold.

    Only the key and the text are read; whole texts count. Null and empty texts have the statistics of an empty text; repeated rows are
    kept; an empty table gives no rows.
    """
    rows = with_statistics(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text")
    held = reduce(lambda a, b: a + b, [rule_column(r).cast("int") for r, _ in model.rules], F.lit(0))
    return rows.select(F.col("key").alias(key), model.score().alias("score"), held.alias("rules"))
