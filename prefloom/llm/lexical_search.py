"""Ranked lexical search with document FP-trees.

A term is a run of letters, digits and characters over 0x7F with A-Z folded. Texts are read once: every document becomes its vector of
item terms, which is written. A task packs its vectors into trees: terms ordered by falling document frequency, so that documents share
the path of their common terms, and every node knows the largest tf of each term and the smallest length norm below it. Both bound the
score of any document below from above, as the score rises with tf and falls with the norm; the depth-first walk leaves out what cannot
reach an item's first places. Items walk together, each with its own threshold, and drop out one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from prefloom.llm.words import word_slices
from prefloom.sources.scratch import written

_BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: (item, term) entries of the items that one pass over the vectors serves; more items go to further passes.
BLOCK_TERMS = 200_000
#: Documents in an unsplit node, and (document, term) entries in a tree.
LEAF, TREE_ENTRIES = 16, 1 << 21


@dataclass(frozen=True)
class Items:
    """Items with at least one term: their keys, and for each its distinct terms as places in the sorted hashes of all terms."""

    keys: list
    vocabulary: np.ndarray
    terms: np.ndarray
    starts: np.ndarray

    @staticmethod
    def of(rows: list[tuple[object, np.ndarray]]) -> Items:
        vocabulary, terms = np.unique(np.concatenate([t for _, t in rows]), return_inverse=True)
        return Items([k for k, _ in rows], vocabulary, terms, np.cumsum([0] + [len(t) for _, t in rows])[:-1])


def _item_blocks(items: DataFrame, key: str, text: str, most: int) -> Iterator[Items]:
    """Distinct items in blocks of about ``most`` (item, term) entries; the driver holds one block at a time."""
    rows, held = [], 0
    for row in items.select(F.col(key).alias("k"), F.col(text).alias("t")).distinct().toLocalIterator():
        terms = [np.unique(w.hashes(True)) for w in word_slices(pa.array([row.t], pa.string()), blank=_BETWEEN)][0]
        if len(terms):
            rows.append((row.k, terms))
            held += len(terms)
        if held >= most:
            yield Items.of(rows)
            rows, held = [], 0
    if rows:
        yield Items.of(rows)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """32-bit values packed to one binary per document."""
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * 4).astype(np.int64)), pa.py_buffer(values.astype(np.int32))])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of packed documents and the places where each begins."""
    bounds = np.concatenate([[0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)]) // 4
    return np.frombuffer(b"".join(column.to_pylist()), np.int32), bounds


def _vectors(vocabulary: np.ndarray):
    def run(batches):
        for batch in batches:
            for words in word_slices(batch.column(1), blank=_BETWEEN):
                hashes = words.hashes(True)
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                known = np.flatnonzero(vocabulary[at] == hashes)
                cells, tf = np.unique(words.owner()[known] * len(vocabulary) + at[known], return_counts=True)
                bounds = np.searchsorted(cells, np.arange(len(words) + 1) * len(vocabulary))
                n = np.diff(words.bounds)
                out = pa.record_batch([batch.column(0).slice(words.first, len(words)), pa.array(n), _lists(cells % len(vocabulary), bounds), _lists(tf, bounds)],
                                      names=["key", "n", "terms", "tf"])
                yield out.filter(pa.array(n > 0))

    return run


def _frequencies(size: int):
    def run(batches):
        found = np.zeros(size, np.int64)
        for batch in batches:
            found += np.bincount(_flat(batch.column(0))[0], minlength=size)
        term = np.flatnonzero(found)
        yield pa.record_batch([pa.array(term.astype(np.int64)), pa.array(found[term])], names=["term", "df"])

    return run


def _maxima(terms: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms and the largest tf of each."""
    order = np.argsort(terms, kind="stable")
    terms = terms[order]
    first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    return terms[first], np.maximum.reduceat(tf[order], first)


class DocumentTree:
    """Documents by their paths of ranked terms. A node is a range of documents in path order; a node of up to ``LEAF`` documents, or of
    equal paths, has no inner paths. ``place`` orders documents for ties."""

    def __init__(self, bounds: np.ndarray, ranks: np.ndarray, tf: np.ndarray, norm: np.ndarray, place: np.ndarray) -> None:
        data, at = ranks.astype(">u4").tobytes(), (bounds * 4).tolist()
        path = [data[a:b] for a, b in zip(at, at[1:])]
        self.order = np.array(sorted(range(len(path)), key=path.__getitem__), np.int64)
        lengths = np.diff(bounds)[self.order]
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        entry = np.repeat(bounds[self.order] - self.bounds[:-1], lengths) + np.arange(self.bounds[-1])
        self.ranks, self.tf, self.norm, self.place = ranks[entry], tf[entry], norm[self.order], place[self.order]
        self.ranges, self.children = [(0, len(path))], []
        while len(self.children) < len(self.ranges):
            parts = self._parts(*self.ranges[len(self.children)])
            self.children.append(range(len(self.ranges), len(self.ranges) + len(parts)))
            self.ranges += parts
        self.terms, self.most = [None] * len(self.ranges), [None] * len(self.ranges)
        for node in range(len(self.ranges) - 1, -1, -1):  # children come after their parent
            if own := self.children[node]:
                self.terms[node], self.most[node] = _maxima(np.concatenate([self.terms[c] for c in own]), np.concatenate([self.most[c] for c in own]))
            else:
                a, b = self.bounds[list(self.ranges[node])]
                self.terms[node], self.most[node] = _maxima(self.ranks[a:b], self.tf[a:b])
        self.least = np.array([self.norm[a:b].min() for a, b in self.ranges])
        self.first_place = np.array([self.place[a:b].min() for a, b in self.ranges])

    def _parts(self, first: int, last: int) -> list[tuple[int, int]]:
        """The ranges below the shared path of a range, neighbours of few documents taken together."""
        if last - first <= LEAF:
            return []
        a, b = (self.ranks[self.bounds[d]:self.bounds[d + 1]] for d in (first, last - 1))
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        depth = int(differ[0]) if len(differ) else n
        longer = np.diff(self.bounds[first:last + 1]) > depth
        following = np.full(last - first, -1, np.int64)
        following[longer] = self.ranks[self.bounds[first:last][longer] + depth]
        if (following[0] == following).all():  # equal paths
            cuts = list(range(first, last, LEAF)) + [last]
            return list(zip(cuts, cuts[1:]))
        cuts = [first, *(first + 1 + np.flatnonzero(following[1:] != following[:-1])).tolist(), last]
        parts = []
        for part in zip(cuts, cuts[1:]):
            if parts and part[1] - parts[-1][0] <= LEAF:
                parts[-1] = (parts[-1][0], part[1])
            else:
                parts.append(part)
        return parts


def _gain(tf: np.ndarray, norm) -> np.ndarray:
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * norm)


class _Walk:
    """The best ``k`` documents of a tree for every item that reach the item's floor."""

    def __init__(self, tree: DocumentTree, terms: np.ndarray, starts: np.ndarray, weights: np.ndarray, floor: np.ndarray, k: int) -> None:
        self.tree, self.weights, self.floor = tree, weights, floor
        self.scores, self.docs = np.zeros((len(starts), k), np.int64), np.full((len(starts), k), -1, np.int64)
        self.places = np.full((len(starts), k), np.iinfo(np.int64).max)
        self.dense = np.zeros((LEAF, len(weights)), np.int64)
        self.visited = 0
        every = (np.arange(len(starts)), terms, starts)
        stack = [(0, self._bounds(0, every), every)]
        while stack:
            node, bounds, active = stack.pop()
            active, bounds = self._open(node, bounds, active)
            if not len(active[0]):
                continue
            self.visited += 1
            if own := tree.children[node]:
                below = sorted(((c, self._bounds(c, active)) for c in own), key=lambda x: int(x[1].sum()))
                stack += [(c, b, active) for c, b in below]  # the most promising last, to come first
            else:
                self._leaf(node, active)

    def _open(self, node: int, bounds: np.ndarray, active):
        """The items for which a document below can still get a place."""
        items, terms, starts = active
        last = self.scores[items, -1]
        keep = (bounds >= self.floor[items]) & ((bounds > last) | ((bounds == last) & (self.tree.first_place[node] < self.places[items, -1])))
        if keep.all():
            return active, bounds
        lengths = np.diff(np.append(starts, len(terms)))
        return (items[keep], terms[np.repeat(keep, lengths)], np.cumsum(np.append(0, lengths[keep]))[:-1]), bounds[keep]

    def _bounds(self, node: int, active) -> np.ndarray:
        terms, row = self.tree.terms[node], self.dense[0]
        row[terms] = _gain(self.tree.most[node], self.tree.least[node]) * self.weights[terms]
        out = np.add.reduceat(row[active[1]], active[2])
        row[terms] = 0
        return out

    def _leaf(self, node: int, active) -> None:
        tree, (first, last) = self.tree, self.tree.ranges[node]
        items, terms, starts = active
        a, b = tree.bounds[first], tree.bounds[last]
        doc = np.repeat(np.arange(last - first), np.diff(tree.bounds[first:last + 1]))
        self.dense[doc, tree.ranks[a:b]] = _gain(tree.tf[a:b], tree.norm[first:last][doc]) * self.weights[tree.ranks[a:b]]
        found = np.add.reduceat(self.dense[:last - first, terms], starts, axis=1).T
        self.dense[doc, tree.ranks[a:b]] = 0
        better = np.flatnonzero((found >= np.maximum(self.scores[items, -1], self.floor[items])[:, None]).any(1))
        rows = items[better]
        spread = lambda x: np.broadcast_to(x, (len(rows), last - first))
        scores = np.concatenate([self.scores[rows], found[better]], 1)
        docs = np.concatenate([self.docs[rows], spread(tree.order[first:last])], 1)
        places = np.concatenate([self.places[rows], spread(tree.place[first:last])], 1)
        best = np.lexsort((places, -scores), axis=-1)[:, :self.scores.shape[1]]
        self.scores[rows], self.docs[rows], self.places[rows] = (np.take_along_axis(x, best, 1) for x in (scores, docs, places))


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of vectors in runs of at most ``TREE_ENTRIES`` entries, or one document."""
    ends = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False)) // 4
    at = 0
    while at < len(ends):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TREE_ENTRIES, "right")))
        yield batch.slice(at, end - at)
        at = end


def _search(items: Items, weights: np.ndarray, rank: np.ndarray, n_docs: int, n_terms: int, k: int):
    by_rank = np.empty(len(weights), np.int64)
    by_rank[rank] = weights
    item_terms = rank[items.terms]

    def run(batches):
        floor = np.ones(len(items.keys), np.int64)  # scores of 0 get no place
        for batch in batches:
            for part in _runs(batch):
                part = part.filter(pc.greater(pc.binary_length(part.column(2)), 0))
                if not part.num_rows:
                    continue
                (terms, bounds), (tf, _) = _flat(part.column(2)), _flat(part.column(3))
                doc = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                order = np.argsort(doc * len(weights) + rank[terms])
                norm = 10 + (90 * part.column(1).to_numpy(zero_copy_only=False).astype(np.int64) * n_docs) // n_terms
                place = np.empty(part.num_rows, np.int64)
                place[pc.sort_indices(part.column(0), null_placement="at_start").to_numpy()] = np.arange(part.num_rows)
                walk = _Walk(DocumentTree(bounds, rank[terms][order], tf[order], norm, place), item_terms, items.starts, by_rank, floor, k)
                item, at = np.nonzero((walk.docs >= 0) & (walk.scores >= floor[:, None]))
                floor = np.maximum(floor, walk.scores[:, -1])
                yield pa.record_batch([pa.array(item.astype(np.int32)), part.column(0).take(pa.array(walk.docs[item, at])), pa.array(walk.scores[item, at])],
                                      names=["item", "doc", "score"])

    return run


def search_items(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                 item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_key, rank int, key, score long)``: the ``k`` documents of the highest score above 0 for every item.

    With N documents of at least one term, L terms in them, n terms in a document and df documents of a term, a term weighs
    ``floor(1000 ln((2 N + 2) / (2 df + 1)))``, the norm is ``m = 10 + (90 n N) div L``, and a document scores
    ``sum(weight * ((10^9 tf) div (1000 tf + 8 m)))`` over the distinct terms of the item. All is exact in 64 bits.

    Only the named columns are read. Null and empty texts have no terms: such documents do not count and are in no result, such items
    have no rows. Equal scores rank by rising key, a null key first; every row is a document of its own, so repeated rows rank one after
    the other. Repeated items are one item; one key with two texts is ranked once for each. Empty tables give no rows.
    """
    spark, kinds = docs.sparkSession, (items.schema[item_key].dataType.simpleString(), docs.schema[key].dataType.simpleString())
    texts, found = docs.select(F.col(key).alias("key"), F.col(text).alias("text")), []
    for block in _item_blocks(items, item_key, item_text, block_terms):
        size = len(block.vocabulary)
        vectors = written(texts.mapInArrow(_vectors(block.vocabulary), f"key {kinds[1]}, n long, terms binary, tf binary"), "item-vectors")
        n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(size, np.int64)
        # as many rows as the block has terms
        for row in vectors.select("terms").mapInArrow(_frequencies(size), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[row.term] = row.df
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        rank = np.empty(size, np.int64)
        rank[np.argsort(-df, kind="stable")] = np.arange(size)
        best = written(vectors.mapInArrow(_search(block, weights, rank, n_docs, n_terms, k), f"item int, doc {kinds[1]}, score long"), "item-candidates")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(block.keys)), f"item int, item_key {kinds[0]}")
        found.append(ranked.join(F.broadcast(names), "item").select("item_key", "rank", "doc", "score"))  # one block of items
    out = spark.createDataFrame([], f"item_key {kinds[0]}, rank int, doc {kinds[1]}, score long") if not found else found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumnsRenamed({"item_key": item_key, "doc": key})
