"""Documents whose sets of word n-grams overlap: a similarity join over group counts, bounded by summed coordinate minima.

Each document's distinct n-grams are hashed into groups; the counts per group are its point. The overlap of two sets is at most the
sum of the coordinate minima of their points, and the overlap of all members of two boxes of points at most that of the boxes'
upper corners: trees of such boxes are joined top down, pairs of points that can still reach the threshold are verified on the sets.

One tree over all points cannot be cut: texts of like length have like counts, so boxes of unlike texts overlap, and on the given tables
nearly all pairs of boxes would be visited. So points meet only where their sets share n-grams of their prefix (sets of similarity t share l
of them among the first ``n - ceil(t n) + l`` in any common order); very frequent n-grams come last in that order. Points that share fewer
n-grams than any similar set would have in common with them, with others or with other components, go no further. Equal sets are one point.
Documents already known to be connected are not compared again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from prefloom.llm.batches import give_back, small_batches
from prefloom.llm.components import components
from prefloom.llm.keys import only_keys
from prefloom.llm.words import window_hashes, word_slices
from prefloom.sources.scratch import written

#: Groups of the count vector, points in a leaf of a tree, points on each side of one unit of work, and those of them joined at once.
GROUPS, LEAF, UNIT, RUN = 512, 32, 1024, 128
#: Groups of the finer counts of points that the first ones leave.
FINE = 4096
#: A prefix is longer by one n-gram for so many of its set, and as many more have to be shared.
SHARE = 40
#: Pairs in one unit of the verification of leader pairs on average, and bytes of the sets that are verified together.
TOGETHER, SET_BYTES = 1000, 4 << 20
#: N-grams kept as very frequent ones; the list only sets the order of prefixes, results do not depend on it.
FREQUENT = 1 << 17


def _sets(column: pa.Array, size: int):
    """For every text the sorted hashes of its distinct n-grams; of a text with fewer words, of its whole sequence."""
    for words in word_slices(column):
        hashes = words.hashes(True)
        runs = window_hashes(hashes, size)
        for k in range(len(words)):
            a, b = words.bounds[k], words.bounds[k + 1]
            if b - a >= size:
                yield words.first + k, np.unique(runs[a:b - size + 1])
            else:
                yield words.first + k, window_hashes(hashes[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64)


def _short(batches, rows: int = 1000):
    """Batches in runs of few rows, so that few sets are held at a time; what a run has taken is given back."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
            give_back()


def _frequent(size: int, local: int = 3, most: int = 8192, together: int = 1 << 19):
    """The most frequent n-grams of every run of texts, with the number of texts that hold them there."""

    def counted(own):
        grams, counts = np.unique(np.concatenate(own), return_counts=True)
        grams, counts = grams[counts >= local], counts[counts >= local]
        top = np.argsort(-counts, kind="stable")[:most]
        return pa.record_batch([pa.array(grams[top].view(np.int64)), pa.array(counts[top].astype(np.int64))], names=["gram", "n"])

    def run(batches):
        own, held = [], 0
        for batch in batches:
            for _, grams in _sets(batch.column(0), size):
                own.append(grams)
                held += len(grams)
                if held >= together:
                    yield counted(own)
                    own, held = [], 0
                    give_back()
        if own:
            yield counted(own)

    return run


def _least_shared(n: int, percent: int) -> int:
    """N-grams that the prefix of a set of size ``n`` shares with that of any similar set which is not smaller."""
    return min(1 + n // SHARE, (percent * n + 99) // 100)


def _enough(count: str, percent: int):
    """Whether ``count`` n-grams of a point's prefix are as many as it shares with a similar set, whose size is ``percent`` of its own at least."""
    other = f"((({percent} * n + 99) div 100))"
    return F.expr(f"{count} >= least(1 + {other} div {SHARE}, ({percent} * {other} + 99) div 100)")


def _packed(own: np.ndarray, groups: int) -> bytes:
    """Counts per group, cut at 255 to fit a byte, and what was cut off."""
    counts = np.bincount((own % np.uint64(groups)).astype(np.int64), minlength=groups)
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + np.int64(np.maximum(counts - 255, 0).sum()).tobytes()


def _points(size: int, percent: int, late):
    """Size, identity, group counts and prefix of every text's set."""

    def run(batches):
        frequent, rank = late.value
        for batch in _short(batches):
            rows, known = [], set()
            for _, own in _sets(batch.column(1), size):
                n = len(own)
                order = own
                if n and len(frequent):
                    at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
                    order = own[np.lexsort((own, np.where(frequent[at] == own, rank[at], 0)))]
                node = _identity(own)
                # of equal sets in a batch one carries the prefix
                prefix = order[:n - (percent * n + 99) // 100 + _least_shared(n, percent)].view(np.int64).copy() if n and node not in known else None
                known.add(node)
                rows.append((n, node, _packed(own, GROUPS), prefix))
            n, node, counts, prefix = zip(*rows) if rows else ((), (), (), ())
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(counts, pa.binary()),
                                   pa.array(prefix, pa.list_(pa.int64()))], names=["key", "n", "node", "counts", "prefix"])

    return run


def _identity(own: np.ndarray) -> int | None:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True) if len(own) else None


def _set_bytes(size: int):
    """The sets of the points, with the points' other columns; another text under the same key is left out."""

    def run(batches):
        for batch in _short(batches):
            own = [s for _, s in _sets(batch.column(1), size)]
            same = pa.array([_identity(s) == node for s, node in zip(own, batch.column(0).to_pylist())], pa.bool_())
            names = ["node", "members", *batch.schema.names[2:]]
            yield pa.record_batch([batch.column(0), pa.array([s.tobytes() for s in own], pa.binary()), *batch.columns[2:]], names=names).filter(same)

    return run


def _fine_counts(batches):
    for batch in _short(batches):
        counts = [_packed(np.frombuffer(m.as_buffer(), np.uint64), FINE) for m in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(counts, pa.binary())], names=["node", "counts"])


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The overlap from which sets of these sizes are similar: percent / (100 + percent) of both sizes, rounded up."""
    return (percent * (a + b) + 99 + percent) // (100 + percent)


def unpacked(counts, groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray]:
    """Counts per group, cut at 255 to fit a byte, and what was cut off: the overlap is at most the sum of the minima of all."""
    raw = np.frombuffer(b"".join(counts), np.uint8).reshape(-1, groups + 8)
    return raw[:, :groups], np.ascontiguousarray(raw[:, groups:]).view(np.int64)[:, 0]


def _most_shared(a: np.ndarray, b: np.ndarray, more: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.minimum(a, b).sum(1, dtype=np.int64) + np.minimum(more, other)


class _Tree:
    """Points packed into boxes, ``LEAF`` at a time, in the order of their size and counts; an inner box spans ``LEAF`` boxes below."""

    def __init__(self, points: np.ndarray, more: np.ndarray, sizes: np.ndarray) -> None:
        self.order = np.lexsort((points.argmax(1), sizes))
        self.upper, self.more = [points[self.order]], [more[self.order]]
        self.least, self.most = [sizes[self.order]], [sizes[self.order]]
        while len(self.upper[-1]) > 1:
            cut = np.arange(0, len(self.upper[-1]), LEAF)
            self.upper.append(np.maximum.reduceat(self.upper[-1], cut))
            self.more.append(np.maximum.reduceat(self.more[-1], cut))
            self.least.append(np.minimum.reduceat(self.least[-1], cut))
            self.most.append(np.maximum.reduceat(self.most[-1], cut))


def tree_pairs(left: _Tree, right: _Tree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of points of two trees whose summed minima reach the needed overlap; pairs of boxes that cannot are left out with all below."""
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    high, low = len(left.upper) - 1, len(right.upper) - 1
    step = max(1, 2000 * GROUPS // left.upper[0].shape[1])
    while len(a):
        keep = np.zeros(len(a), bool)
        for k in range(0, len(a), step):
            x, y = a[k:k + step], b[k:k + step]
            bound = _most_shared(left.upper[high][x], right.upper[low][y], left.more[high][x], right.more[low][y])
            bound = np.minimum(bound, np.minimum(left.most[high][x], right.most[low][y]))
            keep[k:k + step] = bound >= _needed(left.least[high][x], right.least[low][y], percent)
        a, b = a[keep], b[keep]
        if not high and not low:
            break
        if high >= low:
            a, b, high = *_below(a, b, len(left.upper[high - 1])), high - 1
        else:
            b, a, low = *_below(b, a, len(right.upper[low - 1])), low - 1
    return left.order[a], right.order[b]


def _below(boxes: np.ndarray, others: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    inner = (boxes[:, None] * LEAF + np.arange(LEAF)).reshape(-1)
    return inner[inner < n], np.repeat(others, LEAF)[inner < n]


def _apart(own: pd.DataFrame, points: np.ndarray, more: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a unit's points in different components that can still be similar, by a join of the trees of its two runs."""
    of, part = own["run"].to_numpy(), own["component"].to_numpy()
    u, v = own["u"].iat[0], own["v"].iat[0]
    one, two = np.flatnonzero(of == u), np.flatnonzero(of == v)
    if not len(one) or not len(two):
        return one[:0], two[:0]
    right, found = _Tree(points[two], more[two], sizes[two]), []
    # in runs of like points, so that few pairs are held at a time
    for own_run in np.array_split(one[np.argsort(sizes[one], kind="stable")], -(-len(one) // RUN)):
        x, y = tree_pairs(_Tree(points[own_run], more[own_run], sizes[own_run]), right, percent)
        x, y = own_run[x], two[y]
        keep = (part[x] != part[y]) & ((u != v) | (x < y))
        found.append((x[keep], y[keep]))
    return tuple(np.concatenate(c) for c in zip(*found))


def _promising(percent: int, groups: int = GROUPS):
    """The points of each unit of work that can be similar to one of another component there."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        kept = []
        for _, own in frame.groupby(["low", "u", "v"], sort=False):
            points, more = unpacked(own["counts"], groups)
            kept.append(own.iloc[np.union1d(*_apart(own, points, more, own["n"].to_numpy(), percent))])
            del points, more
        give_back()
        return pd.concat(kept)[["low", "u", "v", "run", "node", "component", "n"]]

    return run


def _linked_points(percent: int):
    """Edges that connect the similar points of each unit of work, verified on the sets, the most promising pairs first. A pair already
    connected in the unit is not verified."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        edges = []
        for _, own in frame.groupby(["low", "u", "v"], sort=False):
            sets = [np.frombuffer(m, np.uint64) for m in own["members"]]
            sizes = np.array([len(s) for s in sets], np.int64)
            counts = np.stack([np.bincount((s % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS) for s in sets])
            points, more = np.minimum(counts, 255).astype(np.uint8), np.maximum(counts - 255, 0).sum(1)
            node, part = own["node"].to_numpy(), np.unique(own["component"].to_numpy(), return_inverse=True)[1]
            x, y = _apart(own, points, more, sizes, percent)
            bound = np.zeros(len(x))
            for k in range(0, len(x), 2000):
                i, j = x[k:k + 2000], y[k:k + 2000]
                bound[k:k + 2000] = _most_shared(points[i], points[j], more[i], more[j]) / (sizes[i] + sizes[j])
            order = np.argsort(-bound, kind="stable")
            root = list(range(len(own)))
            for i, j in zip(x[order].tolist(), y[order].tolist()):
                p, q = _root(root, int(part[i])), _root(root, int(part[j]))
                if p != q and _alike(sets[i], sets[j], percent):
                    root[max(p, q)] = min(p, q)
                    edges.append((node[i], node[j]))
            del sets, counts, points, more
        give_back()
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return run


def _root(root: list[int], k: int) -> int:
    while root[k] != k:
        root[k] = root[root[k]]
        k = root[k]
    return k


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if len(x) > len(y):
        x, y = y, x
    shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _similar(percent: int):
    """The similar ones among the pairs of a unit, whose sets come once each."""

    def run(key, pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        members = {n: np.frombuffer(m, np.uint64) for n, m in zip(sets["node"].to_numpy().tolist(), sets["members"])}
        good = np.zeros(len(pairs), bool)
        for k, (a, b) in enumerate(zip(pairs["a"].to_numpy().tolist(), pairs["b"].to_numpy().tolist())):
            x, y = members.get(a), members.get(b)
            good[k] = x is not None and y is not None and _alike(x, y, percent)
        del members
        give_back()
        return pairs.loc[good, ["a", "b"]]

    return run


def _bounded(percent: int):
    """Pairs whose summed minima reach the needed overlap."""

    def run(batches):
        for batch in batches:
            a, b, n, m = (batch.column(k).to_numpy() for k in range(4))
            keep = np.zeros(len(a), bool)
            for k in range(0, len(a), 2000):
                at = slice(k, k + 2000)
                (x, more), (y, other) = unpacked(batch.column(4)[at].to_pylist()), unpacked(batch.column(5)[at].to_pylist())
                bound = _most_shared(x, y, more, other)
                keep[at] = bound >= _needed(n[at], m[at], percent)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep))
            give_back()

    return run


def _sets_of(nodes: DataFrame, docs: DataFrame, chosen: DataFrame, size: int, more: str = "") -> DataFrame:
    """The sets of some points, made again from one text of each, with the ``more`` columns of ``nodes``."""
    keys = written(nodes.join(chosen.select("node", "key"), "node"), "set-keys")
    texts = only_keys(docs.select("key", "text"), keys).join(keys, "key").select("node", "text", *[c for c in keys.columns if c not in ("node", "key")])
    return texts.mapInArrow(_set_bytes(size), f"node long, members binary{more}")


def _verified(pairs: DataFrame, docs: DataFrame, chosen: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose sets are similar; sets are made again for the texts of these pairs only."""
    # neighbouring pairs are one unit: those of a leader need its set once
    dealt = written(pairs.repartitionByRange(pairs.count() // TOGETHER + 1, "a", "b").select("a", "b", F.spark_partition_id().alias("unit")), "units")
    needed = dealt.select("unit", F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.collect_set("unit").alias("units"))
    held = _sets_of(needed, docs, chosen, size, ", units array<int>").select(F.explode("units").alias("at"), "node", "members")
    return dealt.groupBy("unit").cogroup(held.groupBy("at")).applyInPandas(_similar(percent), "a long, b long")


def _leader_pairs(chosen: DataFrame, picks: int, percent: int) -> DataFrame:
    """Of the first ``picks`` shared n-grams of each point, in a hashed order: one point of the n-gram with the others, where the bound allows."""
    order = F.array_sort(F.transform("grams", lambda g: F.struct(F.xxhash64(g), g.alias("gram"))))
    first = written(chosen.select("node", "n", F.explode(F.slice(order, 1, picks)["gram"]).alias("gram")), "first-grams")
    lead = first.groupBy("gram").agg(F.min_by(F.struct("node", "n"), F.xxhash64("node", "gram")).alias("lead"))
    met = first.join(lead, "gram").select("node", "n", F.col("lead.node").alias("leader"), F.col("lead.n").alias("m")).filter(
        (F.col("node") != F.col("leader")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m")))
    # a pair once, whichever of the two led
    pairs = met.groupBy(F.least("node", "leader").alias("x"), F.greatest("node", "leader").alias("y")).agg(F.min("leader").alias("a")).select(
        "a", F.when(F.col("a") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("b"))
    # dealt out by point once, for both sides
    held = chosen.select("node", "n", "counts").repartition("node")
    left = held.select(F.col("node").alias("a"), F.col("n").alias("n"), F.col("counts").alias("x"))
    right = held.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("counts").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(_bounded(percent), "a long, b long")


def jaccard_join(df: DataFrame, size: int = 5, percent: int = 75, picks: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_shingles long, component_id)`` for every row: the size of its set of ``size``-word shingles, and the smallest key reachable by
    links, itself included. Two rows are linked when ``100 * intersection >= percent * union``, on whole texts with A-Z folded.

    Keys are whole numbers. Only the key and the text are read. Texts without words and null texts have an empty set and link with nothing; texts with
    fewer words than ``size`` have one shingle, their sequence; rows with equal sets are one point, so a group of copies costs one; rows with a
    null key are linked only through equal sets; an empty table gives no rows.

    First one point for each of some n-grams is compared with the others that share it; then trees join what is still apart. Only n-grams
    whose points lie in several components go on to the trees, so no pairs are listed within a group of near copies that is connected.
    """
    with small_batches(df.sparkSession):
        return _joined(df, size, percent, picks, key, text)


def _joined(df: DataFrame, size: int, percent: int, picks: int, key: str, text: str) -> DataFrame:
    spark = df.sparkSession
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    counted = docs.select("text").mapInArrow(_frequent(size), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    # bounded: FREQUENT numbers; they only order the prefixes
    top = counted.filter("n >= 32").orderBy(F.desc("n"), "gram").limit(FREQUENT).toPandas()
    grams, rank = top["gram"].to_numpy().astype(np.int64).view(np.uint64), np.arange(len(top), 0, -1)
    order = np.argsort(grams)
    late = spark.sparkContext.broadcast((grams[order], rank[order]))
    points = written(docs.mapInArrow(_points(size, percent, late), "key long, n long, node long, counts binary, prefix array<long>"), "points")
    # dealt out by n-gram once, for the count and for the join
    single = points.filter("node is not null").select("node", F.explode("prefix").alias("gram")).repartition("gram")
    shared = single.groupBy("gram").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("gram")
    rows = single.join(shared.hint("shuffle_hash"), "gram").distinct().groupBy("node").agg(F.collect_list("gram").alias("grams"))
    # copies are reduced before they are moved; a point of rows without a key has no key to read its text by
    one = points.filter("key is not null and node is not null").groupBy("node").agg(F.min("key").alias("key"), F.first("n").alias("n"), F.first("counts").alias("counts"))
    chosen = written(one.join(rows, "node").filter(_enough("size(grams)", percent)), "chosen")
    pairs = written(_leader_pairs(chosen, picks, percent), "pairs")
    links = written(_verified(pairs, docs, chosen, size, percent), "links")
    near = chosen.select("node", "grams").join(components(links), "node", "left").select(
        F.explode("grams").alias("gram"), "node", F.coalesce("component", "node").alias("component"))
    links = links.unionByName(written(_tree_join(near, docs, chosen, size, percent), "links"))
    labelled = points.select("key", "n", "node").join(components(links), "node", "left").withColumn("root", F.coalesce("component", "node"))
    smallest = labelled.filter("root is not null").groupBy("root").agg(F.min("key").alias("component_id"))
    return labelled.join(smallest, "root", "left").select(F.col("key").cast(df.schema[key].dataType).alias(key), F.col("n").alias("n_shingles"),
                                                          F.coalesce("component_id", "key").cast(df.schema[key].dataType).alias("component_id"))


def _tree_join(rows: DataFrame, docs: DataFrame, chosen: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges among the points of n-grams that still lie in several components.

    N-grams with the same smallest component are one bundle, so that a point and its set come once and not with each n-gram it shares with a family.
    A bundle is dealt out in units of two runs of about ``UNIT`` points. A first pass over the counts keeps the points with a possible partner, a second
    one over finer counts keeps those that still have one, a third one over the sets of these returns edges between components only, fewer than its points.
    """
    # dealt out by n-gram once, for the count and for the join
    rows = rows.repartition("gram")
    grams = rows.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("node").alias("first"), F.max("node").alias("last"))
    grams = grams.filter("low <> high and first <> last").select("gram", "low")  # the nodes are named, so that both read the same rows
    met = written(rows.join(grams.hint("shuffle_hash"), "gram").groupBy("low", "node", "component").agg(F.count("*").alias("grams")), "bundles")
    enough = met.groupBy("node").agg(F.sum("grams").alias("grams")).join(chosen.select("node", "n"), "node").filter(_enough("grams", percent))
    live = written(met.join(enough.select("node"), "node", "left_semi").select("low", "node", "component"), "bundles")
    runs = live.groupBy("low").agg(F.ceil(F.count("*") / UNIT).cast("int").alias("runs"), F.min("component").alias("least"), F.max("component").alias("most"))
    dealt = live.join(runs.filter("least <> most").select("low", "runs"), "low").withColumn("run", F.pmod(F.xxhash64("node"), F.col("runs")).cast("int"))
    # a point of run r meets run s in unit (min, max)
    unit = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("runs") - 1))).select(
        "low", F.least("run", "other").alias("u"), F.greatest("run", "other").alias("v"), "run", "node", "component")
    place = F.xxhash64("low", "u", "v")
    parts = unit.count() // (4 * UNIT) + 1
    counted = unit.withColumn("unit", F.pmod(place, F.lit(parts))).join(chosen.select("node", "n", "counts"), "node")
    shape = "low long, u int, v int, run int, node long, component long, n long"
    left = written(counted.groupBy("unit").applyInPandas(_promising(percent), shape), "promising")
    sets = written(_sets_of(left.select("node").distinct(), docs, chosen, size), "sets")
    parts = left.count() * FINE // SET_BYTES + 1
    finer = left.withColumn("unit", F.pmod(place, F.lit(parts))).join(sets.mapInArrow(_fine_counts, "node long, counts binary"), "node")
    left = written(finer.groupBy("unit").applyInPandas(_promising(percent, FINE), shape), "promising")
    parts = 8 * (left.agg(F.sum("n")).first()[0] or 0) // SET_BYTES + 1
    full = left.withColumn("unit", F.pmod(place, F.lit(parts))).join(sets.join(left.select("node").distinct(), "node", "left_semi"), "node")
    return full.groupBy("unit").applyInPandas(_linked_points(percent), "a long, b long")
