"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Weights are whole shares of a frame of ``frame`` slots. Block j of a source with share k is released at slot ``floor(j * frame / k)``
and due by ``ceil((j + 1) * frame / k)``; every slot goes to the released block that is due first. So after any number of slots each source
has had its weight's part of them with a deviation of less than one block. The schedule repeats every frame: it is worked out for
one frame, whose size is a parameter, and block j stands in frame ``j div k`` at the slot of block ``j mod k``.

Few sources have one slot each in advance, as the registered SQL has it. Where these would be more than one of ``CROWDED`` slots, or where the
caller gives target weights, shares follow the weights alone, and the frame grows until the smallest weight has a slot.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush
from math import ceil, fsum, inf

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from prefloom.sources.scratch import written

#: Key ranges into which the rows of each source are dealt to be numbered; every range is numbered on its own.
BUCKETS = 1024
#: A source to so many slots at most gets its slot in advance.
CROWDED = 20
#: A frame grows up to so many slots for small weights, or to ``CROWDED`` for each source; what is smaller still has one slot.
MOST = 1 << 20
#: Tables of so many sources at most are sent to all tasks.
SENT = 1000
#: Rows of a partition of the mixed order, at least.
LEAST = 32


def shares(sizes: DataFrame, power: float = 0.5, frame: int = 1000) -> DataFrame:
    """``(source, n, share)``: weights in proportion to ``n ** power``, as whole shares that add up to ``frame``, at least one each.

    One row per source; the number of sources must stay below ``frame`` (an error otherwise). The largest remainders are rounded up, ties by source.
    """
    # one slot for every source, the others by weight
    weight = F.pow(F.col("n").cast("double"), F.lit(power))
    all_rows = Window.partitionBy()
    exact = (F.lit(frame) - F.count("*").over(all_rows)) * F.col("w") / F.sum("w").over(all_rows)
    df = sizes.withColumn("w", F.round(weight, 9).cast("decimal(38,9)").cast("double")).withColumn("exact", F.round(exact, 6))
    df = df.withColumn("low", F.floor("exact")).withColumn("left", F.lit(frame) - F.count("*").over(all_rows) - F.sum("low").over(all_rows))
    place = F.row_number().over(Window.partitionBy().orderBy((F.col("low") - F.col("exact")).asc(), F.col("source").asc_nulls_first()))
    share = (F.col("low") + F.lit(1) + (place <= F.col("left")).cast("long"))
    checked = F.when(F.count("*").over(all_rows) < frame, share).otherwise(F.raise_error(F.lit("more sources than slots in a frame")))
    return df.select("source", "n", checked.cast("long").alias("share"))


def frame_slots(weights: DataFrame, frame: int = 1000) -> DataFrame:
    """``(source, in_frame, slot)``: the slot of every block of one frame, earliest deadline first among the released blocks.

    The fold runs over one array of all sources, ``frame`` slots at most, whatever the number of rows to mix.
    """
    start = F.array_sort(F.collect_list(F.struct(
        ((F.lit(frame) + F.col("share") - 1).cast("double") / F.col("share")).cast("long").alias("due"), F.coalesce("source", F.lit("")).alias("name"),
        F.col("source").isNotNull().alias("named"), F.col("share").alias("share"), F.lit(0).cast("long").alias("done"))))

    def due(k: Column, j: Column) -> Column:
        return ((j + 1) * frame + k - 1).cast("double") / k

    def release(k: Column, j: Column) -> Column:
        return F.floor(j * F.lit(frame) / k)

    def step(state: Column, slot: Column) -> Column:
        ready = F.filter(state["queue"], lambda b: (release(b["share"], b["done"]) <= slot) & (b["done"] < b["share"]))
        # structs are compared by their fields in turn: the deadline, then the source
        chosen = F.array_min(ready)
        queue = F.transform(state["queue"], lambda b: F.when((b["name"] == chosen["name"]) & (b["named"] == chosen["named"]), F.struct(
            F.floor(due(b["share"], b["done"] + 1)).alias("due"), b["name"].alias("name"), b["named"].alias("named"), b["share"].alias("share"),
            (b["done"] + 1).alias("done"))).otherwise(b))
        picked = F.struct(chosen["name"].alias("name"), chosen["named"].alias("named"), chosen["done"].alias("in_frame"), slot.alias("slot"))
        return F.struct(queue.alias("queue"), F.concat(state["picked"], F.array(picked)).alias("picked"))

    empty = F.expr("cast(array() as array<struct<name:string,named:boolean,in_frame:bigint,slot:bigint>>)")
    folded = F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(frame - 1).cast("long")), F.struct(F.col("queue").alias("queue"), empty.alias("picked")), step)
    plan = weights.agg(start.alias("queue")).filter("size(queue) > 0").select(F.explode(folded["picked"]).alias("p"))
    return plan.select(F.when(F.col("p.named"), F.col("p.name")).alias("source"), F.col("p.in_frame").alias("in_frame"), F.col("p.slot").alias("slot"))


def weighted_shares(weights: list[float], frame: int) -> tuple[list[int], int]:
    """Shares in proportion to positive ``weights``, at least one each, and the frame they add up to: a multiple of ``frame`` in which the smallest
    weight has a slot and half of the slots at least are free of such rounding. The largest remainders are rounded up, ties in the given order."""
    need = max(2 * len(weights), min(fsum(weights) / min(weights), max(MOST, CROWDED * len(weights))))
    frame *= ceil(need / frame)
    out, rest = [1] * len(weights), list(range(len(weights)))
    free, total = frame, fsum(weights)
    while small := [i for i in rest if weights[i] * free < total]:
        rest = [i for i in rest if weights[i] * free >= total]
        free, total = free - len(small), fsum(weights[i] for i in rest)
    exact = {i: weights[i] / total * free for i in rest}
    for i in rest:
        out[i] = max(1, int(exact[i]))
    up = sorted(rest, key=lambda i: out[i] - exact[i])
    left = frame - sum(out)
    for i in up[:left] if left > 0 else up[left:] if left else []:
        out[i] += 1 if left > 0 else -1
    return out, frame


def walk(shares: list[int], frame: int) -> tuple[list[int], list[int]]:
    """Per slot of a frame the source, by its place in ``shares``, and the number of its block: as ``frame_slots``, for many sources."""
    waiting, ready, done, who, which = [], [(-(-frame // k), i) for i, k in enumerate(shares)], [0] * len(shares), [], []
    heapify(ready)
    for slot in range(frame):
        while waiting and waiting[0][0] <= slot:
            i = heappop(waiting)[1]
            heappush(ready, (-(-(done[i] + 1) * frame // shares[i]), i))
        i = heappop(ready)[1]
        who.append(i)
        which.append(done[i])
        done[i] += 1
        if done[i] < shares[i]:
            heappush(waiting, (done[i] * frame // shares[i], i))
    return who, which


def _weighted_plan(sizes: DataFrame, frame: int, power: float, targets: DataFrame | None) -> tuple[DataFrame, DataFrame, int]:
    """``shares``, ``frame_slots`` and the frame, worked out with one entry per source and slot in the driver."""
    spark = sizes.sparkSession
    if targets is None:
        df = sizes.select("source", F.round(F.pow(F.col("n").cast("double"), F.lit(power)), 9).alias("w"))
    else:
        given = targets.select(F.col("source").cast("string").alias("s"), F.col("weight").cast("double").alias("w"))
        df = sizes.join(given, sizes["source"].eqNullSafe(given["s"]), "left").select("source", "w")
    rows = sorted(df.collect(), key=lambda r: (r.source or "", r.source is not None))
    names, weights = [r.source for r in rows], [r.w for r in rows]
    if len(set(names)) < len(names):
        raise ValueError("a source has several target weights")
    if wrong := [n for n, w in zip(names, weights) if w is None or not 0 < w < float("inf")]:
        raise ValueError(f"{len(wrong)} sources without a positive target weight, such as {wrong[0]!r}")
    own, frame = weighted_shares(weights, frame) if rows else ([], frame)
    who, which = walk(own, frame) if rows else ([], [])
    table = pa.table({"source": pa.array(names, pa.string()), "share": pa.array(own, pa.int64())})
    slots = pa.table({"source": pa.array([names[i] for i in who], pa.string()), "in_frame": pa.array(which, pa.int64()), "slot": pa.array(range(len(who)), pa.int64())})
    kinds = "source string, share long", "source string, in_frame long, slot long"
    return spark.createDataFrame(table, kinds[0]), spark.createDataFrame(slots, kinds[1]), frame


def mix_sources(df: DataFrame, block: int = 10, frame: int = 1000, power: float = 0.5, key: str = "doc_id", source: str = "source",
                targets: DataFrame | None = None) -> DataFrame:
    """``(key, source, share, block, release, deadline, slot, place)`` for every row.

    Rows of a source are put in the order of a hash of their key and cut into blocks of ``block`` rows; ``slot`` is the scheduled slot of the row's
    block and ``place`` the row's place in it. Sorting by ``(slot, place)`` mixes the sources; a source that is used up leaves its slots empty, no
    row is dropped or repeated. Rows of a null source form one source; rows with equal or null keys are numbered in any order; an empty table gives no
    rows. Other columns are not read. A hot source is numbered in ``BUCKETS`` key ranges, each on its own, with the sizes of the ranges before it added.
    ``targets`` holds ``(source, weight)``, in place of ``n ** power``; a source without a positive weight is an error, weights of absent sources are not
    read. Slots follow the weights rounded to whole shares of the frame.
    """
    rows = _dealt(df.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source")))
    offsets, slots, frame, n = _plan(rows, frame, power, targets)
    return _scheduled(_ranked(rows, offsets, n), slots, block, frame, n).select(
        F.col("key").alias(key), F.col("source").alias(source), "share", "block", "release", "deadline", "slot", "place")


def mixed_rows(df: DataFrame, block: int = 10, frame: int = 1000, power: float = 0.5, key: str = "doc_id", source: str = "source",
               targets: DataFrame | None = None) -> DataFrame:
    """The rows of ``df``, with all their columns, in the mixed order: partitions by slot, sorted inside. Cases as in ``mix_sources``.

    Keys and sources alone are numbered first, which tells for every run of hashes the partition its slots lie in. Whole rows then move once, into their
    partition, and are numbered there. Rows with equal keys that lie in several partitions are numbered before, as nothing else tells them apart; so
    are all rows where there are more than ``SENT`` sources.
    """
    named = df.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    rows = _dealt(named)
    offsets, slots, frame, n = _plan(rows, frame, power, targets)
    if n > SENT:
        placed = _scheduled(_ranked(rows, offsets, n), slots, block, frame, n)
        return placed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select("row.*")
    keys = _scheduled(_ranked(rows.drop("row"), offsets, n), slots, block, frame, n)
    keys = written(keys.select("key", "source", "h", "bucket", "rank", "share", "slot"), "mixed-keys")
    parts = max(1, min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(keys.count() / LEAST)))
    segments = written(_segments(_in_parts(keys, parts)), "mixed-segments")
    held = segments.groupBy(F.col("source").alias("s"), F.col("bucket").alias("b"), "share").agg(
        F.array_sort(F.collect_list(F.struct("start", "part", "low", "tied"))).alias("segments"))
    met = rows.join(F.broadcast(held), rows["source"].eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    own = F.struct("h", "key")
    moved = met.withColumn("segment", F.element_at(F.filter("segments", lambda s: s["low"].isNull() | (s["low"] <= own)), -1))
    if not segments.filter("tied").isEmpty():
        tied = F.exists("segments", lambda s: s["tied"] & s["low"].eqNullSafe(own))
        # at most one run of equal keys for each end of a segment
        ends = F.broadcast(segments.filter("tied").select(F.col("source").alias("s"), F.col("bucket").alias("b"), "low").distinct())
        runs = keys.join(ends, keys["source"].eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")) & own.eqNullSafe(F.col("low")), "left_semi")
        runs = F.broadcast(runs.groupBy(F.col("source").alias("rs"), F.col("bucket").alias("rb"), own.alias("run")).agg(F.min("rank").alias("first")))
        equal = met.filter(tied).join(runs, F.col("source").eqNullSafe(F.col("rs")) & (F.col("bucket") == F.col("rb")) & own.eqNullSafe(F.col("run")))
        equal = equal.withColumn("rank", F.col("first") + F.row_number().over(Window.partitionBy("source", "bucket", "run").orderBy("h")) - 1)
        equal = equal.withColumn("segment", F.element_at(F.filter("segments", lambda s: s["start"] <= F.col("rank")), -1))
        moved = moved.filter(~tied).unionByName(equal.select(*moved.columns))
    moved = moved.select("source", "share", "h", "key", "row", F.col("segment.part").alias("part"), F.col("segment.start").alias("start"))
    moved = moved.repartitionById(parts, "part")
    rank = F.col("start") + F.row_number().over(Window.partitionBy("part", "source", "start").orderBy("h", "key")) - 1
    placed = _scheduled(moved.withColumn("rank", rank), slots, block, frame, n)
    return placed.sortWithinPartitions("slot", "place").select("row.*")


def _in_parts(keys: DataFrame, parts: int) -> DataFrame:
    """``keys`` with ``part``: runs of slots with like numbers of rows, ``parts`` at most."""
    if parts == 1:
        return keys.withColumn("part", F.lit(0))
    # bounded: one slot per partition
    ends = keys.agg(F.percentile_approx("slot", [i / parts for i in range(1, parts)], 10 * parts)).first()[0]
    splits = [-inf, *sorted({end + 1.0 for end in ends}), inf]
    held = Bucketizer(splits=splits, inputCol="at", outputCol="part").transform(keys.withColumn("at", F.col("slot").cast("double")))
    return held.withColumn("part", F.col("part").cast("int")).drop("at")


def _segments(keys: DataFrame) -> DataFrame:
    """``(source, bucket, share, start, part, low, tied)``: for every bucket and part its first rank; its lowest hash and key, null in the first part of a
    bucket; and whether these are also the highest of the part before."""
    own = F.struct("h", "key")
    ends = keys.groupBy("source", "bucket", "share", "part").agg(F.min("rank").alias("start"), F.min(own).alias("low"), F.max(own).alias("high"))
    before = F.lag("high").over(Window.partitionBy("source", "bucket").orderBy("start"))
    ends = ends.withColumn("before", before)
    return ends.select("source", "bucket", "share", "start", "part", F.when(F.col("before").isNotNull(), F.col("low")).alias("low"),
                       (F.col("before").isNotNull() & F.col("low").eqNullSafe(F.col("before"))).alias("tied"))


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` with the hash of their key and the range of hashes it lies in."""
    rows = rows.withColumn("h", F.md5(F.coalesce(F.col("key").cast("string"), F.lit(""))))
    rows = rows.withColumn("bucket", F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * BUCKETS / F.lit(1 << 32))
    return rows.withColumn("bucket", F.floor("bucket"))


def _sent(small: DataFrame, n: int) -> DataFrame:
    # few sources: one row per source and range, and one per slot of a frame, are bounded by parameters
    return F.broadcast(small) if n <= SENT else small


def _plan(rows: DataFrame, frame: int, power: float, targets: DataFrame | None) -> tuple[DataFrame, DataFrame, int, int]:
    """``(s, b, before, share)`` of every range of hashes, ``(s, in_frame, at)`` of every slot of a frame, the frame, and the number of sources."""
    sizes = rows.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    totals = sizes.groupBy("source").agg(F.sum("n").alias("n"))
    n = totals.count()
    if targets is None and n * CROWDED <= frame:
        weights = shares(totals, power, frame)
        slots = frame_slots(weights, frame)
    else:
        weights, slots, frame = _weighted_plan(totals, frame, power, targets)
    offsets = before.join(_sent(weights.select("source", "share"), n), before["source"].eqNullSafe(weights["source"])).select(
        before["source"].alias("s"), F.col("bucket").alias("b"), F.coalesce("before", F.lit(0)).alias("before"), "share")
    return offsets, slots.select(F.col("source").alias("s"), "in_frame", F.col("slot").alias("at")), frame, n


def _ranked(rows: DataFrame, offsets: DataFrame, n: int) -> DataFrame:
    """``rows`` with the share of their source and their rank in it."""
    numbered = rows.withColumn("rn", F.row_number().over(Window.partitionBy("source", "bucket").orderBy("h", "key")))
    ranked = numbered.join(_sent(offsets, n), numbered["source"].eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return ranked.withColumn("rank", F.col("before") + F.col("rn") - 1).drop("rn", "before", "s", "b")


def _scheduled(ranked: DataFrame, slots: DataFrame, block: int, frame: int, n: int) -> DataFrame:
    """``ranked`` with ``block``, ``release``, ``deadline``, ``slot`` and ``place``."""
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / block)).withColumns(
        {"place": F.col("rank") % block, "j": F.col("block") % F.col("share")})
    placed = ranked.join(_sent(slots, n), ranked["source"].eqNullSafe(F.col("s")) & (F.col("j") == F.col("in_frame")))
    turn = F.floor(F.col("block") / F.col("share")) * F.lit(frame)
    return placed.withColumns({
        "release": turn + F.floor(F.col("j") * F.lit(frame) / F.col("share")),
        "deadline": turn + F.floor(((F.col("j") + 1) * F.lit(frame) + F.col("share") - 1) / F.col("share")),
        "slot": turn + F.col("at")}).drop("s", "in_frame", "at", "j")
