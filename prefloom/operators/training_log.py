"""Summaries and running values over step logs.

A run may hold most of the log. Per-step running values are therefore computed
in chunks of steps: each chunk is a bounded group of its own, and only one
small row per chunk takes part in the per-run order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from prefloom.functions.numeric import piece_of

# Columns averaged for a rollout history; durations in the time estimate.
HISTORY_COLUMNS = ["policy_loss", "value_loss", "total_loss", "kl_divergence", "entropy", "grad_norm"]
RECENT_STEPS = 10

# The adaptive KL coefficient's rule.
BETA_FACTOR = 1.5
BETA_MAX = 0.5
BETA_MIN = 1e-4

CHUNK_STEPS = 65_536
FOLD_STEPS = 128


def epoch_accuracy(df: DataFrame, by: list[str], correct: str = "correct", total: str = "total") -> DataFrame:
    """sum(correct) / sum(total), 0 where nothing was counted."""
    sums = df.groupBy(*by).agg(F.sum(correct).alias("correct"), F.sum(total).alias("total"))
    ratio = F.when(F.col("total") > 0, F.col("correct") / F.col("total")).otherwise(F.lit(0.0))
    return sums.withColumn("accuracy", ratio)


def epoch_summary(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.avg("loss").alias("avg_loss"),
        F.avg("accuracy").alias("avg_accuracy"),
        (F.avg("accuracy") * 100).alias("accuracy_percent"),
    )


def metric_rollup(df: DataFrame, by: list[str], step: str = "step") -> DataFrame:
    """Mean, min, max and count of numeric metrics per name.

    A log with a ``raw_value`` text column also gets the last of those values;
    without one, no text is in the aggregation state and it stays hash-based.
    """
    aggs = [
        F.avg("num_value").alias("mean"),
        F.min("num_value").alias("min"),
        F.max("num_value").alias("max"),
        F.count("num_value").alias("count"),
    ]
    if "raw_value" in df.columns:
        aggs.append(F.max_by("raw_value", F.when(F.col("raw_value").isNotNull(), F.col(step))).alias("last_raw"))
    return df.groupBy(*by).agg(*aggs)


def run_summary(df: DataFrame, run: str = "run_id", epoch: str = "epoch") -> DataFrame:
    """Number of epochs and mean/min/max over the epoch means of loss and accuracy."""
    epochs = df.groupBy(run, epoch).agg(
        *[F.avg(F.when(F.col("name") == n, F.col("num_value"))).alias(n) for n in ("loss", "accuracy")])
    return epochs.groupBy(run).agg(
        F.count("*").alias("total_epochs"),
        *[f(n).alias(f"overall_{n}_{label}")
          for n in ("loss", "accuracy") for label, f in (("mean", F.avg), ("min", F.min), ("max", F.max))])


def history_average(df: DataFrame, run: str = "run_id") -> DataFrame:
    """Means of a rollout history; pass only the logged steps."""
    return df.groupBy(run).agg(*[F.avg(c).alias(c) for c in HISTORY_COLUMNS], F.count("*").alias("steps"))


def loss_reduction(df: DataFrame, run: str = "run_id", step: str = "step", loss: str = "loss") -> DataFrame:
    """Percent from the first to the last loss, 0 unless the first is positive."""
    ends = df.groupBy(run).agg(
        F.min_by(loss, step).alias("initial_loss"), F.max_by(loss, step).alias("final_loss"))
    first, last = F.col("initial_loss"), F.col("final_loss")
    return ends.withColumn("loss_reduction", F.when(first > 0, (first - last) / first * 100).otherwise(F.lit(0.0)))


def progress_percent(current: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(0.0)).otherwise(current / F.nullif(total, F.lit(0)) * 100)


def running_means(
    df: DataFrame, by: list[str], values: list[str], step: str = "step", chunk: int = CHUNK_STEPS
) -> DataFrame:
    """Mean of each value from the first step of its group up to this one.

    (``by``, ``step``) must be unique and not NULL; steps may have gaps.
    """
    rows = df.withColumn("_chunk", piece_of(step, chunk))
    inner = W.partitionBy(*by, "_chunk").orderBy(step).rowsBetween(W.unboundedPreceding, W.currentRow)
    outer = W.partitionBy(*by).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy(*by, "_chunk").agg(
        *[F.sum(v).alias(f"_s_{v}") for v in values], *[F.count(v).alias(f"_n_{v}") for v in values])
    parts = [f"_{kind}_{v}" for v in values for kind in ("s", "n")]
    carried = totals.select(
        *by, "_chunk", *[F.coalesce(F.sum(p).over(outer), F.lit(0)).alias(p) for p in parts])
    local = rows.withColumns({f"_ls_{v}": F.sum(v).over(inner) for v in values})
    local = local.withColumns({f"_ln_{v}": F.count(v).over(inner) for v in values})
    joined = local.join(carried, [*by, "_chunk"])
    means = {
        f"running_{v}": (F.coalesce(F.col(f"_ls_{v}"), F.lit(0.0)) + F.col(f"_s_{v}"))
        / F.nullif(F.col(f"_ln_{v}") + F.col(f"_n_{v}"), F.lit(0))
        for v in values
    }
    return joined.withColumns(means).select(*df.columns, *means)


def time_remaining(
    df: DataFrame, run: str = "run_id", step: str = "step", ts: str = "ts_seconds", total: str = "total",
    recent: int = RECENT_STEPS, chunk: int = CHUNK_STEPS,
) -> DataFrame:
    """Mean of the last ``recent`` step durations times the remaining steps.

    NULL on a run's first step and where the total is 0. (``run``, ``step``) must
    be unique and not NULL. Each chunk is extended by the last ``recent + 1`` times before it.
    """
    rows = df.withColumn("_chunk", piece_of(step, chunk))
    back = W.partitionBy(run, "_chunk").orderBy(F.desc(step))
    tails = (
        rows.select(run, "_chunk", step, ts)
        .withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= recent + 1)
        .groupBy(run, "_chunk").agg(F.array_sort(F.collect_list(F.struct(step, ts))).alias("_tail"))
    )
    # Every chunk has at least one step, so recent + 1 chunks reach far enough.
    before = W.partitionBy(run).orderBy("_chunk").rowsBetween(-(recent + 1), -1)
    halo = tails.withColumn("_before", F.flatten(F.collect_list("_tail").over(before)))
    kept = F.slice("_before", -F.least(F.size("_before"), F.lit(recent + 1)), F.lit(recent + 1))
    halo_rows = (
        halo.where(F.size("_before") > 0).select(run, "_chunk", F.inline(kept))
        .withColumns({"_halo": F.lit(True)})
    )
    both = rows.withColumn("_halo", F.lit(False)).unionByName(halo_rows, allowMissingColumns=True)
    order = W.partitionBy(run, "_chunk").orderBy(step)
    timed = both.withColumn("_took", F.col(ts) - F.lag(ts).over(order))
    average = F.avg("_took").over(order.rowsBetween(-(recent - 1), 0))
    left = F.when(F.col(total) != 0, average * (F.col(total) - F.col(step)))
    return timed.withColumn("seconds_remaining", left).where(~F.col("_halo")).drop("_chunk", "_took", "_halo")


def elapsed(df: DataFrame, by: list[str], ts: str = "ts_seconds", name: str = "elapsed") -> DataFrame:
    """Time since the first row of the group; starts are reduced first and joined back."""
    starts = df.groupBy(*by).agg(F.min(ts).alias("_start"))
    return df.join(starts, by).withColumn(name, F.col(ts) - F.col("_start")).drop("_start")


def padded_curves(df: DataFrame, run: str = "run_id", history: str = "history") -> DataFrame:
    """Each metric's values, extended by its last one to the run's longest metric."""
    longest = F.array_max(F.transform(F.map_values(history), F.size))
    entries = df.select(run, F.explode(history).alias("metric", "vals"), longest.alias("n"))
    missing = F.greatest(F.col("n") - F.size("vals"), F.lit(0))
    filled = F.concat("vals", F.array_repeat(F.try_element_at("vals", F.lit(-1)), missing))
    return entries.where(F.size("vals") > 0).select(run, "metric", filled.alias("vals"))


def curve_points(df: DataFrame, run: str = "run_id", history: str = "history") -> DataFrame:
    """(x, y) points of each non-empty metric."""
    entries = df.select(run, F.explode(history).alias("metric", "vals"))
    return entries.select(run, "metric", F.posexplode("vals").alias("x", "y"))


# --- adaptive KL coefficient -----------------------------------------------
#
# One step maps beta to min(1.5 * beta, max), to max(beta / 1.5, min), or to
# itself. All three have the form least(hi, greatest(lo, beta * 1.5^k)), and so
# has every sequence of them. A chunk of steps is thus summed up by (k, lo, hi),
# and beta at its start follows from the chunks before it.

_INF = float("inf")
_MAP = "struct<k:bigint,lo:double,hi:double>"


def _map(k: Column, lo: Column, hi: Column) -> Column:
    return F.struct(k.cast("long").alias("k"), lo.alias("lo"), hi.alias("hi"))


def _identity() -> Column:
    return _map(F.lit(0), F.lit(-_INF), F.lit(_INF))


def _step_map(kl: Column, target: float) -> Column:
    above = (kl > target * BETA_FACTOR) & ~F.isnan(kl)
    below = kl < target / BETA_FACTOR
    return (
        F.when(above, _map(F.lit(1), F.lit(-_INF), F.lit(BETA_MAX)))
        .when(below, _map(F.lit(-1), F.lit(BETA_MIN), F.lit(_INF)))
        .otherwise(_identity())
    )


def _apply(m: Column, beta: Column) -> Column:
    return F.least(m["hi"], F.greatest(m["lo"], beta * F.pow(F.lit(BETA_FACTOR), m["k"])))


def _then(first: Column, second: Column) -> Column:
    lo = F.when(first["lo"] == -_INF, second["lo"]).otherwise(_apply(second, first["lo"]))
    hi = F.when(first["hi"] == _INF, second["hi"]).otherwise(_apply(second, first["hi"]))
    return _map(first["k"] + second["k"], lo, hi)


def _fold(items: Column) -> Column:
    return F.aggregate(items, _identity(), lambda acc, x: _then(acc, x["m"]))


def _starts(items: Column, beta: Column) -> Column:
    """Beta before each item of a bounded list, and after the last one."""
    empty = F.struct(beta.alias("b"), F.array(beta).alias("out"))

    def push(acc: Column, x: Column) -> Column:
        after = _apply(x["m"], acc["b"])
        return F.struct(after.alias("b"), F.concat(acc["out"], F.array(after)).alias("out"))

    return F.aggregate(items, empty, push)["out"]


def adaptive_beta(
    df: DataFrame, start: float, target: float, run: str = "run_id", step: str = "step",
    kl: str = "kl_divergence", fold: int = FOLD_STEPS,
) -> DataFrame:
    """Beta in force after each step of each run. (``run``, ``step``) must be unique and not NULL, steps >= 0.

    Steps are folded in lists of at most ``fold``, those lists again in lists of
    at most ``fold``, and so on: no list or group grows with the length of a run.
    The way down reads the same shuffled lists again (adaptive execution reuses them).
    """
    level = df.select(F.col(run).alias("run"), F.col(step).cast("long").alias("i"), F.col(kl).alias("kl"))
    level = level.where(F.col("run").isNotNull()).withColumn("m", _step_map(F.col("kl"), target)).drop("kl")
    last = df.agg(F.max(step)).first()[0] or 0
    tables = []
    while True:
        item = F.struct("i", "m")
        table = level.groupBy("run", piece_of("i", fold).alias("g")).agg(
            F.array_sort(F.collect_list(item)).alias("items"))
        tables.append(table)
        last //= fold
        if last == 0:
            break
        level = table.select("run", F.col("g").alias("i"), _fold(F.col("items")).alias("m"))
    starts = tables.pop().withColumn("beta", F.lit(float(start)))
    while tables:
        below = _spread(starts, after=False).select("run", F.col("i").alias("g"), "beta")
        # Every list has its start, so the left join only keeps both uses of the list's plan equal.
        starts = tables.pop().join(below, ["run", "g"], "left")
    result = _spread(starts, after=True)
    return result.select(F.col("run").alias(run), F.col("i").alias(step), F.col("beta").alias("beta_kl"))


def _spread(starts: DataFrame, after: bool) -> DataFrame:
    betas = _starts(F.col("items"), F.col("beta"))
    numbers = F.slice(betas, 2 if after else 1, F.size("items"))
    pairs = F.arrays_zip(F.transform("items", lambda x: x["i"]).alias("i"), numbers.alias("beta"))
    return starts.select("run", F.inline(pairs)).toDF("run", "i", "beta")
