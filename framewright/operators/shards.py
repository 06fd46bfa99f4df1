"""Plans of output shards and batches over whole clips in order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.session import guarded_join, ranked


def ordered_fold(df: DataFrame, order: str, weight: str, out: str, step: Callable) -> DataFrame:
    """Number rows in ``order`` by a sequential rule over (state, weight) -> (state, number).

    Each number depends on all rows before, so one task streams over two narrow columns (order and weight, batch by batch, holding none);
    the numbers are then joined back.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for p in batches:
            nums = []
            for w in p[weight].tolist():
                state, k = step(state, w)
                nums.append(k)
            yield pd.DataFrame({order: p[order], out: nums})

    slim = df.select(order, F.coalesce(F.col(weight), F.lit(0)).cast("bigint").alias(weight)).repartition(1).sortWithinPartitions(order)
    return slim.mapInPandas(run, f"`{order}` {dict(df.dtypes)[order]}, `{out}` bigint")


def shard_plan(episodes: DataFrame, order: str, frames: str, budget: int = 10_000) -> DataFrame:
    """``shard_idx`` of whole episodes, greedily: a shard closes before an episode that would pass the budget, and once it reaches it.

    An episode over the budget gets a shard of its own; episodes without frames get no shard (null) and are skipped.
    """

    def step(state, n):
        shard, held = state or (0, 0)
        if held and held + n > budget:
            shard, held = shard + 1, 0
        held += n
        return ((shard + 1, 0) if held >= budget else (shard, held)), shard

    full = episodes.where(F.col(frames) > 0)
    return episodes.join(ordered_fold(full, order, frames, "shard_idx", step), order, "left")


def shard_summary(plan: DataFrame, order: str, frames: str) -> DataFrame:
    """Per shard its episodes, frames, and first and last episode."""
    return plan.where("shard_idx is not null").groupBy("shard_idx").agg(F.count("*").alias("episodes"), F.sum(frames).alias("frames"), F.min(order).alias("first_episode"), F.max(order).alias("last_episode"))


def batches(episodes: DataFrame, order: str, frames: str, most_episodes: int = 128, most_frames: int = 16_384) -> DataFrame:
    """``batch_idx`` of episodes in order under two limits; a batch also closes once it reaches either."""

    def step(state, n):
        b, k, held = state or (0, 0, 0)
        if k and (k >= most_episodes or held + n > most_frames):
            b, k, held = b + 1, 0, 0
        k, held = k + 1, held + n
        return ((b + 1, 0, 0) if k >= most_episodes or held >= most_frames else (b, k, held)), b

    return episodes.join(ordered_fold(episodes, order, frames, "batch_idx", step), order)


def weighted_partition(records: DataFrame, order: str, weight: str, desired: int) -> DataFrame:
    """Contiguous shards ``shard_id, start, end, weight`` of about equal weight; ``end`` is exclusive, records count from 0 in ``order``.

    A shard closes when it reaches its part of the total, or when the records left are as many as the shards left.
    """
    t = records.agg(F.count("*").alias("n"), F.sum(weight).alias("w")).first()
    n, total = t["n"], float(t["w"] or 0)
    want = min(n, desired)
    target = max(1.0, total / want) if want else 1.0

    def step(state, w):
        shard, held, i = state or (0, 0, 0)
        held, i = held + w, i + 1
        left, shards_left = n - i, want - shard - 1
        close = want > 1 and left >= shards_left and (held >= target or left == shards_left)
        return ((shard + 1, 0, i) if close else (shard, held, i)), shard

    d = records.join(ordered_fold(records, order, weight, "shard_id", step), order)
    g = d.groupBy("shard_id").agg(F.count("*").alias("__n"), F.sum(weight).alias("weight"))
    end = F.sum("__n").over(Window.orderBy("shard_id").rowsBetween(Window.unboundedPreceding, 0))
    return g.select("shard_id", (end - F.col("__n")).alias("start"), end.alias("end"), "weight")


def pending_shards(plan: DataFrame, written: DataFrame, key: str = "shard_idx", size: str = "bytes") -> DataFrame:
    """Planned shards that aren't there yet or are empty."""
    return plan.join(written.where(F.col(size) > 0).select(key), key, "left_anti")


def locality_order(videos: DataFrame, path: str, work: Column, shard: str) -> DataFrame:
    """``rank`` of videos: shards of most work first, then by shard, by work, by path; videos without shard count alone."""
    s = F.coalesce(F.col(shard), F.concat(F.lit("\x00"), F.col(path)))
    d = videos.withColumn("work", work).withColumn("__s", s)
    d = guarded_join(d, d.groupBy("__s").agg(F.sum("work").alias("shard_work")), ["__s"], "inner")
    return ranked(d, [(F.col("shard_work"), True), (F.col("__s"), False), (F.col("work"), True), (F.col(path), False)], "rank").drop("__s")


def uniform_indices(n: Column, k: int, truncate: bool = False) -> Column:
    """At most ``k`` of 0 .. n-1 spread evenly, ends included, each once; half to even, or cut down if ``truncate``."""
    cut = F.floor if truncate else F.rint
    some = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: cut(i * (n - 1) / F.lit(max(k - 1, 1))).cast("bigint")))
    every = F.transform(F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1), lambda i: i)
    none = F.array().cast("array<bigint>")
    return F.when((n <= 0) | F.lit(k <= 0), none).when(n <= k, every).otherwise(some)


def numbered(kept: DataFrame, pos: str, out: str = "episode_index") -> DataFrame:
    """Episodes numbered from 0 in ``pos`` order without one global sort: numbers within ranges, plus the counts of the ranges before."""
    return ranked(kept, [(F.col(pos), False)], out)


def head(df: DataFrame, pos: str, n: int | None) -> DataFrame:
    """Rows of the first ``n`` positions (not an arbitrary limit); all for None."""
    return df if n is None else df.where(F.col(pos) < n)


def selected(df: DataFrame, pos: str, start: int, end: int | None) -> DataFrame:
    """Positions [start, end); a negative start or an end before it is an error."""
    if start < 0 or (end is not None and end < start):
        raise ValueError(f"bad range [{start}, {end})")
    d = df.where(F.col(pos) >= start)
    return d if end is None else d.where(F.col(pos) < end)


def build_totals(results: DataFrame) -> DataFrame:
    """One row of written, skipped and reused shards and frames from task results (``status, frames, skipped_clips``)."""
    s = F.col("status")
    return results.agg(*[F.count_if(s == k).alias(f"{k}_shards") for k in ("written", "reused", "failed")], *[F.coalesce(F.sum(F.when(s == k, F.col("frames"))), F.lit(0)).alias(f"{k}_frames") for k in ("written", "reused")], F.coalesce(F.sum("skipped_clips"), F.lit(0)).alias("skipped_clips"))
