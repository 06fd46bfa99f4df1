"""Ordered per-clip operators: next state, islands, streaks, ownership and repair of gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


def next_state(df: DataFrame, clip: str, order: list[str], state: str, zero: Column, out: str = "action", drop_last: bool = False) -> DataFrame:
    """The next frame's state as this frame's action; ``zero`` on a clip's last frame, which ``drop_last`` removes."""
    w = Window.partitionBy(clip).orderBy(*order)
    d = df.withColumn("__n", F.lead(F.struct(F.col(state).alias("v"))).over(w))
    d = d.withColumn(out, F.when(F.col("__n").isNull(), zero).otherwise(F.col("__n.v")))
    return (d.where("__n is not null") if drop_last else d).drop("__n")


def merged_gate_samples(df: DataFrame, video: str, idx: str, valid: str, score: str, skip: int = 15, min_frames: Column | float = 60.0, max_invalid: int = 3) -> DataFrame:
    """Intervals ``video, start_frame, end_frame, score`` of valid samples.

    A run of ``max_invalid`` invalid samples in a row cuts; an interval ends ``skip`` after its last valid sample, and shorter ones than
    ``min_frames`` are dropped. The score is the mean over valid samples.
    """
    w = Window.partitionBy(video).orderBy(idx)
    d = df.select(video, idx, score, F.col(valid).alias("__ok"), F.row_number().over(w).alias("__r"), *([min_frames.alias("__min")] if isinstance(min_frames, Column) else []))
    v = d.where("__ok")
    v = v.withColumn("__new", F.when(F.col("__r") - F.lag("__r").over(w) - 1 < max_invalid, 0).otherwise(1))
    v = v.withColumn("__i", F.sum("__new").over(w))
    least = F.max("__min") if isinstance(min_frames, Column) else F.lit(float(min_frames))
    g = v.groupBy(video, "__i").agg(F.min(idx).alias("start_frame"), (F.max(idx) + skip).alias("end_frame"), F.avg(score).alias("score"), least.alias("__least"))
    return g.where("end_frame - start_frame >= __least").drop("__i", "__least")


def contiguous_segments(df: DataFrame, key: list[str], frame: str) -> DataFrame:
    """Rows with ``segment`` (from 0), ``segment_count`` and ``part_id``: runs of successive frame numbers within ``key``."""
    w = Window.partitionBy(*key).orderBy(frame)
    d = df.withColumn("__g", F.col(frame) - F.row_number().over(w))
    d = d.withColumn("segment", F.dense_rank().over(Window.partitionBy(*key).orderBy("__g")) - 1)
    d = d.withColumn("segment_count", F.max("segment").over(Window.partitionBy(*key)) + 1)
    return d.withColumn("part_id", F.format_string("%03d", "segment")).drop("__g")


def episode_runs(df: DataFrame, part: list[str], order: list[str], clip: str, out: str = "run_id") -> DataFrame:
    """Number of the run of equal ``clip`` in scan order, from 0; a clip that comes back later is a new run."""
    w = Window.partitionBy(*part).orderBy(*order)
    new = F.when(F.lag(F.struct(clip)).over(w).isNull() | ~F.col(clip).eqNullSafe(F.lag(clip).over(w)), 1).otherwise(0)
    return df.withColumn("__new", new).withColumn(out, F.sum("__new").over(w) - 1).drop("__new")


def longest_streak(df: DataFrame, key: list[str], order: list[str], counts: Column, resets: Column) -> DataFrame:
    """Per key the longest streak of rows that ``count``; a row that ``resets`` ends it, any other leaves it as it is."""
    w = Window.partitionBy(*key).orderBy(*order)
    d = df.select(*key, *[F.col(o) for o in order if o not in key], counts.cast("int").alias("__c"), resets.cast("int").alias("__z"))
    d = d.withColumn("__i", F.sum("__z").over(w))
    s = d.groupBy(*key, "__i").agg(F.sum(F.when(F.col("__z") == 0, F.col("__c")).otherwise(0)).alias("n"))
    return s.groupBy(*key).agg(F.max("n").alias("streak"))


def repeated(df: DataFrame, order: list[str], times: int, index: str = "episode_index") -> DataFrame:
    """Every row ``times`` times, whole rounds in order, numbered anew; ``index`` must be 0 .. n-1."""
    n = df.count()
    reps = df.withColumn("repeat_index", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))) if times > 0 else df.limit(0).withColumn("repeat_index", F.lit(0))
    return reps.withColumn(index, F.col("repeat_index") * n + F.col(index))


def chained_correction(df: DataFrame, clip: str, chunk: str, ratio: str, trusted: Column) -> DataFrame:
    """``correction``: running product of trusted ratios by chunk; an untrusted one carries the last on."""
    w = Window.partitionBy(clip).orderBy(chunk).rowsBetween(Window.unboundedPreceding, 0)
    r = F.when(trusted & (F.col(ratio) > 0), F.ln(F.when(F.col(ratio) > 0, F.col(ratio)))).otherwise(0.0)
    return df.withColumn("correction", F.exp(F.sum(F.coalesce(r, F.lit(0.0))).over(w)))


def owner_chunk(df: DataFrame, key: list[str], frame: str, centre: str, chunk: str) -> DataFrame:
    """For each frame the row of the chunk with the nearest centre, ties to the earlier chunk."""
    rank = F.struct(F.abs(F.col(frame) - F.col(centre)), F.col(chunk))
    cols = [c for c in df.columns if c not in (*key, frame)]
    return df.groupBy(*key, frame).agg(F.min_by(F.struct(*cols), rank).alias("r")).select(*key, frame, "r.*")


def anchored(df: DataFrame, key: list[str], raw: str, corrected: str) -> DataFrame:
    """``corrected`` scaled so that its median is that of ``raw``."""
    m = df.groupBy(*key).agg((F.percentile(raw, 0.5) / F.nullif(F.percentile(corrected, 0.5), F.lit(0.0))).alias("__k"))
    return df.join(m, key).withColumn(corrected, F.col(corrected) * F.coalesce("__k", F.lit(1.0))).drop("__k")


def repaired(df: DataFrame, key: list[str], frame: str, cols: list[str], window: int = 5) -> DataFrame:
    """Frames in which a column is not finite, interpolated in time and smoothed by a centred box (edges repeated).

    Finite frames stay as they are. With fewer than two finite frames, gaps become 0. ``frame`` must be 0 .. n-1 within ``key``.
    """
    half = window // 2
    fin = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    ok = fin(cols[0])
    for c in cols[1:]:
        ok = ok & fin(c)
    w = Window.partitionBy(*key).orderBy(frame)
    d = df.withColumn("__ok", ok)
    d = d.withColumn("__n", F.sum(F.col("__ok").cast("int")).over(Window.partitionBy(*key)))
    at = F.when(F.col("__ok"), F.struct(F.col(frame).alias("f"), *[F.col(c) for c in cols]))
    d = d.withColumn("__a", F.last(at, True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__z", F.first(at, True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    u = (F.col(frame) - F.col("__a.f")) / F.nullif(F.col("__z.f") - F.col("__a.f"), F.lit(0))
    for c in cols:
        y = F.when(F.col("__a").isNull(), F.col(f"__z.{c}")).when(F.col("__z").isNull(), F.col(f"__a.{c}")).otherwise(F.col(f"__a.{c}") + F.coalesce(u, F.lit(0.0)) * (F.col(f"__z.{c}") - F.col(f"__a.{c}")))
        d = d.withColumn(f"__i_{c}", F.when(F.col("__ok"), F.col(c)).otherwise(y))
    box, whole = w.rowsBetween(-half, half), Window.partitionBy(*key).orderBy(frame).rowsBetween(*ALL)
    for c in cols:
        n = F.count("*").over(box)
        before = F.greatest(F.lit(0), half - F.col("__r0"))
        after = F.greatest(F.lit(0), half - F.col("__r1"))
        d = d.withColumn("__r0", F.row_number().over(w) - 1).withColumn("__r1", F.count("*").over(whole) - F.row_number().over(w))
        first, last = F.first(f"__i_{c}").over(whole), F.last(f"__i_{c}").over(whole)
        smooth = (F.sum(f"__i_{c}").over(box) + before * first + after * last) / (n + before + after)
        keep = F.when(fin(c), F.col(c)).otherwise(0.0)
        d = d.withColumn(f"__o_{c}", F.when(F.col("__n") < 2, keep).when(F.col("__ok"), F.col(c)).otherwise(smooth))
    return d.select(*[F.col(f"__o_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def fill_window_start(df: DataFrame, key: list[str], frame: str, both: Column) -> DataFrame:
    """``window_start``: nearest frame at or before this one with both hands valid; the clip's first frame if there is none."""
    w = Window.partitionBy(*key).orderBy(frame).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("window_start", F.coalesce(F.last(F.when(both, F.col(frame)), True).over(w), F.min(frame).over(Window.partitionBy(*key))))


def overlapping_chunks(n: Column, size: int, overlap: int = 0) -> Column:
    """array<struct<start,end,ref>> over ``n`` frames: chunks of ``size`` that share ``overlap`` frames, without a tail that adds nothing.

    ``end`` is exclusive, ``ref`` the middle frame.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and under size")
    stride = size - overlap
    chunks = F.greatest(F.ceil((n - size) / stride), F.lit(0)) + 1
    rows = F.transform(F.sequence(F.lit(0).cast("bigint"), chunks - 1), lambda i: F.struct((i * stride).alias("start"), F.least(i * stride + size, n.cast("bigint")).alias("end")))
    rows = F.transform(rows, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), (r["start"] + F.floor((r["end"] - r["start"]) / 2)).alias("ref")))
    return F.when(n > 0, rows).otherwise(F.slice(rows, 1, 0))


def first_examples(df: DataFrame, part: list[str], order: list[str], k: int = 32) -> DataFrame:
    """First ``k`` rows per ``part`` in scan order."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col("__r") <= k).drop("__r")


def window_extremes(df: DataFrame, clip: str, frame: str, value: str, past: int, future: int) -> DataFrame:
    """``lo, hi`` of a scalar over the frames from ``frame - past`` to ``frame + future`` that are present."""
    w = Window.partitionBy(clip).orderBy(frame).rangeBetween(-past, future)
    return df.withColumn("lo", F.min(value).over(w)).withColumn("hi", F.max(value).over(w))


def latest_errors(df: DataFrame, key: str, pos: str, error: str, limit: int = 5) -> DataFrame:
    """Last error per key, the first ``limit`` keys in the order they first failed."""
    g = df.where(F.col(error).isNotNull()).groupBy(key).agg(F.max_by(error, pos).alias(error), F.min(pos).alias("first_pos"))
    return g.orderBy("first_pos", key).limit(limit)
