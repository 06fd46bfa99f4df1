"""Resampling to another frame rate and interpolation between key frames, by equi joins on index arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions import geometry as G


def target_grid(clips: DataFrame, clip: str, n: Column, target: Column, source_fps: Column, target_fps: Column) -> DataFrame:
    """``clip, t, pos``: for each target frame its place in source frames, kept within the source.

    By the frame rates if both are positive, else spread evenly; a target of as many frames as the source is the source itself.
    """
    by_rate = F.col("t") * F.col("__s") / F.col("__g")
    even = F.when(F.col("__m") > 1, F.col("t") * (F.col("__n") - 1) / (F.col("__m") - 1)).otherwise(0.0)
    d = clips.select(clip, n.alias("__n"), target.alias("__m"), source_fps.alias("__s"), target_fps.alias("__g")).where("__n > 0 and __m > 0")
    d = d.withColumn("t", F.explode(F.sequence(F.lit(0), (F.col("__m") - 1).cast("int"))))
    pos = F.when(F.col("__m") == F.col("__n"), F.col("t").cast("double")).when((F.col("__s") > 0) & (F.col("__g") > 0), by_rate).otherwise(even)
    return d.select(clip, "t", F.least(F.greatest(pos, F.lit(0.0)), F.col("__n") - 1.0).alias("pos"))


def resample_linear(frames: DataFrame, grid: DataFrame, clip: str, frame: str, cols: list[str]) -> DataFrame:
    """Columns of ``frames`` (0 .. n-1 per clip) at the places of ``grid``, linear between neighbours."""
    w = Window.partitionBy(clip).orderBy(frame)
    pairs = frames.select(clip, F.col(frame).alias("__i"), *[x for c in cols for x in (F.col(c).alias(f"__a_{c}"), F.lead(c).over(w).alias(f"__b_{c}"))])
    g = grid.withColumn("__i", F.floor("pos")).withColumn("__u", F.col("pos") - F.floor("pos"))
    out = [(F.col(f"__a_{c}") + F.when(F.col("__u") > 0, F.col("__u") * (F.col(f"__b_{c}") - F.col(f"__a_{c}"))).otherwise(0.0)).alias(c) for c in cols]
    return g.join(pairs, [clip, "__i"]).select(clip, "t", *out)


def resample_nearest(frames: DataFrame, grid: DataFrame, clip: str, frame: str, cols: list[str]) -> DataFrame:
    """Columns of the nearest source frame, halves to the even one."""
    g = grid.withColumn("__i", F.rint("pos").cast("bigint"))
    return g.join(frames.select(clip, F.col(frame).cast("bigint").alias("__i"), *cols), [clip, "__i"]).select(clip, "t", *cols)


def resample_rotation(frames: DataFrame, grid: DataFrame, clip: str, frame: str, quaternion: str) -> DataFrame:
    """Quaternions (x, y, z, w) by slerp on the shorter arc."""
    w = Window.partitionBy(clip).orderBy(frame)
    pairs = frames.select(clip, F.col(frame).alias("__i"), F.col(quaternion).alias("__a"), F.lead(quaternion).over(w).alias("__b"))
    g = grid.withColumn("__i", F.floor("pos")).withColumn("__u", F.col("pos") - F.floor("pos"))
    q = F.when(F.col("__u") > 0, G.slerp(F.col("__a"), F.col("__b"), F.col("__u"))).otherwise(F.col("__a"))
    return g.join(pairs, [clip, "__i"]).select(clip, "t", q.alias(quaternion))


def clean_keyframes(keys: DataFrame, poses: DataFrame, clip: str, t: str, row: str) -> DataFrame:
    """Key frames with their pose, one per time: ``clip, t`` and the columns of ``poses``.

    With as many times as poses they pair off in order. Else a time is the number of its pose, from 0, or from 1 if only that fits all; times
    that fit no pose are dropped. Of equal times the first stays. ``row`` is the order in both tables.
    """
    nk = keys.groupBy(clip).agg(F.count("*").alias("__k"), F.min(t).alias("__lo"), F.max(t).alias("__hi"))
    np_ = poses.groupBy(clip).agg(F.count("*").alias("__p"))
    how = nk.join(np_, clip).select(clip, F.when(F.col("__k") == F.col("__p"), "row").when(((F.col("__lo") < 0) | (F.col("__hi") >= F.col("__p"))) & (F.col("__lo") >= 1) & (F.col("__hi") <= F.col("__p")), "one").otherwise("zero").alias("__how"))
    k = keys.join(how, clip).withColumn("__row", F.when(F.col("__how") == "row", F.col(row)).when(F.col("__how") == "one", F.col(t) - 1).otherwise(F.col(t)))
    j = k.select(clip, t, F.col(row).alias("__o"), "__row").join(poses.withColumnRenamed(row, "__row"), [clip, "__row"])
    cols = [c for c in poses.columns if c not in (clip, row)]
    return j.groupBy(clip, t).agg(F.min_by(F.struct(*cols), "__o").alias("r")).select(clip, t, "r.*")


def between_keyframes(spine: DataFrame, keys: DataFrame, clip: str, t: str, linear: list[str], quaternion: str | None = None) -> DataFrame:
    """Key frame columns at every frame of ``spine`` (``clip, t``): linear, and slerp for ``quaternion``; constant beyond the ends.

    One shuffle by clip: frames and key frames are united, and each frame takes the last key before it and the first after.
    Clips without key frames give nulls.
    """
    cols = [*linear, *([quaternion] if quaternion else [])]
    key = keys.select(clip, F.col(t).cast("double").alias("__t"), F.struct(F.col(t).cast("double").alias("t"), *cols).alias("__k"), F.lit(False).alias("__f"))
    u = spine.select(clip, F.col(t).cast("double").alias("__t"), F.lit(True).alias("__f")).unionByName(key, allowMissingColumns=True)
    w = Window.partitionBy(clip).orderBy("__t", "__f")
    u = u.withColumn("a", F.last("__k", True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("b", F.first("__k", True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    # a key at the very frame sorts before it
    u = u.where("__f").withColumn("a", F.coalesce("a", "b")).withColumn("b", F.coalesce("b", "a"))
    x = F.coalesce((F.col("__t") - F.col("a.t")) / F.nullif(F.col("b.t") - F.col("a.t"), F.lit(0.0)), F.lit(0.0))
    x = F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    out = [(F.col(f"a.{c}") + x * (F.col(f"b.{c}") - F.col(f"a.{c}"))).alias(c) for c in linear]
    if quaternion:
        out.append(G.slerp(F.col(f"a.{quaternion}"), F.col(f"b.{quaternion}"), x).alias(quaternion))
    return u.select(clip, F.col("__t").cast("bigint").alias(t), *out)


def at_clipped_frame(wanted: DataFrame, table: DataFrame, clip: str, frame: str) -> DataFrame:
    """Rows of ``table`` (frames 0 .. n-1 per clip) at the wanted frames, numbers beyond the ends at the ends."""
    n = table.groupBy(clip).agg((F.max(frame)).alias("__last"))
    w = wanted.join(n, clip).withColumn("__i", F.least(F.greatest(F.col(frame), F.lit(0)), F.col("__last")))
    return w.join(table.withColumnRenamed(frame, "__i"), [clip, "__i"]).drop("__i", "__last")
