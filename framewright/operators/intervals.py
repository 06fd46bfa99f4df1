"""Interval operators: merging overlaps into periods, gaps, and the islands family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_intervals(df: DataFrame, entity: str, start: str, end: str) -> DataFrame:
    """Islands of half-open intervals within one entity; touching intervals belong together."""
    w = Window.partitionBy(entity).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return (
        df.withColumn("__new", F.when(before >= F.col(start), 0).otherwise(1))
        .withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(entity, "__island")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("__island")
    )


def clip_frames(df: DataFrame) -> DataFrame:
    """``video, s, e`` in frames: a bound missing in frames is the one in seconds times ``fps``, rounded.

    Rows with a bound missing in both, or not ending after their start, are dropped, as are rows without a video
    and repeated rows.
    """

    def bound(frames: str, secs: str) -> Column:
        t = F.col(secs) * F.col("fps")
        ok = t.isNotNull() & ~F.isnan(t) & (F.abs(t) < 1e15)
        return F.coalesce(F.col(frames).cast("bigint"), F.when(ok, F.round(t)).try_cast("bigint"))

    return (
        df.select("video", bound("start_frame", "start_sec").alias("s"), bound("end_frame", "end_sec").alias("e"))
        .where("video is not null and s is not null and e is not null and e > s")
        .distinct()
    )


def periods_and_gaps(df: DataFrame, shard: int = 1 << 16) -> DataFrame:
    """Continuous periods of each video and the gaps between successive ones, ``video, kind, start_frame, end_frame``.

    Two levels, so that a video which holds a third of all rows is merged by many tasks:

    1. each interval is cut at the borders of time shards of ``shard`` frames into a head, a tail and one middle
       piece that covers whole shards; heads and tails are merged within (video, shard);
    2. only runs that touch a shard border, and the middle pieces, are stitched per video. Runs that touch no
       border are final unless a middle piece covers their shard.

    Gaps are taken within (video, shard) and, over borders, from one row per shard.
    Empty input gives an empty result; an interval of any length costs at most three rows.
    """
    iv = clip_frames(df).withColumn("fs", F.floor(F.col("s") / shard)).withColumn("ls", F.floor((F.col("e") - 1) / shard))
    one = F.col("fs") == F.col("ls")
    w = F.lit(shard).cast("bigint")
    piece = lambda kind, sh, s, e: F.struct(F.lit(kind).alias("lvl"), sh.alias("sh"), s.alias("s"), e.alias("e"))
    pieces = iv.select(
        "video",
        F.explode(
            F.array_compact(
                F.array(
                    piece(0, F.col("fs"), F.col("s"), F.when(one, F.col("e")).otherwise((F.col("fs") + 1) * w)),
                    F.when(~one, piece(0, F.col("ls"), F.col("ls") * w, F.col("e"))),
                    F.when(F.col("ls") - F.col("fs") > 1, piece(1, F.col("fs") + 1, (F.col("fs") + 1) * w, F.col("ls") * w)),
                )
            )
        ).alias("p"),
    ).select("video", "p.*")

    key = F.struct("video", "sh")
    local = (
        merge_intervals(pieces.where("lvl = 0").select(key.alias("k"), "s", "e"), "k", "s", "e")
        .select("k.video", "k.sh", "s", "e")
        .withColumn("edge", (F.col("s") == F.col("sh") * w) | (F.col("e") == (F.col("sh") + 1) * w))
    )
    middle = merge_intervals(pieces.where("lvl = 1").select("video", "s", "e").distinct(), "video", "s", "e")
    edges = local.where("edge").select("video", "s", "e").unionByName(middle)
    stitched = merge_intervals(edges, "video", "s", "e")
    # a border-free run lies under a stitched period only if a middle piece covers its shard
    inner = local.where("not edge")
    # merged middles are disjoint and begin at shard borders, so only the last one that begins at or before a shard can cover it
    marks = inner.select("video", "sh").distinct().withColumn("ce", F.lit(None).cast("bigint")).unionByName(middle.select("video", F.floor(F.col("s") / shard).alias("sh"), F.col("e").alias("ce")))
    before = Window.partitionBy("video").orderBy("sh", F.col("ce").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    cover = marks.withColumn("end", F.last("ce", True).over(before)).where(F.col("ce").isNull() & (F.col("end") >= (F.col("sh") + 1) * w)).select("video", "sh")
    inner = inner.join(cover, ["video", "sh"], "left_anti").select("video", "s", "e")
    periods = stitched.unionByName(inner).withColumn("sh", F.floor(F.col("s") / shard))

    ws = Window.partitionBy("video", "sh").orderBy("s")
    firsts = periods.groupBy("video", "sh").agg(F.min("s").alias("first"))
    nxt = firsts.select("video", "sh", F.lead("first").over(Window.partitionBy("video").orderBy("sh")).alias("nf"))
    rows = periods.withColumn("ns", F.lead("s").over(ws)).join(nxt, ["video", "sh"])
    rows = rows.withColumn("ns", F.coalesce("ns", "nf"))
    out = F.array_compact(
        F.array(
            F.struct(F.lit("period").alias("kind"), F.col("s").alias("start_frame"), F.col("e").alias("end_frame")),
            F.when(F.col("ns").isNotNull(), F.struct(F.lit("gap").alias("kind"), F.col("e").alias("start_frame"), F.col("ns").alias("end_frame"))),
        )
    )
    return rows.select("video", F.explode(out).alias("r")).select("video", "r.kind", "r.start_frame", "r.end_frame")
