"""Implausible readings: robust control charts per source, run-length counters and physical limits."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.session import checkpointed, fits_broadcast, guarded_join, salted_join, written

STEP_METRICS = ("max_hand_translation_step", "max_finger_translation_step", "max_camera_translation_step", "max_camera_rotation_step")
#: Two rotation matrices differ by at most this in the Frobenius norm.
MAX_ROTATION = 2 * math.sqrt(2)
#: Log-value buckets: four to a factor of three, so that a gap of three times never hides inside one bucket.
BUCKET = math.log(3.0) / 4
#: Stands for the logarithm of an exact zero, below that of any positive number.
NOTHING = -800.0


def one_per_clip(df: DataFrame, columns: list[str], clip: str = "clip_id", order: str = "stat_id") -> DataFrame:
    """First delivered row of each clip; a row without clip id counts as a clip of its own."""
    k = F.coalesce(F.col(clip).cast("string"), F.concat(F.lit("\x00"), F.col(order).cast("string")))
    return df.groupBy(k.alias("__k")).agg(F.min_by(F.struct(*columns), F.col(order)).alias("r")).select("r.*")


def _plausible(x: Column, limit: float | None) -> Column:
    """Log of a positive, finite reading within its physical limit; null for any other."""
    ok = (x > 0) & ~F.isnan(x) & (x < F.lit(float("inf")))
    return F.when(ok & (x <= limit) if limit else ok, F.ln(x))


def source_levels(df: DataFrame, source: str, metrics: dict[str, float | None]) -> DataFrame:
    """Robust centre and scale of the log readings per source: ``source, __c0 .., __s0 ..``, two doubles a metric.

    From histograms of the log values (mergeable, map-side combined), so no source is ever sorted or gathered:
    centre and quartiles are those of the bucket middles, scale is the interquartile range over 1.349. A source most of whose readings
    are exact zeros stands still: its centre is NOTHING, and any motion at all is far above it.
    """
    step = BUCKET / 4
    cell = lambda c, lim: F.when(F.col(c) == 0, F.lit(NOTHING)).otherwise(_plausible(F.col(c), lim))
    cells = df.select(
        source,
        F.explode(F.array(*[F.struct(F.lit(i).alias("m"), F.floor(cell(c, lim) / step).alias("b")) for i, (c, lim) in enumerate(metrics.items())])).alias("x"),
    ).where("x.b is not null")
    hist = cells.groupBy(source, "x.m", "x.b").agg(F.count("*").alias("n")).withColumn("zero", F.col("b") * step <= NOTHING)
    w = Window.partitionBy(source, "m", "zero")
    cum = hist.withColumn("c", F.sum("n").over(w.orderBy("b"))).withColumn("t", F.sum("n").over(w))
    at = lambda p: F.min(F.when(~F.col("zero") & (F.col("c") >= F.col("t") * p), (F.col("b") + 0.5) * step))
    per = cum.groupBy(source, "m").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"), F.coalesce(F.sum(F.when(F.col("zero"), F.col("n"))), F.lit(0)).alias("z"), F.sum("n").alias("n"))
    still = F.col("z") * 2 > F.col("n")
    per = per.select(source, "m", F.when(still, NOTHING).otherwise(F.col("q2")).alias("c"), F.when(still, 0.05).otherwise(F.greatest((F.col("q3") - F.col("q1")) / 1.349, F.lit(0.05))).alias("s"))
    return per.groupBy(source).agg(*[F.max(F.when(F.col("m") == i, F.col(k))).alias(f"__{k}{i}") for i in range(len(metrics)) for k in ("c", "s")])


def _chart(series: np.ndarray, x: np.ndarray, centre: np.ndarray, scale: np.ndarray, lam: float, width: float, carried: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Suspect flags of ``x`` (rows by metrics) and the state (mean, variance) in which the last series ends.

    ``series``: number of each row's series; rows of a series are neighbours. All series advance together, a row each per step. The first
    one starts from ``carried`` if that is given, any other from its centre and scale. A suspected value is clipped to
    the limit before it moves mean and scale; NaN moves nothing.
    """
    n, m = x.shape
    starts = np.flatnonzero(np.r_[True, series[1:] != series[:-1]])
    length = np.diff(np.r_[starts, n])
    order = np.argsort(-length, kind="stable")
    mean, sd0 = centre[starts].copy(), scale[starts]
    var = sd0**2
    if carried is not None:
        mean[0], var[0] = carried
    starts, length, mean, sd0, var = starts[order], length[order], mean[order], sd0[order], var[order]
    out = np.zeros((n, m), bool)
    for t in range(int(length[0])):
        k = int(np.searchsorted(-length, -t, side="left"))  # series longer than t
        i = starts[:k] + t
        v = x[i]
        have = ~np.isnan(v)
        sd = np.sqrt(var[:k])
        lim = width * sd
        d = np.where(have, v - mean[:k], 0.0)
        out[i] = have & (d > lim)
        c = np.clip(d, -lim, lim)
        mean[:k] += lam * c
        nv = (1 - lam) * var[:k] + lam * np.minimum(c * c, (1.5 * sd) ** 2) * 1.3
        var[:k] = np.where(have, np.clip(nv, (0.5 * sd0[:k]) ** 2, (1.5 * sd0[:k]) ** 2), var[:k])
    last = int(np.flatnonzero(order == len(order) - 1)[0])
    return out, (mean[last], var[last])


def charted(df: DataFrame, source: str, block: str, order: list[str], ident: str, metrics: dict[str, float | None], lam: float = 0.05, width: float = 2.5, series_rows: int = 50_000) -> DataFrame:
    """What the charts find: ``source, m, ident, x``, a row per suspected log reading, and one with null ``ident`` for the highest accepted.

    A chart runs per (source, block) from the source's robust level, batch by batch; between batches only its mean and scale are kept.
    A block of more than ``series_rows`` readings is charted as several series, each a hashed part of it in time order, so no source and no
    day makes one task's work.
    """
    k = len(metrics)
    levels = checkpointed(source_levels(df, source, metrics))
    logs = [F.when(F.col(c) == 0, F.lit(NOTHING)).otherwise(_plausible(F.col(c), lim)).cast("float").alias(f"__x{i}") for i, (c, lim) in enumerate(metrics.items())]
    rows = df.where(F.col(source).isNotNull()).select(F.col(source).alias(source), F.col(block).alias("__b"), *order, ident, *logs)
    big = checkpointed(rows.groupBy(source, "__b").count().where(F.col("count") > series_rows).select(source, "__b", F.ceil(F.col("count") / series_rows).alias("__k")))
    if not big.isEmpty():
        rows = rows.join(F.broadcast(big) if fits_broadcast(big) else big, [source, "__b"], "left").withColumn("__b", F.struct("__b", F.pmod(F.xxhash64(ident), F.coalesce("__k", F.lit(1))))).drop("__k")
    rows = rows.withColumn("__b", F.xxhash64("__b"))
    near = fits_broadcast(levels)
    rows = rows if near else salted_join(rows, levels, [source])
    rows = rows.repartition(source, "__b").sortWithinPartitions(source, "__b", *order, ident)
    rows = rows.drop(*order).join(F.broadcast(levels), source) if near else rows.drop(*order)
    cols = [f"__x{i}" for i in range(k)]
    kind = dict(df.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, top = None, None, {}
        for p in batches:
            if not len(p):
                continue
            src, blk = p[source].to_numpy(object), p["__b"].to_numpy()
            new = np.r_[True, (src[1:] != src[:-1]) | (blk[1:] != blk[:-1])]
            x = p[cols].to_numpy(float)
            c, s = (np.nan_to_num(p[[f"__{q}{i}" for i in range(k)]].to_numpy(float), nan=d) for q, d in (("c", 0.0), ("s", 1.0)))
            x = np.where((x <= NOTHING) & (c > NOTHING), np.nan, x)  # a zero is a reading only of a source that stands still
            suspect, state = _chart(new.cumsum(), x, c, s, lam, width, state if key == (src[0], blk[0]) else None)
            key = (src[-1], blk[-1])
            i, m = np.nonzero(suspect)
            yield pd.DataFrame({"s": src[i], "m": m.astype("int32"), "ident": p[ident].to_numpy()[i], "x": x[i, m]})
            ok = np.where(suspect, np.nan, x)
            first = np.flatnonzero(np.r_[True, src[1:] != src[:-1]])
            for a, z in zip(first, np.r_[first[1:], len(src)]):
                for j in range(k):
                    v = ok[a:z, j]
                    if not np.isnan(v).all():
                        top[src[a], j] = max(np.nanmax(v), top.get((src[a], j), -np.inf))
        if top:
            yield pd.DataFrame({"s": [q[0] for q in top], "m": np.array([q[1] for q in top], "int32"), "ident": None, "x": list(top.values())})

    return rows.mapInPandas(run, f"s {kind[source]}, m int, ident {kind[ident]}, x double").withColumnRenamed("s", source)


def chart_spikes(found: DataFrame, source: str, factor: float = 3.0) -> DataFrame:
    """Spikes among what ``charted`` found: ``ident, m``.

    The ordinary readings of a source and metric are those its charts accept, and suspected ones that follow them upward without a gap of
    more than ``factor`` (the tail of the ordinary). A suspected reading above ``factor`` times the highest ordinary one is a spike. Where
    nothing was accepted nothing is ordinary, and there are no spikes.
    """
    gap = math.log(factor)
    top = found.where("ident is null").groupBy(source, "m").agg(F.max("x").alias("top"))
    high = guarded_join(found.where("ident is not null"), top, [source, "m"], "inner").where("x > top")
    cells = high.groupBy(source, "m", "top", F.floor(F.col("x") / (gap / 4)).alias("b")).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    below = F.coalesce(F.lag("hi").over(Window.partitionBy(source, "m").orderBy("b")), F.col("top"))
    limits = cells.withColumn("below", below).where(F.col("lo") - F.col("below") > gap).groupBy(source, "m").agg((F.min("below") + gap).alias("l"))
    return guarded_join(high, limits, [source, "m"], "inner").where("x > l").select("ident", "m")


def stuck_readings(df: DataFrame, group: list[str], seq: str, ident: str, metrics: list[str], run: int = 6, tol: float = 1e-4, block: int = 4096) -> DataFrame:
    """``ident, i`` of readings in a run of ``run`` or more successive ones that stay within ``tol`` of one another.

    Missing readings (null, NaN) are skipped, zeros and infinities end a run. Rows are counted by one window per (group, block
    of ``seq``); runs over block borders come from the border readings alone, so a group that holds a third of all rows
    is spread over many tasks.
    """
    base = df.select(*group, ident, F.col(seq).alias("__q"), F.floor(F.col(seq) / block).alias("__blk"), *[F.when(~F.isnan(c), F.col(c)).alias(f"__v{i}") for i, c in enumerate(metrics)])
    keys = [*group, "__blk"]
    over = f"over (partition by {', '.join(f'`{g}`' for g in keys)} order by __q, `{ident}`)"

    def close(cur: str, olds: list[str]) -> str:
        vals = ", ".join([cur, *olds])
        return f"case when {cur} is null then null when {olds[-1]} is null then false else least({vals}) > 0 and greatest({vals}) < double('inf') and greatest({vals}) - least({vals}) <= {tol!r}D * greatest({vals}) end"

    n = range(len(metrics))
    s1 = base.selectExpr("*", *[f"lag(__v{i}, {k}) ignore nulls {over} as __p{i}_{k}" for i in n for k in range(1, run)])
    s2 = s1.selectExpr(*keys, f"`{ident}`", "__q", *[f"__v{i}" for i in n], *[f"{close(f'__v{i}', [f'__p{i}_{k}' for k in range(1, run)])} as __e{i}" for i in n])
    # a reading belongs to a run if a window of `run` readings that ends at it or at one of the next run - 1 is close
    s3 = s2.selectExpr("*", *[f"coalesce(__e{i}, false) or (__v{i} is not null and (" + " or ".join(f"coalesce(lead(__e{i}, {k}) ignore nulls {over}, false)" for k in range(1, run)) + f")) as __f{i}" for i in n])
    inside = s3.select(ident, F.explode(F.array_compact(F.array(*[F.when(F.col(f"__f{i}"), F.lit(i)) for i in n]))).alias("i"))

    # borders: the first and last run - 1 readings of each block, for groups of several blocks
    many = checkpointed(base.groupBy(*group).agg(F.min("__blk").alias("a"), F.max("__blk").alias("z")).where("z > a").drop("a", "z"))
    if many.isEmpty():
        return inside
    many = F.broadcast(many) if fits_broadcast(many) else many
    long = base.join(many, group, "left_semi").select(*keys, ident, "__q", F.posexplode(F.array(*[F.col(f"__v{i}") for i in n])).alias("i", "v")).where("v is not null")
    by = Window.partitionBy(*keys, "i")
    edge = (
        long.withColumn("up", F.row_number().over(by.orderBy("__q", ident)))
        .withColumn("cnt", F.count("*").over(by))
        .where((F.col("up") < run) | (F.col("up") > F.col("cnt") - run + 1))
    )
    # a break stands for the readings left out between a block's first and last ones
    brk = edge.where((F.col("up") == run - 1) & (F.col("cnt") > 2 * (run - 1))).withColumn("v", F.lit(-1.0)).withColumn(ident, F.lit(None)).withColumn("up", F.col("up") + 0.5)
    seqd = edge.withColumn("up", F.col("up") + 0.0).unionByName(brk)
    wg = Window.partitionBy(*group, "i").orderBy("__blk", "up")
    back, fore = wg.rowsBetween(-(run - 1), 0), wg.rowsBetween(0, run - 1)
    hi, lo = F.max("v").over(back), F.min("v").over(back)
    ends = seqd.withColumn("e", (F.count("*").over(back) == run) & (lo > 0) & (hi < float("inf")) & (hi - lo <= tol * hi))
    cross = ends.withColumn("f", F.max("e").over(fore)).where(f"f and `{ident}` is not null").select(ident, F.col("i"))
    return inside.unionByName(cross).distinct()


def implausible_readings(
    df: DataFrame, source: str = "source_id", group: str = "group_id", seq: str = "clip_seq", clip: str = "clip_id", order: str = "stat_id", at: str = "eval_time",
    metrics: dict[str, float | None] | None = None, factor: float = 3.0, run: int = 6, tol: float = 1e-4, block_seconds: int = 86_400,
) -> DataFrame:
    """Readings that do not fit their source, ``clip_id, metric, reason`` (a reading once per reason).

    ``physical``: negative, infinite, or above the metric's limit. ``spike``: suspected by its robust exponentially weighted chart (of the log
    readings) and above ``factor`` times the highest ordinary reading of the source; for a source whose readings are mostly exact
    zeros the ordinary is 0, so that any positive reading is one.
    ``stuck``: among ``run`` or more successive readings of a group within ``tol`` of one another.

    A clip counts once (its first row). Null, NaN and 0 are never cases; rows without source are held to
    physical limits alone, rows without group are in no run. An empty table gives an empty result; other columns are ignored.
    """
    metrics = metrics or {c: MAX_ROTATION if "rotation" in c else None for c in STEP_METRICS}
    cols = list(metrics)
    base = written(one_per_clip(df, [clip, order, source, group, seq, at, *cols], clip, order))
    day = F.coalesce(F.floor(F.unix_micros(F.col(at).cast("timestamp")) / (block_seconds * 1_000_000)), F.pmod(F.xxhash64(order), F.lit(64)))
    found = checkpointed(charted(base.withColumn("__blk", day), source, "__blk", [at, seq], order, metrics))
    spikes = chart_spikes(found, source, factor).select(F.col("ident").alias(order), F.col("m").alias("i"), F.lit("spike").alias("reason"))
    stuck = stuck_readings(base.where(F.col(group).isNotNull()), [source, group], seq, order, cols, run, tol).select(order, F.col("i"), F.lit("stuck").alias("reason"))
    names = F.array(*[F.lit(c) for c in cols])
    drawn = guarded_join(base.select(order, clip), spikes.unionByName(stuck), [order], "inner").select(clip, F.element_at(names, F.col("i") + 1).alias("metric"), "reason")
    flags = []
    for c, lim in metrics.items():
        x = F.col(c)
        bad = x.isNotNull() & ~F.isnan(x) & ((x < 0) | (x == float("inf")) | ((x > lim) if lim else F.lit(False)))
        flags.append(F.when(bad, F.struct(F.lit(c).alias("metric"), F.lit("physical").alias("reason"))))
    physical = base.select(clip, F.explode(F.array_compact(F.array(*flags))).alias("r")).select(clip, "r.metric", "r.reason")
    return physical.unionByName(drawn)
