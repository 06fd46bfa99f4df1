"""Operators whose rule is iterative or depends on its own earlier results, per clip or per track (NumPy inside ``applyInPandas``)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions import geometry as G


def per_key(df: DataFrame, key: list[str], schema: str, f: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    return df.groupBy(*key).applyInPandas(lambda p: f(p), schema)


def _banded_solve(main: np.ndarray, lam: float, rhs: np.ndarray) -> np.ndarray:
    """Solve (diag(main) + lam D'D) x = rhs, D the second difference, by a pentadiagonal factorisation in O(T).

    A dense solve is cubic in the clip's length; the matrix has five diagonals, so L D L' needs two bands only.
    """
    n = len(main)
    d0, d1, d2 = main.astype(float).copy(), np.zeros(n), np.zeros(n)
    if n >= 3 and lam:
        for off, w in ((0, 1.0), (1, 4.0), (2, 1.0)):
            d0[off : n - 2 + off] += lam * w
        d1[0 : n - 2] += -2 * lam
        d1[1 : n - 1] += -2 * lam
        d2[0 : n - 2] += lam
    diag, l1, l2 = np.zeros(n), np.zeros(n), np.zeros(n)
    for i in range(n):
        a = l1[i - 1] if i >= 1 else 0.0
        b = l2[i - 2] if i >= 2 else 0.0
        diag[i] = d0[i] - (a * a * diag[i - 1] if i >= 1 else 0.0) - (b * b * diag[i - 2] if i >= 2 else 0.0)
        if i + 1 < n:
            l1[i] = (d1[i] - (l2[i - 1] * diag[i - 1] * a if i >= 1 else 0.0)) / diag[i]
        if i + 2 < n:
            l2[i] = d2[i] / diag[i]
    y = rhs.astype(float).copy()
    for i in range(n):
        if i >= 1:
            y[i] -= l1[i - 1] * y[i - 1]
        if i >= 2:
            y[i] -= l2[i - 2] * y[i - 2]
    y /= diag
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            y[i] -= l1[i] * y[i + 1]
        if i + 2 < n:
            y[i] -= l2[i] * y[i + 2]
    return y


def fit_scale(a: np.ndarray, b: np.ndarray, valid: np.ndarray, lam: float, sigma: float, rounds: int = 5, least: int = 8, lo: float = 1e-3, hi: float = 1e3) -> tuple[np.ndarray, bool]:
    """Smooth, robust factors x(t) with x a near b: reweighted least squares with a second-difference penalty.

    With fewer than ``least`` valid frames the constant median of b / a, and False.
    """
    a, b, valid = np.asarray(a, float), np.asarray(b, float), np.asarray(valid, bool)
    r = (b / np.maximum(a, 1e-6))[valid & (a > 0)]
    med = float(np.nanmedian(r)) if len(r) and np.isfinite(r).any() else 1.0
    med = med if np.isfinite(med) and med > 0 else 1.0
    if valid.sum() < least:
        return np.full(len(a), med), False
    x0, y0 = np.where(valid, a, 0.0), np.where(valid, b, 0.0)
    x = np.full(len(a), med)
    for _ in range(max(1, rounds)):
        res = x * x0 - y0
        w = (sigma**2 / (sigma**2 + res**2)) ** 2 * valid
        x = _banded_solve(w * x0 * x0 + 1e-6, lam, w * x0 * y0)
    return np.clip(x, lo, hi), True


def smooth_scale(df: DataFrame, key: list[str], frame: str, a: str, b: str, valid: str, lam: float = 50.0, sigma: float = 0.1, least: int = 8) -> DataFrame:
    """``key, frame, alpha, applied`` per clip by ``fit_scale`` over the frames in order."""
    kinds = dict(df.dtypes)
    head = [*key, frame]

    def one(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(frame)
        x, ok = fit_scale(p[a].to_numpy(float), p[b].to_numpy(float), p[valid].fillna(False).to_numpy(bool), lam, sigma, least=least)
        return p[head].assign(alpha=x, applied=ok)

    return per_key(df.select(*head, a, b, valid), key, ", ".join(f"`{c}` {kinds[c]}" for c in head) + ", alpha double, applied boolean", one)


def metric_scale(slam: np.ndarray, pred: np.ndarray, masked: np.ndarray | None = None, near: float = 0.4, far: float = 0.7, sigma: float = 0.5) -> float:
    """Scale of ``slam`` depths onto predicted ones: ten rounds of medians over depths in range, then the minimum of a robust mean cost.

    NaN if no pixel is ever in range.
    """
    slam, pred = np.asarray(slam, float).ravel(), np.asarray(pred, float).ravel()
    free = np.ones(len(pred), bool) if masked is None else np.asarray(masked, float).ravel() < 0.5
    fits = free & (near < pred) & (pred < far)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = pred / slam
    if not fits.any():
        return float("nan")
    s = float(np.median(ratio[fits]))
    use = fits
    for _ in range(10):
        use = fits & (slam * s > 0) & (slam * s < far)
        if not use.any():
            break
        s = float(np.median(ratio[use]))
    use = fits & (slam * s > 0) & (slam * s < far) if use.any() else use
    if not use.any():
        return float("nan")
    x, y = slam[use], pred[use]
    cost = lambda k: float(np.mean(sigma**2 * (x * k - y) ** 2 / (sigma**2 + (x * k - y) ** 2)))
    # the cost is smooth and close to convex about the median: golden section on a bracket around it
    lo, hi, g = s * 0.5, s * 1.5, (5**0.5 - 1) / 2
    c, d = hi - g * (hi - lo), lo + g * (hi - lo)
    for _ in range(80):
        if cost(c) < cost(d):
            hi, d = d, c
            c = hi - g * (hi - lo)
        else:
            lo, c = c, d
            d = lo + g * (hi - lo)
    return (lo + hi) / 2


def clip_scales(df: DataFrame, clip: str, slam: str, pred: str, near: float = 0.4, far: float = 0.7, widen: int = 3) -> DataFrame:
    """``scale`` per clip: median over key frames of ``metric_scale``; the range is widened up to ``widen`` times while a key frame has none."""
    kinds = dict(df.dtypes)

    def one(p: pd.DataFrame) -> pd.DataFrame:
        got = []
        for x, y in zip(p[slam], p[pred]):
            for k in range(widen + 1):
                s = metric_scale(np.asarray(x), np.asarray(y), None, near / (1 + k), far * (1 + k))
                if np.isfinite(s):
                    got.append(s)
                    break
        return pd.DataFrame({clip: [p[clip].iloc[0]], "scale": [float(np.median(got)) if got else float("nan")], "keyframes": [len(got)]})

    return per_key(df.select(clip, slam, pred), [clip], f"`{clip}` {kinds[clip]}, scale double, keyframes bigint", one)


def prune_and_fill(boxes: np.ndarray, ratio: float = 2.5) -> np.ndarray:
    """Boxes (T, 5) with jumps in size removed and gaps filled by straight lines, extended beyond the ends.

    From detection to next detection as they were: where the areas differ by more than ``ratio`` the one of less confidence goes (the
    later one of equals). Only the areas are taken from before; what was removed keeps its turn in the comparison.
    """
    out = boxes.astype(float).copy()
    have = np.flatnonzero((out != 0).any(axis=1))
    area = (out[:, 2] - out[:, 0]) * (out[:, 3] - out[:, 1])
    keep = (out != 0).any(axis=1)
    for i, j in zip(have[:-1], have[1:]):
        if area[i] > 0 and area[j] > 0 and max(area[i], area[j]) / min(area[i], area[j]) > ratio:
            k = i if out[i, 4] < out[j, 4] else j
            out[k], keep[k] = 0, False
    at, gone = np.flatnonzero(keep), np.flatnonzero(~keep)
    if not len(at) or not len(gone) or len(at) < 2:
        return out
    left = np.clip(np.searchsorted(at, gone) - 1, 0, len(at) - 2)
    a, b = at[left], at[left + 1]
    u = ((gone - a) / (b - a))[:, None]
    out[gone] = out[a] + u * (out[b] - out[a])
    return out


def filled_boxes(df: DataFrame, key: list[str], frame: str, ratio: float = 2.5) -> DataFrame:
    """``x1, y1, x2, y2, conf`` per track by ``prune_and_fill``, rows in frame order."""
    kinds, cols = dict(df.dtypes), ["x1", "y1", "x2", "y2", "conf"]
    head = [*key, frame]

    def one(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(frame)
        return pd.concat([p[head].reset_index(drop=True), pd.DataFrame(prune_and_fill(p[cols].fillna(0).to_numpy(float), ratio), columns=cols)], axis=1)

    return per_key(df.select(*head, *cols), key, ", ".join(f"`{c}` {kinds[c]}" for c in head) + ", " + ", ".join(f"{c} double" for c in cols), one)


def velocity_valid(df: DataFrame, key: list[str], frame: str, most: float = 3.0) -> DataFrame:
    """``valid``: the centre moved less than ``most`` mean diagonals since the row before; a track's first row is valid."""
    c = F.struct(((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"), F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2)).alias("d"))
    w = Window.partitionBy(*key).orderBy(frame)
    d = df.withColumn("__c", c).withColumn("__p", F.lag("__c").over(w))
    move = F.sqrt(F.pow(F.col("__c.x") - F.col("__p.x"), 2) + F.pow(F.col("__c.y") - F.col("__p.y"), 2))
    mean = (F.col("__c.d") + F.col("__p.d")) / 2
    rel = F.when(mean > 0, move / mean).otherwise(0.0)
    return d.withColumn("valid", F.col("__p").isNull() | (rel < most)).drop("__c", "__p")


def gate_edges(df: DataFrame, clip: str, order: list[str], width: Column, height: Column, margin: float = 0.1, least: float = 0.4, gap: int = 10) -> DataFrame:
    """Detections after edge gating: per frame the first right and the first left hand that pass.

    A box whose centre is near the border, or whose track comes back after more than ``gap`` frames, needs confidence ``least``. What a
    track was last seen at depends on what passed, so rows are walked in order per clip.
    """
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    near = (cx < width * margin) | (cx > width * (1 - margin)) | (cy < height * margin) | (cy > height * (1 - margin))
    d = df.withColumn("is_near_edge", near).where(~(near & (F.col("conf") < least)))
    kinds = dict(d.dtypes)

    def walk(p: pd.DataFrame) -> pd.DataFrame:
        seen: dict = {}
        taken: set = set()
        keep = []
        p = p.sort_values(order)
        for t, k, c, h in zip(p["frame"], p["track_id"], p["conf"], p["handedness"]):
            ok = not (k in seen and t - seen[k] > gap and c < least) and (t, h > 0) not in taken
            keep.append(ok)
            if ok:
                seen[k] = t
                taken.add((t, h > 0))
        return p[keep]

    return per_key(d, [clip], ", ".join(f"`{c}` {kinds[c]}" for c in d.columns), walk)


def hands_of_tracks(df: DataFrame, clip: str, track: str) -> DataFrame:
    """Tracks kept with their ``hand`` (0 left, 1 right): five rows or more, mean confidence of detections 0.3, at most 70 % at the edge."""
    det = F.col("det")
    g = df.groupBy(clip, track).agg(F.count("*").alias("n"), F.avg(F.when(det, F.col("conf"))).alias("c"), F.avg(F.col("is_near_edge").cast("int")).alias("e"), F.avg(F.when(det, (F.col("handedness") > 0).cast("double"))).alias("r"))
    return g.where((F.col("n") >= 5) & (F.col("c") >= 0.3) & (F.coalesce("e", F.lit(0.0)) <= 0.7)).select(clip, track, F.when(F.col("r") < 0.5, 0).otherwise(1).alias("hand"))


def track_inputs(df: DataFrame, key: list[str], frame: str) -> DataFrame:
    """Rows of a track fit for inference, with ``chunk`` (runs of successive frames) and ``is_right`` (the majority).

    Between a track's first and last box, gaps are filled, jumps in size and place dropped, and boxes without area removed.
    """
    box = F.array("x1", "y1", "x2", "y2", "conf")
    has = F.exists(box, lambda v: F.coalesce(v != 0, F.lit(False)))
    span = df.groupBy(*key).agg(F.min(F.when(has, F.col(frame))).alias("__a"), F.max(F.when(has, F.col(frame))).alias("__z"), F.count_if("det").alias("__d")).where("__d >= 2 and __a is not null")
    d = df.join(span, key).where(F.col(frame).between(F.col("__a"), F.col("__z")))
    f = filled_boxes(d, key, frame).join(d.select(*key, frame, "handedness"), [*key, frame])
    f = velocity_valid(f, key, frame).where(F.col("valid") & G.is_finite(F.array("x1", "y1", "x2", "y2")) & (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))
    w = Window.partitionBy(*key)
    f = f.withColumn("is_right", F.avg((F.col("handedness") > 0).cast("double")).over(w) >= 0.5)
    f = f.withColumn("__g", F.col(frame) - F.row_number().over(w.orderBy(frame)))
    return f.withColumn("chunk", F.dense_rank().over(w.orderBy("__g")) - 1).drop("__g", "valid", "handedness")


def overlap_ratios(depths: DataFrame, clip: str, chunk: str, frame: str, pixel: str, depth: str, least: int = 500, most_mad: float = 0.25) -> DataFrame:
    """``ratio, trusted`` of each chunk against the one before, from the frames they share (equi self join, then medians).

    Per shared frame the median and the spread (MAD) of the pixels' log ratio; a frame counts with ``least`` pixels, and is clean within
    ``most_mad``. The link is the median over clean frames; without one it isn't trusted.
    """
    ok = F.col(depth).isNotNull() & ~F.isnan(depth) & (F.col(depth) > 0.05) & (F.col(depth) < float("inf"))
    v = depths.where(ok).select(clip, chunk, frame, pixel, F.ln(depth).alias("l"))
    a = v.withColumn(chunk, F.col(chunk) + 1).withColumnRenamed("l", "__a")
    d = v.join(a, [clip, chunk, frame, pixel]).withColumn("lr", F.col("__a") - F.col("l"))
    m = d.groupBy(clip, chunk, frame).agg(F.percentile("lr", 0.5).alias("m"), F.count("*").alias("n")).where(F.col("n") >= least)
    s = d.join(m, [clip, chunk, frame]).groupBy(clip, chunk, frame).agg(F.first("m").alias("m"), F.percentile(F.abs(F.col("lr") - F.col("m")), 0.5).alias("mad"))
    clean = F.when(F.col("mad") <= most_mad, F.col("m"))
    g = s.groupBy(clip, chunk).agg(F.percentile(clean, 0.5).alias("c"), F.percentile("m", 0.5).alias("any"))
    return g.select(clip, chunk, F.exp(F.coalesce("c", "any")).alias("ratio"), F.col("c").isNotNull().alias("trusted"))


def depth_targets(joints: DataFrame, pixels: DataFrame, clip: str, frame: str, near: float = 0.05, far: float = 5.0, least: int = 50) -> DataFrame:
    """``z, d, valid`` per frame: median camera depth of the hand joints in front, and median depth inside the hand mask.

    ``joints`` has a depth ``z`` each, ``pixels`` a ``depth`` of each masked pixel. Both medians must exist.
    """
    z = joints.where("z > 0 and z < double('inf') and not isnan(z)").groupBy(clip, frame).agg(F.percentile("z", 0.5).alias("z"))
    ok = F.col("depth").between(near, far) & ~F.isnan("depth")
    d = pixels.where(ok).groupBy(clip, frame).agg(F.percentile("depth", 0.5).alias("d"), F.count("*").alias("__n")).where(F.col("__n") >= least)
    return joints.select(clip, frame).distinct().join(z, [clip, frame], "left").join(d.drop("__n"), [clip, frame], "left").withColumn("valid", F.col("z").isNotNull() & F.col("d").isNotNull())


def disparity_raster(patches: DataFrame, clip: str, key: str, height: int, width: int, low: float = 0.01) -> DataFrame:
    """``iy, ix, disp`` of each key frame: mean of the positive patches of a cell, the key frame's median in empty cells, ``low`` without any."""
    ok = patches.where("disp > 1e-6")
    cell = lambda c, n: F.least(F.greatest(F.rint(c), F.lit(0)), F.lit(n - 1)).cast("int")
    mean = ok.groupBy(clip, key, cell("y", height).alias("iy"), cell("x", width).alias("ix")).agg(F.avg("disp").alias("v"))
    med = ok.groupBy(clip, key).agg(F.percentile("disp", 0.5).alias("m"))
    grid = patches.select(clip, key).distinct().select("*", F.explode(F.sequence(F.lit(0), F.lit(height - 1))).alias("iy")).select("*", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("ix"))
    return grid.join(med, [clip, key], "left").join(mean, [clip, key, "iy", "ix"], "left").select(clip, key, "iy", "ix", F.coalesce("v", "m", F.lit(low)).alias("disp"))
