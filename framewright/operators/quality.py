"""Clip quality: per-frame checks, motion and visibility metrics, data-set fences, reasons and reports.

Frames come as ``clip_id, frame_idx, lowdim array<double>, presence int`` and, where used, ``instruction array<string>``,
``instruction_num``, ``width`` and ``height``. Everything is one shuffle by clip, windows, and one partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions import geometry as G
from framewright.functions.text import instruction_flags
from framewright.session import checkpointed, fits_broadcast, written

HANDS = (("left", 1), ("right", 2))
AXES = ("x", "y", "z")


def frame_flags(frames: DataFrame) -> DataFrame:
    """Frames with ``state``: ``sane``, ``missing`` (no vector of the right size), ``nonfinite`` or ``insane``, and ``issues``."""
    a = F.col("lowdim")
    state = F.when(a.isNull() | (F.size(a) != G.LOWDIM_SIZE), "missing").when(~G.is_finite(a), "nonfinite")
    d = frames.withColumn("issues", F.when(state.isNull(), G.lowdim_issues(a)).otherwise(F.array().cast("array<string>")))
    return d.withColumn("state", F.coalesce(state, F.when(F.size("issues") > 0, "insane").otherwise("sane")))


def step_metrics(flags: DataFrame) -> DataFrame:
    """Steps from the frame before, per frame of gap: ``hand_step, finger_step, cam_t_step, cam_r_step, wrist_r_step``.

    Only between neighbouring rows that are both sane: a row that is not sane breaks the chain and is never bridged.
    """
    w = Window.partitionBy("clip_id").orderBy("frame_idx")
    d = flags.withColumn("__prev", F.lag(F.struct("frame_idx", "lowdim", "state")).over(w))
    ok = (F.col("state") == "sane") & (F.col("__prev.state") == "sane")
    gap = F.greatest(F.lit(1), F.col("frame_idx") - F.col("__prev.frame_idx"))
    now, old = F.col("lowdim"), F.col("__prev.lowdim")
    p = lambda a, n: G.part(a, n)
    move = lambda n: G.norm(G.subtract(p(now, n), p(old, n)))
    tips = lambda n: F.array_max(F.zip_with(G.points(p(now, n)), G.points(p(old, n)), lambda x, y: G.norm(G.subtract(x, y))))
    turn = lambda n: G.norm(G.subtract(G.rot6d_to_matrix(p(now, n)), G.rot6d_to_matrix(p(old, n))))
    cam = lambda f: G.norm(G.subtract(f(p(now, "w2c")), f(p(old, "w2c"))))
    steps = {
        "hand_step": F.greatest(move("left_wrist"), move("right_wrist")),
        "finger_step": F.greatest(tips("left_fingertips"), tips("right_fingertips")),
        "cam_t_step": cam(G.translation_of),
        "cam_r_step": cam(G.rotation_of),
        "wrist_r_step": F.greatest(turn("left_root_rot6d"), turn("right_root_rot6d")),
    }
    return d.withColumns({k: F.when(ok, v / gap) for k, v in steps.items()}).drop("__prev")


def wrist_window(flags: DataFrame, past: int, future: int) -> DataFrame:
    """Per sane frame the extremes, in its camera, of both wrists over frames ``-past .. +future`` that are present.

    A range window collects the wrist points (six numbers a frame) once; higher-order functions move them into the camera.
    """
    w = Window.partitionBy("clip_id").orderBy("frame_idx").rangeBetween(-past, future)
    sane = flags.where("state = 'sane'")
    d = sane.withColumn("__w", F.collect_list(F.slice("lowdim", 1, 6)).over(w))
    pts = F.flatten(F.transform("__w", lambda six: G.points(six)))
    cam = G.part(F.col("lowdim"), "w2c")
    d = d.withColumn("__p", F.transform(pts, lambda p: G.to_camera(p, cam)))
    return d.select("clip_id", "frame_idx", *[G.axis_extremes(F.col("__p"), i).alias(f"wrist_{a}") for i, a in enumerate(AXES)], G.largest_abs(F.col("__p")).alias("wrist_abs"))


def frame_extents(flags: DataFrame) -> DataFrame:
    """Per sane frame: wrists in the camera and fingertips relative to their wrists (axis extremes and largest coordinate)."""
    a = F.col("lowdim")
    wrists = F.transform(F.array(G.part(a, "left_wrist"), G.part(a, "right_wrist")), lambda p: G.to_camera(p, G.part(a, "w2c")))
    rel = lambda h: F.transform(G.points(G.part(a, f"{h}_fingertips")), lambda p: G.in_wrist_frame(p, G.part(a, f"{h}_wrist"), G.part(a, f"{h}_root_rot6d")))
    d = flags.where("state = 'sane'").withColumn("__w", wrists).withColumn("__f", F.concat(rel("left"), rel("right")))
    ext = lambda c, n: [G.axis_extremes(F.col(c), i).alias(f"{n}_{x}") for i, x in enumerate(AXES)] + [G.largest_abs(F.col(c)).alias(f"{n}_abs")]
    return d.select("clip_id", "frame_idx", *ext("__w", "wrist"), *ext("__f", "hand"))


def hand_views(flags: DataFrame, severe: float = 1.4) -> DataFrame:
    """Per sane frame and hand: ``vis`` and the view struct of the wrist and its tips (null if the hand is absent)."""
    a = F.col("lowdim")
    out = []
    for h, bit in HANDS:
        pts = F.concat(F.array(G.part(a, f"{h}_wrist")), G.points(G.part(a, f"{h}_fingertips")))
        vis = F.col("presence").bitwiseAND(bit) > 0
        out += [vis.alias(f"vis_{h}"), F.when(vis, G.hand_in_view(pts, G.part(a, "w2c"), G.part(a, "intrinsic"), F.col("width"), F.col("height"), severe)).alias(f"view_{h}")]
    return flags.where("state = 'sane'").select("clip_id", "frame_idx", *out)


def out_of_frame_streaks(views: DataFrame) -> DataFrame:
    """Longest run, per hand, of sane frames in which it is visible with no point in the frame; insane frames aren't in ``views``."""
    w = Window.partitionBy("clip_id").orderBy("frame_idx")
    d = views
    for h, _ in HANDS:
        out = F.coalesce(F.col(f"vis_{h}") & F.col(f"view_{h}.all_out"), F.lit(False))
        d = d.withColumn(f"__o_{h}", out.cast("int")).withColumn(f"__i_{h}", F.sum((~out).cast("int")).over(w))
    d = d.withColumns({f"__s_{h}": F.sum(f"__o_{h}").over(Window.partitionBy("clip_id", f"__i_{h}")) for h, _ in HANDS})
    return d.groupBy("clip_id").agg(*[F.max(f"__s_{h}").alias(f"max_visible_{h}_out_of_frame_streak") for h, _ in HANDS])


def clip_metrics(frames: DataFrame, past: int | None = 180, future: int = 30, severe: float = 1.4, with_views: bool = True) -> DataFrame:
    """One row of quality metrics per clip; ratios and extents of clips without data have fixed defaults.

    ``past`` None turns the wrist window off. Presence ratio and steps default to 0, the in-frame ratio to 1, extents to 0.
    """
    flags = written(frame_flags(frames))  # four aggregations read it
    ins = instruction_flags(F.col("instruction"), F.col("instruction_num")) if "instruction" in frames.columns else None
    d = step_metrics(flags)
    count = lambda c, n: F.count_if(c).cast("bigint").alias(n)
    agg = [
        F.count("*").alias("frames_total"), count(F.col("state") == "sane", "frames_kept_candidate"), count(F.col("state") == "nonfinite", "nonfinite_lowdim_frames"),
        count(F.col("state").isin("missing", "insane"), "invalid_lowdim_frames"),
        *[count(F.array_contains("issues", f"invalid_{k}"), f"invalid_{k}_frames") for k in ("rot6d", "extrinsic", "intrinsic")],
        (F.count_if(F.col("presence") > 0) / F.count("*")).alias("presence_ratio"),
        *[F.coalesce(F.max(c), F.lit(0.0)).alias(n) for c, n in (("hand_step", "max_hand_translation_step"), ("finger_step", "max_finger_translation_step"), ("cam_t_step", "max_camera_translation_step"), ("cam_r_step", "max_camera_rotation_step"), ("wrist_r_step", "max_wrist_rotation_step"))],
        F.coalesce(F.avg("cam_t_step"), F.lit(0.0)).alias("mean_camera_translation_step"), F.coalesce(F.avg("cam_r_step"), F.lit(0.0)).alias("mean_camera_rotation_step"),
    ]
    if ins is not None:
        d = d.withColumn("__ins", ins)
        agg += [F.max("__ins.n").alias("instruction_num_max"), count(F.col("__ins.missing"), "missing_instruction_frames"), count(F.col("__ins.empty"), "empty_instruction_frames"), count(F.col("__ins.mismatch"), "instruction_num_mismatch_frames")]
    out = d.groupBy("clip_id").agg(*agg)
    ext = frame_extents(flags)
    sides = [("hand", ext)] + ([("wrist", ext)] if past is None else [("wrist", wrist_window(flags, past, future))])
    for n, e in sides:
        g = e.groupBy("clip_id").agg(F.max(f"{n}_abs").alias(f"max_camera_space_{n}_abs"), *[x for a in AXES for x in (F.min(f"{n}_{a}.lo").alias(f"min_camera_space_{n}_{a}"), F.max(f"{n}_{a}.hi").alias(f"max_camera_space_{n}_{a}"))])
        out = out.join(g, "clip_id", "left").na.fill(0.0, [c for c in g.columns if c != "clip_id"])
    if with_views and {"width", "height"} <= set(frames.columns):
        v = hand_views(flags, severe)
        per = []
        for h, _ in HANDS:
            n = F.count_if(F.col(f"vis_{h}"))
            per += [
                n.alias(f"visible_{h}_frames"), F.coalesce(F.count_if(F.col(f"view_{h}.any_in")) / F.nullif(n, F.lit(0)), F.lit(1.0)).alias(f"visible_{h}_any_point_inframe_ratio"),
                F.coalesce(F.count_if(F.col(f"view_{h}.all_out")) / F.nullif(n, F.lit(0)), F.lit(0.0)).alias(f"visible_{h}_all_points_out_of_frame_ratio"), F.count_if(F.col(f"view_{h}.severe")).alias(f"fatal_visible_{h}_severe_offscreen_frames"),
            ]
        g = v.groupBy("clip_id").agg(*per).join(out_of_frame_streaks(v), "clip_id")
        ones = [c for c in g.columns if c.endswith("inframe_ratio")]
        out = out.join(g, "clip_id", "left").na.fill(1.0, ones).na.fill(0, [c for c in g.columns if c not in ("clip_id", *ones)])
    return out


def finite(c: Column) -> Column:
    """The value if it is a finite number, else null."""
    return F.when(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), c.cast("double"))


def exact_percentiles(df: DataFrame, columns: list[str], percents: list[float], by: list[str] | None = None) -> DataFrame:
    """Per ``by`` and column ``metric, n, min, max, p``: exact percentiles of the finite values, linear between neighbours.

    No task holds a column: equal values are counted first (map-side combined, so a value that a third of all rows have is one row), the
    counts are cut into ranges of values, and a running sum with an offset a range tells which ranks a value takes.
    """
    by = by or []
    keys = [*by, "metric"]
    long = df.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), finite(F.col(c)).alias("x")) for c in columns])).alias("r"))
    cells = long.where("r.x is not null").groupBy(*by, F.col("r.metric").alias("metric"), F.col("r.x").alias("x")).agg(F.count("*").alias("c"))
    cells = checkpointed(cells.repartitionByRange(*keys, "x").withColumn("__p", F.spark_partition_id()))
    part = cells.groupBy("__p", *keys).agg(F.sum("c").alias("__c"), F.min("x").alias("__lo"), F.max("x").alias("__hi"))
    whole = Window.partitionBy(*keys)
    base = checkpointed(part.select("__p", *keys, (F.sum("__c").over(whole.orderBy("__p")) - F.col("__c")).alias("__b"), F.sum("__c").over(whole).alias("n"), F.min("__lo").over(whole).alias("min"), F.max("__hi").over(whole).alias("max")))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in ("__p", *keys)]
    side = F.broadcast(base) if fits_broadcast(base) else base
    w = Window.partitionBy("__p", *keys).orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    d = cells.withColumn("last", F.sum("c").over(w)).alias("a").join(side.alias("b"), same).select(*[f"a.{k}" for k in keys], "x", "n", "min", "max", (F.col("__b") + F.col("last") - F.col("c")).alias("first"), (F.col("__b") + F.col("last") - 1).alias("last"))
    at = [(F.col("n") - 1) * float(p) for p in percents]
    rank = lambda r: F.max(F.when((F.col("first") <= r) & (r <= F.col("last")), F.col("x")))
    g = d.groupBy(*keys, "n", "min", "max").agg(*[y for i, t in enumerate(at) for y in (rank(F.floor(t)).alias(f"__a{i}"), rank(F.ceil(t)).alias(f"__z{i}"))])
    between = [F.col(f"__a{i}") + (F.col(f"__z{i}") - F.col(f"__a{i}")) * (t - F.floor(t)) for i, t in enumerate(at)]
    return g.select(*keys, "n", "min", "max", F.array(*between).alias("p"))


def one_row(percentiles: DataFrame, columns: list[str]) -> DataFrame:
    """``exact_percentiles`` of whole columns as one row, the array of each under its name (null without finite value)."""
    return percentiles.groupBy().agg(*[F.max(F.when(F.col("metric") == c, F.col("p"))).alias(c) for c in columns])


def iqr_fences(df: DataFrame, columns: list[str], multiplier: float = 2.5, by: list[str] | None = None) -> DataFrame:
    """Per column ``metric, n, q1, q3, iqr, lo, hi, min, max``: exact linear quartiles of the finite values and their fences.

    A column without finite value has no row.
    """
    rows = exact_percentiles(df, columns, [0.25, 0.75], by)
    q1, q3 = F.col("p")[0], F.col("p")[1]
    return rows.select(*(by or []), "metric", "n", q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"), (q1 - multiplier * (q3 - q1)).alias("lo"), (q3 + multiplier * (q3 - q1)).alias("hi"), "min", "max")


def metric_percentiles(df: DataFrame, columns: list[str], percents: tuple = (0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    """Per column ``metric, n, p50, p90, p95, p99, max`` of the finite values, exact."""
    rows = exact_percentiles(df, columns, list(percents))
    return rows.select("metric", "n", *[F.col("p")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(percents)], "max")


def axis_bounds(metrics: DataFrame, prefix: str, multiplier: float = 2.5, cap: float | None = 1.5) -> DataFrame:
    """One row ``lower_x, upper_x ..``: fence below the clips' minima and above their maxima, within plus or minus ``cap``."""
    names = _axis_metrics(prefix)
    return one_row(exact_percentiles(metrics, names, [0.25, 0.75]), names).select(*_axis_fences(prefix, multiplier, cap))


def _axis_metrics(prefix: str) -> list[str]:
    return [f"{side}_camera_space_{prefix}_{a}" for a in AXES for side in ("min", "max")]


def _axis_fences(prefix: str, multiplier: float, cap: float | None, out: str = "") -> list[Column]:
    low = lambda c: F.col(c)[0] - multiplier * (F.col(c)[1] - F.col(c)[0])
    high = lambda c: F.col(c)[1] + multiplier * (F.col(c)[1] - F.col(c)[0])
    bound = (lambda f, x, c: x) if cap is None else (lambda f, x, c: f(x, F.lit(float(c))))
    return [y for a in AXES for y in (bound(F.greatest, low(f"min_camera_space_{prefix}_{a}"), -(cap or 0)).alias(f"{out}lower_{a}"), bound(F.least, high(f"max_camera_space_{prefix}_{a}"), cap).alias(f"{out}upper_{a}"))]


def thresholds(metrics: DataFrame, criteria: dict) -> DataFrame:
    """One row of resolved thresholds over the clips with a usable frame.

    ``camera_space_auto_method`` ``iqr_bounds`` (default) gives axis bounds, ``percentile_abs`` scales a percentile of the largest coordinates;
    manual caps (``max_camera_space_wrist_abs`` ..) win. The two fences of the mean camera steps are always resolved;
    ``use_auto_camera_space_thresholds`` False resolves nothing unless a manual cap is given. All percentiles come from one pass.
    """
    use = metrics.where("frames_kept_candidate > 0")
    manual = {n: criteria.get(f"max_camera_space_{n}_abs") for n in ("wrist", "hand")}
    any_manual = any(v is not None for v in manual.values())
    null = F.lit(None).cast("double")
    if not criteria.get("use_auto_camera_space_thresholds", True) and not any_manual:
        return metrics.sparkSession.range(1).select(*[null.alias(c) for c in threshold_columns()])
    m, k = float(criteria.get("episode_camera_iqr_multiplier", 2.5)), float(criteria.get("camera_space_iqr_multiplier", 2.5))
    cap = criteria.get("camera_space_axis_abs_cap", 1.5)
    p, s = float(criteria.get("camera_space_abs_percentile", 99.0)) / 100, float(criteria.get("camera_space_abs_scale", 2.5))
    iqr = not any_manual and criteria.get("camera_space_auto_method", "iqr_bounds") == "iqr_bounds"
    names = [f"mean_camera_{x}_step" for x in ("translation", "rotation")] + ([c for n in manual for c in _axis_metrics(n)] if iqr else [f"max_camera_space_{n}_abs" for n in manual])
    row = one_row(exact_percentiles(use, names, [0.25, 0.75, p]), names)
    q = lambda x, i: F.col(f"mean_camera_{x}_step")[i]
    fence = [y for x in ("translation", "rotation") for y in ((q(x, 0) - m * (q(x, 1) - q(x, 0))).alias(f"episode_{x}_lower"), (q(x, 1) + m * (q(x, 1) - q(x, 0))).alias(f"episode_{x}_upper"))]
    caps = [(null if iqr else F.lit(float(v)) if v is not None else F.col(f"max_camera_space_{n}_abs")[2] * s).alias(f"{n}_abs") for n, v in manual.items()]
    sides = [y for n in manual for y in (_axis_fences(n, k, cap, f"{n}_") if iqr else [null.alias(f"{n}_{side}_{a}") for a in AXES for side in ("lower", "upper")])]
    return row.select(*fence, *caps, *sides).select(*threshold_columns())


def threshold_columns() -> list[str]:
    return [f"episode_{x}_{s}" for x in ("translation", "rotation") for s in ("lower", "upper")] + ["wrist_abs", "hand_abs"] + [f"{n}_{s}_{a}" for n in ("wrist", "hand") for a in AXES for s in ("lower", "upper")]


def bounds_exceeded(prefix: str, lower: dict, upper: dict) -> Column:
    """Any axis with its minimum below its lower or its maximum above its upper bound; a null bound never is."""
    no = F.lit(False)
    out = no
    for a in AXES:
        out = out | F.coalesce(F.col(f"min_camera_space_{prefix}_{a}") < lower[a], no) | F.coalesce(F.col(f"max_camera_space_{prefix}_{a}") > upper[a], no)
    return out


def quality_rules(columns: list[str], criteria: dict) -> list[tuple[str, Column]]:
    """Reasons, in the order in which they are listed, with their conditions on clip metrics joined with one threshold row.

    A cap in ``criteria`` that is absent or None never fires; equality is kept. Metrics the table doesn't have never fire. Instructions are
    required of every frame unless ``hard_rules.require_instruction_every_frame`` is false.
    """
    c, get = F.col, criteria.get
    over = lambda m, k: c(m) > float(get(k)) if get(k) is not None else None
    under = lambda m, k: c(m) < float(get(k)) if get(k) is not None else None
    need = bool((get("hard_rules") or {}).get("require_instruction_every_frame", True))
    cap = get("camera_space_axis_abs_cap", 1.5)
    sided = lambda n: bounds_exceeded(n, {a: c(f"{n}_lower_{a}") for a in AXES}, {a: c(f"{n}_upper_{a}") for a in AXES})
    capped = lambda n: (c(f"{n}_lower_x").isNull() & bounds_exceeded(n, dict.fromkeys(AXES, F.lit(-float(cap))), dict.fromkeys(AXES, F.lit(float(cap))))) if cap is not None else None
    rules: list[tuple[str, str, Column | None]] = [
        *[(k, f"{k}_frames", c(f"{k}_frames") > 0) for k in ("incomplete_sample", "invalid_meta", "invalid_lowdim", "invalid_rot6d", "invalid_extrinsic", "invalid_intrinsic", "nonfinite_lowdim")],
        *[(f"{k}_frame", f"{k}_frames", c(f"{k}_frames") > 0 if need else None) for k in ("missing_instruction", "empty_instruction", "instruction_num_mismatch")],
        *[(f"fatal_visible_{h}_severe_offscreen", f"fatal_visible_{h}_severe_offscreen_frames", c(f"fatal_visible_{h}_severe_offscreen_frames") > 0) for h, _ in HANDS],
        *[(f"visible_{h}_inframe_ratio_below_min", f"visible_{h}_frames", (c(f"visible_{h}_frames") > 0) & under(f"visible_{h}_any_point_inframe_ratio", "min_visible_hand_any_point_inframe_ratio") if get("min_visible_hand_any_point_inframe_ratio") is not None else None) for h, _ in HANDS],
        *[(f"visible_{h}_out_of_frame_streak_exceeded", f"max_visible_{h}_out_of_frame_streak", over(f"max_visible_{h}_out_of_frame_streak", "max_visible_hand_all_points_out_of_frame_streak")) for h, _ in HANDS],
        ("instruction_num_below_min", "instruction_num_max", under("instruction_num_max", "min_instruction_num")),
        ("presence_ratio_below_min", "presence_ratio", under("presence_ratio", "min_presence_ratio")),
        *[(f"{k}_step_exceeded", f"max_{k}_step", over(f"max_{k}_step", f"max_{k}_step")) for k in ("hand_translation", "finger_translation", "camera_translation", "camera_rotation", "wrist_rotation")],
        *[(f"camera_space_{n}_abs_exceeded", f"max_camera_space_{n}_abs", c(f"max_camera_space_{n}_abs") > c(f"{n}_abs")) for n in ("wrist", "hand")],
        *[(f"camera_space_{n}_iqr_bounds_exceeded", f"min_camera_space_{n}_x", sided(n)) for n in ("wrist", "hand")],
        *[(f"camera_space_{n}_axis_abs_cap_exceeded", f"min_camera_space_{n}_x", capped(n)) for n in ("wrist", "hand")],
        *[(f"episode_camera_{x}_iqr_exceeded", f"mean_camera_{x}_step", (c(f"mean_camera_{x}_step") < c(f"episode_{x}_lower")) | (c(f"mean_camera_{x}_step") > c(f"episode_{x}_upper"))) for x in ("translation", "rotation")],
    ]
    return [(n, F.coalesce(cond, F.lit(False))) for n, col, cond in rules if cond is not None and col in columns]


def decide(metrics: DataFrame, criteria: dict | None = None, limits: DataFrame | None = None) -> DataFrame:
    """Metrics with ``reasons`` (in order) and ``keep``. The one threshold row is broadcast to the clips."""
    criteria = criteria or {}
    limits = limits if limits is not None else thresholds(metrics, criteria)
    d = metrics.crossJoin(F.broadcast(limits))
    rules = quality_rules(d.columns, criteria)
    d = d.withColumn("reasons", F.array_compact(F.array(*[F.when(cond, n) for n, cond in rules])) if rules else F.array().cast("array<string>"))
    return d.withColumn("keep", F.size("reasons") == 0).drop(*limits.columns)


def drop_report(decided: DataFrame, reasons: str = "reasons") -> DataFrame:
    """``reason, clips``: clips per reason, and ``kept``, ``dropped`` and ``total``."""
    d = decided.select(F.when(F.size(reasons) > 0, F.concat(F.array(F.lit("total"), F.lit("dropped")), F.array_distinct(reasons))).otherwise(F.array(F.lit("total"), F.lit("kept"))).alias("r"))
    return d.select(F.explode("r").alias("reason")).groupBy("reason").agg(F.count("*").alias("clips"))


def native_vectors_valid(frames: DataFrame, clip: str = "clip_id", frame: str = "frame_idx", tol: float = 1e-4) -> DataFrame:
    """Clips whose vectors are finite, sized right, and whose action is the next frame's state (absolute and relative ``tol``)."""
    a = F.col("lowdim")
    nxt = F.lead(G.part(a, "state")).over(Window.partitionBy(clip).orderBy(frame))
    d = frames.select(clip, (F.coalesce(F.size(a) == G.LOWDIM_SIZE, F.lit(False)) & G.is_finite(a)).alias("ok"), F.coalesce(F.forall(F.zip_with(G.part(a, "action"), nxt, lambda x, y: F.abs(x - y) <= tol + tol * F.abs(y)), lambda b: b), F.lit(True)).alias("follows"))
    return d.groupBy(clip).agg(F.bool_and("ok").alias("finite"), F.bool_and("follows").alias("action_is_next_state")).withColumn("valid", F.col("finite") & F.col("action_is_next_state"))


def largest_step(frames: DataFrame, clip: str, frame: str, point: str, valid: Column | None = None) -> DataFrame:
    """Largest move of a point between neighbouring frames, both valid, and the first pair that has it."""
    w = Window.partitionBy(clip).orderBy(frame)
    ok = valid if valid is not None else F.lit(True)
    d = frames.select(clip, frame, point, ok.alias("__ok")).withColumn("__p", F.lag(F.struct(F.col(frame).alias("f"), F.col(point).alias("x"), F.col("__ok").alias("ok"))).over(w))
    d = d.where("__ok and __p.ok").withColumn("step", G.norm(G.subtract(F.col(point), F.col("__p.x"))))
    return d.groupBy(clip).agg(F.max_by(F.struct("step", F.col("__p.f").alias("from_frame"), F.col(frame).alias("to_frame")), F.struct("step", -F.col(frame))).alias("r")).select(clip, "r.*")


def hand_depth_anchor(ratios: DataFrame, clip: str, ratio: str, least: int = 8, lo: float = 0.5, hi: float = 2.0) -> DataFrame:
    """``k, reason``: median of the finite, positive ratios kept within bounds; 1 with a reason for too few frames."""
    r = finite(F.col(ratio))
    g = ratios.groupBy(clip).agg(F.percentile(F.when(r > 0, r), 0.5).alias("__m"), F.count(F.when(r > 0, r)).alias("frames"))
    return g.select(clip, "frames", F.when(F.col("frames") >= least, F.least(F.greatest("__m", F.lit(lo)), F.lit(hi))).otherwise(1.0).alias("k"), F.when(F.col("frames") < least, "too_few_frames").alias("reason"))


def stabilised_shape(frames: DataFrame, key: list[str], frame: str, betas: str, trans: str, size: str, lo: float = 0.5, hi: float = 2.0) -> DataFrame:
    """Shape parameters replaced by their medians per clip, and the translation scaled by the change of hand size.

    ``size`` is the hand's size under each frame's own shape; its median stands for the common shape's size.
    """
    e = frames.select(*key, F.posexplode(betas).alias("p", "b")).groupBy(*key, "p").agg(F.percentile("b", 0.5).alias("m"))
    med = e.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "m"))), lambda s: s["m"]).alias("__b"))
    s = frames.groupBy(*key).agg(F.percentile(size, 0.5).alias("__s"))
    k = F.least(F.greatest(F.col("__s") / F.nullif(F.col(size), F.lit(0.0)), F.lit(lo)), F.lit(hi))
    d = frames.join(med, key).join(s, key)
    return d.withColumn(trans, F.transform(trans, lambda x: x * F.coalesce(k, F.lit(1.0)))).withColumn(betas, F.col("__b")).drop("__b", "__s")
