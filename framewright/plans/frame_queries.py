"""Queries over 116-number frame vectors, which are made from ``embeddings`` by one stated recipe in both languages.

A clip is 25 vectors, with a gap of two frames after the fifteenth; rotations are turns by an angle taken from the vector, and numbers of
``vec_id`` decide which frames lack their vector, hold a NaN or fail a check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.functions import geometry as G
from framewright.functions import text as T
from framewright.operators import annotation, quality, reports, windows
from framewright.plans import pipeline
from framewright.session import checkpointed, load

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r6(c: Column | str) -> Column:
    """Rounded, without a negative zero."""
    return F.round(c, 6) + 0.0


def _tips(first: int, start: int) -> str:
    return "[" + ", ".join(f"v[{first + i % 3}] + 0.1 * v[{start + i}]" for i in range(15)) + "]"


FR = f"""b as (select vec_id, 'c' || lpad((vec_id // 25)::varchar, 4, '0') as clip, vec_id % 25 + case when vec_id % 25 >= 15 then 2 else 0 end as f, list_transform(embedding, lambda x: x::double) as v from embeddings),
s as (select *, cos(8 * v[7]) as cl, sin(8 * v[7]) as sl, cos(8 * v[8]) as cr, sin(8 * v[8]) as sr, cos(v[39]) as cw, sin(v[39]) as sw, vec_id % 59 = 17 as lacks, vec_id % 53 = 13 as has_nan, vec_id % 41 = 7 as bad_rot, vec_id % 43 = 9 as bad_ext, vec_id % 47 = 11 as bad_int,
(case when vec_id % 31 = 5 then 2000 when vec_id % 50 >= 25 then 630 else 320 end)::double as cx, vec_id % 4 as presence from b),
t as (select *, list_concat([v[1], v[2], v[3], v[4], v[5], v[6], cl, sl, 0, case when bad_rot then cl else -sl end, case when bad_rot then sl else cl end, 0, cr, sr, 0, -sr, cr, 0], {_tips(1, 9)}, {_tips(4, 24)}) as state from s),
u as (select *, coalesce(lead(state) over w, state) as act, coalesce(lead(bad_rot) over w, bad_rot) as next_rot from t window w as (partition by clip order by f)),
fr as (select *, case when lacks then 'missing' when has_nan then 'nonfinite' when bad_rot or next_rot or bad_ext or bad_int then 'insane' else 'sane' end as st from u)"""


def frames116(s: SparkSession, d: str) -> DataFrame:
    """``vec_id, clip_id, frame_idx, lowdim, presence, width, height, instruction, instruction_num``."""
    v, n = F.col("v"), F.col("vec_id")
    at = lambda i: F.get(v, F.lit(i - 1))  # noqa: E731  (from 1, as in SQL)
    vec = lambda *xs: F.array(*[(x if isinstance(x, Column) else F.lit(float(x))).cast("double") for x in xs])
    turn = lambda i, bad=None: (lambda c, q: vec(c, q, 0, -q if bad is None else F.when(bad, c).otherwise(-q), c if bad is None else F.when(bad, q).otherwise(c), 0))(F.cos(8 * at(i)), F.sin(8 * at(i)))
    tips = lambda first, start: F.array(*[at(first + i % 3) + 0.1 * at(start + i) for i in range(15)])
    b = load(s, d, "embeddings").select("vec_id", F.format_string("c%04d", F.floor(n / 25)).alias("clip_id"), (n % 25 + F.when(n % 25 >= 15, 2).otherwise(0)).alias("frame_idx"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    b = b.select("vec_id", "clip_id", "frame_idx", "v", vec(at(1), at(2), at(3)).alias("lw"), vec(at(4), at(5), at(6)).alias("rw"), turn(7, n % 41 == 7).alias("lr"), turn(8).alias("rr"), tips(1, 9).alias("lt"), tips(4, 24).alias("rt"))
    state = F.concat("lw", "rw", "lr", "rr", "lt", "rt")
    b = b.withColumn("state", state)
    b = windows.next_state(b, "clip_id", ["frame_idx"], "state", F.col("state"))
    cw, sw = F.cos(at(39)), F.sin(at(39))
    w2c = vec(cw, -sw, 0, F.when(n % 53 == 13, float("nan")).otherwise(at(40)), sw, cw, 0, at(41), 0, 0, 1, 3 + at(42), 0, 0, 0, F.when(n % 43 == 9, 2.0).otherwise(1.0))
    k = vec(F.when(n % 47 == 11, -1.0).otherwise(500.0), 500, F.when(n % 31 == 5, 2000.0).when(n % 50 >= 25, 630.0).otherwise(320.0), 240)
    low = G.assemble_lowdim(F.col("lw"), F.col("rw"), F.col("lr"), F.col("rr"), F.col("lt"), F.col("rt"), F.col("action"), w2c, k)
    words = F.when(n % 7 == 0, F.array().cast("array<string>")).when(n % 7 == 1, F.array(F.lit(""), F.lit(" "))).when(n % 7 == 2, F.array(F.lit("a"))).otherwise(F.array(F.lit("pick up"), F.lit("move")))
    return b.select("vec_id", "clip_id", "frame_idx", F.when(n % 59 != 17, low).alias("lowdim"), (n % 4).cast("int").alias("presence"), F.lit(640).alias("width"), F.lit(480).alias("height"), words.alias("instruction"), F.when(n % 7 == 0, 0).otherwise(2).alias("instruction_num"))


# --- checks of single frames

ISSUES = "array_to_string(list_filter([case when bad_rot or next_rot then 'invalid_rot6d' end, case when bad_ext then 'invalid_extrinsic' end, case when bad_int then 'invalid_intrinsic' end], lambda x: x is not null), ',')"


@query(f"with {FR} select vec_id, st as state, case when st in ('missing', 'nonfinite') then '' else {ISSUES} end as issues from fr")
def frame_states(s, d):
    return quality.frame_flags(frames116(s, d)).select("vec_id", "state", F.array_join("issues", ",").alias("issues"))


@query(f"with {FR} select vec_id, round(list_sum(state), 6) + 0.0 as state_sum, round(list_sum(act), 6) + 0.0 as action_sum, round(3 + v[42] + v[41], 6) + 0.0 as camera_sum, cx from fr where not lacks and not has_nan")
def lowdim_parts(s, d):
    x = frames116(s, d).where("lowdim is not null").where(G.is_finite(F.col("lowdim")))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda t, v: t + v)
    a = F.col("lowdim")
    w = G.part(a, "w2c")
    return x.select("vec_id", r6(total(G.part(a, "state"))).alias("state_sum"), r6(total(G.part(a, "action"))).alias("action_sum"), r6(G.at(w, 11) + G.at(w, 7)).alias("camera_sum"), G.at(G.part(a, "intrinsic"), 2).alias("cx"))


@query(f"with {FR} select vec_id, not (bad_rot) as rotation, not bad_ext and not has_nan as extrinsic, not bad_int as intrinsic from fr where not lacks")
def sane_parts(s, d):
    a = F.col("lowdim")
    x = frames116(s, d).where("lowdim is not null")
    return x.select("vec_id", (G.rot6d_is_sane(G.part(a, "left_root_rot6d")) & G.rot6d_is_sane(G.part(a, "right_root_rot6d"))).alias("rotation"), G.extrinsic_is_sane(G.part(a, "w2c")).alias("extrinsic"), G.intrinsic_is_sane(G.part(a, "intrinsic")).alias("intrinsic"))


# --- motion

_D3 = lambda a, i: f"sqrt((a.v[{i}] - p.v[{i}]) ** 2 + (a.v[{i + 1}] - p.v[{i + 1}]) ** 2 + (a.v[{i + 2}] - p.v[{i + 2}]) ** 2)"
_TIP = lambda first, start: "greatest(" + ", ".join("sqrt(" + " + ".join(f"(a.v[{first + k}] - p.v[{first + k}] + 0.1 * (a.v[{start + 3 * t + k}] - p.v[{start + 3 * t + k}])) ** 2" for k in range(3)) + ")" for t in range(5)) + ")"
_TURN = lambda c, q: f"2 * sqrt((a.{c} - p.{c}) ** 2 + (a.{q} - p.{q}) ** 2) / sqrt(2) / (1 + {0 if c == 'cw' else 1e-8})"  # noqa: E731  (columns of six numbers are divided by their length plus a hundred-millionth)
STEPS = f""", ln as (select vec_id, clip, f, lag(vec_id) over (partition by clip order by f) as pv, st from fr),
sp as (select a.clip, a.vec_id, case when a.st = 'sane' and p.st = 'sane' then greatest({_D3('a', 1)}, {_D3('a', 4)}) / greatest(1, a.f - p.f) end as hand_step, case when a.st = 'sane' and p.st = 'sane' then greatest({_TIP(1, 9)}, {_TIP(4, 24)}) / greatest(1, a.f - p.f) end as finger_step,
case when a.st = 'sane' and p.st = 'sane' then sqrt((a.v[40] - p.v[40]) ** 2 + (a.v[41] - p.v[41]) ** 2 + (a.v[42] - p.v[42]) ** 2) / greatest(1, a.f - p.f) end as cam_t_step, case when a.st = 'sane' and p.st = 'sane' then {_TURN('cw', 'sw')} / greatest(1, a.f - p.f) end as cam_r_step,
case when a.st = 'sane' and p.st = 'sane' then greatest({_TURN('cl', 'sl')}, {_TURN('cr', 'sr')}) / greatest(1, a.f - p.f) end as wrist_r_step from ln l join fr a on a.vec_id = l.vec_id left join fr p on p.vec_id = l.pv)"""
STEP_NAMES = ("hand_step", "finger_step", "cam_t_step", "cam_r_step", "wrist_r_step")


@query(f"with {FR}{STEPS} select vec_id, " + ", ".join(f"round({c}, 5) + 0.0 as {c}" for c in STEP_NAMES) + " from sp")
def frame_steps(s, d):
    x = quality.step_metrics(quality.frame_flags(frames116(s, d)))
    return x.select("vec_id", *[(F.round(c, 5) + 0.0).alias(c) for c in STEP_NAMES])


# --- wrists and tips in the camera

_CAM = lambda x, y, z, c="c": f"[{c}.cw * {x} - {c}.sw * {y} + {c}.v[40], {c}.sw * {x} + {c}.cw * {y} + {c}.v[41], {z} + 3 + {c}.v[42]]"
_WR = lambda p, c="c": (_CAM(f"{p}.v[1]", f"{p}.v[2]", f"{p}.v[3]", c), _CAM(f"{p}.v[4]", f"{p}.v[5]", f"{p}.v[6]", c))
_REL = lambda cos, sin, start: ", ".join(f"[0.1 * ({cos} * v[{start + 3 * t}] + {sin} * v[{start + 3 * t + 1}]) / (1 + 1e-8), 0.1 * ({cos} * v[{start + 3 * t + 1}] - {sin} * v[{start + 3 * t}]) / (1 + 1e-8), 0.1 * v[{start + 3 * t + 2}] / (1 + 2e-8)]" for t in range(5))
EXT = f""", we as (select c.vec_id, c.clip, unnest([{', '.join(_WR('c'))}]) as p from fr c where c.st = 'sane'), wx as (select vec_id, clip, min(p[1]) as ax, max(p[1]) as zx, min(p[2]) as ay, max(p[2]) as zy, min(p[3]) as az, max(p[3]) as zz, max(greatest(abs(p[1]), abs(p[2]), abs(p[3]))) as m from we group by all),
he as (select vec_id, clip, unnest([{_REL('cl', 'sl', 9)}, {_REL('cr', 'sr', 24)}]) as p from fr where st = 'sane'), hx as (select vec_id, clip, min(p[1]) as ax, max(p[1]) as zx, min(p[2]) as ay, max(p[2]) as zy, min(p[3]) as az, max(p[3]) as zz, max(greatest(abs(p[1]), abs(p[2]), abs(p[3]))) as m from he group by all),
ww as (select c.vec_id, c.clip, unnest([{', '.join(_WR('p', 'c'))}]) as p from fr c join fr p on p.clip = c.clip and p.f between c.f - 6 and c.f + 3 where c.st = 'sane' and p.st = 'sane'), wv as (select vec_id, clip, min(p[1]) as ax, max(p[1]) as zx, min(p[2]) as ay, max(p[2]) as zy, min(p[3]) as az, max(p[3]) as zz, max(greatest(abs(p[1]), abs(p[2]), abs(p[3]))) as m from ww group by all)"""
_SIDES = lambda t, n: ", ".join(f"round({t}.{k}{a}, 5) + 0.0 as {n}_{a}_{w}" for a in "xyz" for k, w in (("a", "lo"), ("z", "hi"))) + f", round({t}.m, 5) as {n}_abs"


def _sides(n: str) -> list[Column]:
    return [(F.round(f"{n}_{a}.{w}", 5) + 0.0).alias(f"{n}_{a}_{w}") for a in "xyz" for w in ("lo", "hi")] + [F.round(f"{n}_abs", 5).alias(f"{n}_abs")]


@query(f"with {FR}{EXT} select wx.vec_id, {_SIDES('wx', 'wrist')}, {_SIDES('hx', 'hand')} from wx join hx using (vec_id)")
def frame_extents(s, d):
    f = frames116(s, d)
    x = quality.frame_extents(quality.frame_flags(f))
    return x.join(f.select("clip_id", "frame_idx", "vec_id"), ["clip_id", "frame_idx"]).select("vec_id", *_sides("wrist"), *_sides("hand"))


@query(f"with {FR}{EXT} select vec_id, {_SIDES('wv', 'wrist')} from wv")
def wrist_window_extents(s, d):
    f = frames116(s, d)
    x = quality.wrist_window(quality.frame_flags(f), 6, 3)
    return x.join(f.select("clip_id", "frame_idx", "vec_id"), ["clip_id", "frame_idx"]).select("vec_id", *_sides("wrist"))


# --- views

_UV = lambda x, y, z: f"[500 * ({_CAM(x, y, z)})[1] / ({_CAM(x, y, z)})[3] + c.cx, 500 * ({_CAM(x, y, z)})[2] / ({_CAM(x, y, z)})[3] + 240]"
_PTS = lambda first, start: "[" + ", ".join([_UV(*[f"c.v[{first + k}]" for k in range(3)])] + [_UV(*[f"(c.v[{first + k}] + 0.1 * c.v[{start + 3 * t + k}])" for k in range(3)]) for t in range(5)]) + "]"
_IN = lambda h, m: f"len(list_filter(p{h}, lambda q: q[1] >= -{640 * m} and q[1] < 640 + {640 * m} and q[2] >= -{480 * m} and q[2] < 480 + {480 * m})) > 0"
VIEW = f""", pv as (select c.vec_id, c.clip, c.f, c.presence & 1 > 0 as vl, c.presence & 2 > 0 as vr, {_PTS(1, 9)} as pl, {_PTS(4, 24)} as pr from fr c where c.st = 'sane'),
vw as (select vec_id, clip, f, vl, vr, {', '.join(f"case when v{h} then {_IN(h, 0)} end as any_{h}, case when v{h} then not ({_IN(h, 0.4)}) end as severe_{h}" for h in 'lr')} from pv)"""


@query(f"with {FR}{VIEW} select vec_id, vl as vis_left, any_l as in_left, severe_l as severe_left, vr as vis_right, any_r as in_right, severe_r as severe_right from vw")
def hand_views(s, d):
    f = frames116(s, d)
    x = quality.hand_views(quality.frame_flags(f)).join(f.select("clip_id", "frame_idx", "vec_id"), ["clip_id", "frame_idx"])
    return x.select("vec_id", *[y for h in ("left", "right") for y in (F.col(f"vis_{h}"), F.col(f"view_{h}.any_in").alias(f"in_{h}"), F.col(f"view_{h}.severe").alias(f"severe_{h}"))])


STREAK = VIEW + ", ".join(["", *[f"out_{h} as (select clip, f, coalesce(v{h} and not any_{h}, false) as o from vw), i{h} as (select *, sum(case when o then 0 else 1 end) over (partition by clip order by f) as k from out_{h}), n{h} as (select clip, max(n) as n from (select clip, k, sum(o::int) as n from i{h} group by all) group by clip)" for h in "lr"]])


@query(f"with {FR}{STREAK} select clip as clip_id, nl.n::bigint as max_left, nr.n::bigint as max_right from nl join nr using (clip)")
def view_streaks(s, d):
    x = quality.out_of_frame_streaks(quality.hand_views(quality.frame_flags(frames116(s, d))))
    return x.select("clip_id", F.col("max_visible_left_out_of_frame_streak").alias("max_left"), F.col("max_visible_right_out_of_frame_streak").alias("max_right"))


# --- clips

_INS = "case when vec_id % 7 = 0 then 'missing' when vec_id % 7 = 1 then 'empty' when vec_id % 7 = 2 then 'mismatch' end"
_CM = f"""with {FR}{STEPS}{EXT}{STREAK},
m1 as (select clip, count(*) as frames_total, count(*) filter (st = 'sane') as frames_kept_candidate, count(*) filter (st = 'nonfinite') as nonfinite_lowdim_frames, count(*) filter (st in ('missing', 'insane')) as invalid_lowdim_frames, count(*) filter (st in ('sane', 'insane') and (bad_rot or next_rot)) as invalid_rot6d_frames,
count(*) filter (st in ('sane', 'insane') and bad_ext) as invalid_extrinsic_frames, count(*) filter (st in ('sane', 'insane') and bad_int) as invalid_intrinsic_frames, count(*) filter (presence > 0) / count(*) as presence_ratio, count(*) filter (vec_id % 7 = 0) as missing_instruction_frames, count(*) filter (vec_id % 7 = 1) as empty_instruction_frames, count(*) filter (vec_id % 7 in (1, 2)) as instruction_num_mismatch_frames, max(case when vec_id % 7 = 0 then 0 else 2 end) as instruction_num_max from fr group by clip),
m2 as (select clip, coalesce(max(hand_step), 0) as max_hand_translation_step, coalesce(max(finger_step), 0) as max_finger_translation_step, coalesce(max(cam_t_step), 0) as max_camera_translation_step, coalesce(max(cam_r_step), 0) as max_camera_rotation_step, coalesce(max(wrist_r_step), 0) as max_wrist_rotation_step, coalesce(avg(cam_t_step), 0) as mean_camera_translation_step, coalesce(avg(cam_r_step), 0) as mean_camera_rotation_step from sp group by clip),
m3 as (select clip, max(m) as max_camera_space_hand_abs, {', '.join(f"min(a{a}) as min_camera_space_hand_{a}, max(z{a}) as max_camera_space_hand_{a}" for a in 'xyz')} from hx group by clip), m4 as (select clip, max(m) as max_camera_space_wrist_abs, {', '.join(f"min(a{a}) as min_camera_space_wrist_{a}, max(z{a}) as max_camera_space_wrist_{a}" for a in 'xyz')} from wv group by clip),
m5 as (select clip, {', '.join(f"count(*) filter (v{h}) as visible_{n}_frames, coalesce(count(*) filter (any_{h}) / nullif(count(*) filter (v{h}), 0), 1) as visible_{n}_any_point_inframe_ratio, count(*) filter (severe_{h}) as fatal_visible_{n}_severe_offscreen_frames" for h, n in (('l', 'left'), ('r', 'right')))} from vw group by clip),
cm as (select m1.*, m2.* exclude (clip), m3.* exclude (clip), m4.* exclude (clip), m5.* exclude (clip), nl.n as max_visible_left_out_of_frame_streak, nr.n as max_visible_right_out_of_frame_streak from m1 join m2 using (clip) join m3 using (clip) join m4 using (clip) join m5 using (clip) join nl using (clip) join nr using (clip))"""
COUNTS = ("frames_total", "frames_kept_candidate", "nonfinite_lowdim_frames", "invalid_lowdim_frames", "invalid_rot6d_frames", "invalid_extrinsic_frames", "invalid_intrinsic_frames", "missing_instruction_frames", "empty_instruction_frames", "instruction_num_mismatch_frames", "instruction_num_max", "visible_left_frames", "visible_right_frames", "fatal_visible_left_severe_offscreen_frames", "fatal_visible_right_severe_offscreen_frames", "max_visible_left_out_of_frame_streak", "max_visible_right_out_of_frame_streak")
RATIOS = ("presence_ratio", *[f"max_{k}_step" for k in ("hand_translation", "finger_translation", "camera_translation", "camera_rotation", "wrist_rotation")], "mean_camera_translation_step", "mean_camera_rotation_step", *[f"max_camera_space_{n}_abs" for n in ("hand", "wrist")], *[f"{w}_camera_space_{n}_{a}" for n in ("hand", "wrist") for w in ("min", "max") for a in "xyz"], *[f"visible_{h}_any_point_inframe_ratio" for h in ("left", "right")])


def _metrics(s: SparkSession, d: str) -> DataFrame:
    return quality.clip_metrics(frames116(s, d), past=6, future=3)


@query(f"{_CM} select clip as clip_id, " + ", ".join(f"{c}::bigint as {c}" for c in COUNTS) + ", " + ", ".join(f"round({c}, 5) + 0.0 as {c}" for c in RATIOS) + " from cm")
def clip_quality_metrics(s, d):
    return _metrics(s, d).select("clip_id", *[F.col(c).cast("bigint").alias(c) for c in COUNTS], *[(F.round(c, 5) + 0.0).alias(c) for c in RATIOS])


_Q = lambda c, p: f"quantile_cont({c}, {p})"
CRITERIA = {
    "min_presence_ratio": 0.74, "min_instruction_num": 1, "min_visible_hand_any_point_inframe_ratio": 0.8, "max_visible_hand_all_points_out_of_frame_streak": 1, "max_hand_translation_step": 0.6, "max_finger_translation_step": 0.62, "max_camera_translation_step": 0.5,
    "max_camera_rotation_step": 0.6, "max_wrist_rotation_step": 2.7, "camera_space_iqr_multiplier": 0.4, "episode_camera_iqr_multiplier": 0.4,
}


def _decide_sql(criteria: dict) -> str:
    """Reasons of the clip metrics in SQL: axis fences by default, percentiles of coordinates or manual caps where ``criteria`` names them."""
    manual = [criteria.get(f"max_camera_space_{n}_abs") for n in ("wrist", "hand")]
    iqr = criteria.get("camera_space_auto_method", "iqr_bounds") == "iqr_bounds" and not any(manual)
    k, e = criteria.get("camera_space_iqr_multiplier", 2.5), criteria.get("episode_camera_iqr_multiplier", 2.5)
    lo = lambda c, m: f"({_Q(c, .25)} - {m} * ({_Q(c, .75)} - {_Q(c, .25)}))"
    hi = lambda c, m: f"({_Q(c, .75)} + {m} * ({_Q(c, .75)} - {_Q(c, .25)}))"
    cols = [f"{f(f'mean_camera_{x}_step', e)} as {x[0]}{w}" for x in ("translation", "rotation") for f, w in ((lo, "lo"), (hi, "hi"))]
    cols += [f"greatest({lo(f'min_camera_space_{n}_{a}', k)}, -1.5) as {n}_lo_{a}, least({hi(f'max_camera_space_{n}_{a}', k)}, 1.5) as {n}_hi_{a}" for n in ("wrist", "hand") for a in "xyz"]
    cols += [(f"{m}::double" if m is not None else f"2.5 * {_Q(f'max_camera_space_{n}_abs', .99)}") + f" as {n}_abs" for n, m in zip(("wrist", "hand"), manual)]
    out = [(n, f"{n}_frames > 0") for n in ("invalid_lowdim", "invalid_rot6d", "invalid_extrinsic", "invalid_intrinsic", "nonfinite_lowdim")]
    if (criteria.get("hard_rules") or {}).get("require_instruction_every_frame", True):
        out += [(f"{n}_frame", f"{n}_frames > 0") for n in ("missing_instruction", "empty_instruction", "instruction_num_mismatch")]
    out += [(f"fatal_visible_{h}_severe_offscreen", f"fatal_visible_{h}_severe_offscreen_frames > 0") for h in ("left", "right")]
    out += [(f"visible_{h}_inframe_ratio_below_min", f"visible_{h}_frames > 0 and visible_{h}_any_point_inframe_ratio < {criteria['min_visible_hand_any_point_inframe_ratio']}") for h in ("left", "right")]
    out += [(f"visible_{h}_out_of_frame_streak_exceeded", f"max_visible_{h}_out_of_frame_streak > {criteria['max_visible_hand_all_points_out_of_frame_streak']}") for h in ("left", "right")]
    out += [("instruction_num_below_min", "instruction_num_max < 1"), ("presence_ratio_below_min", f"presence_ratio < {criteria['min_presence_ratio']}")]
    out += [(f"{x}_step_exceeded", f"max_{x}_step > {criteria[f'max_{x}_step']}") for x in ("hand_translation", "finger_translation", "camera_translation", "camera_rotation", "wrist_rotation")]
    out += [(f"camera_space_{n}_abs_exceeded", "false" if iqr else f"max_camera_space_{n}_abs > {n}_abs") for n in ("wrist", "hand")]
    any_axis = lambda n, low, high: "(" + " or ".join(f"min_camera_space_{n}_{a} < {low(a)} or max_camera_space_{n}_{a} > {high(a)}" for a in "xyz") + ")"
    out += [(f"camera_space_{n}_iqr_bounds_exceeded", any_axis(n, lambda a: f"{n}_lo_{a}", lambda a: f"{n}_hi_{a}") if iqr else "false") for n in ("wrist", "hand")]  # noqa: B023
    out += [(f"camera_space_{n}_axis_abs_cap_exceeded", "false" if iqr else any_axis(n, lambda a: "-1.5", lambda a: "1.5")) for n in ("wrist", "hand")]
    out += [(f"episode_camera_{x}_iqr_exceeded", f"(mean_camera_{x}_step < {x[0]}lo or mean_camera_{x}_step > {x[0]}hi)") for x in ("translation", "rotation")]
    return f", th as (select {', '.join(cols)} from cm where frames_kept_candidate > 0), rs as (select clip, list_filter([" + ", ".join(f"case when {c} then '{n}' end" for n, c in out) + "], lambda x: x is not null) as reasons from cm cross join th)"


def _reasons(s, d, criteria):
    return quality.decide(checkpointed(_metrics(s, d)), criteria).select("clip_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"{_CM}{_decide_sql(CRITERIA)} select clip as clip_id, array_to_string(reasons, ',') as reasons from rs")
def clip_reasons(s, d):
    """Axis fences, every cap, instructions required."""
    return _reasons(s, d, CRITERIA)


MANUAL = {**CRITERIA, "max_camera_space_wrist_abs": 3.3, "max_camera_space_hand_abs": 0.04, "hard_rules": {"require_instruction_every_frame": False}}


@query(f"{_CM}{_decide_sql(MANUAL)} select clip as clip_id, array_to_string(reasons, ',') as reasons from rs")
def clip_reasons_manual(s, d):
    """Manual caps of coordinates, so the axis cap stands for the fences; instructions not required."""
    return _reasons(s, d, MANUAL)


PERCENTILE = {**CRITERIA, "camera_space_auto_method": "percentile_abs", "camera_space_abs_percentile": 99.0}


@query(f"{_CM}{_decide_sql(PERCENTILE)} select clip as clip_id, array_to_string(reasons, ',') as reasons from rs")
def clip_reasons_percentile(s, d):
    return _reasons(s, d, PERCENTILE)


@query(f"{_CM}{_decide_sql(CRITERIA)}, x as (select unnest(list_concat(['total', case when len(reasons) = 0 then 'kept' else 'dropped' end], reasons)) as reason from rs) select reason, count(*) as clips from x group by 1")
def filter_report(s, d):
    """The filter path: metrics, thresholds, decisions and the report."""
    f = frames116(s, d)
    return pipeline.filter_clips(f.select("clip_id").distinct(), f, CRITERIA, past=6, future=3)[1]


_CATEGORIES = """, bi as (select clip, list_filter([case when substr(clip, 2)::int % 4 = 0 then 'invalid_stage_output:slam' end, case when substr(clip, 2)::int % 7 = 0 then 'missing_track_range' end], lambda x: x is not null) as issues from cm), fc as (select clip, case when len(issues) > 0 then 'build_invalid' when len(reasons) > 0 then 'quality' else 'kept' end as category, case when len(issues) > 0 then issues else reasons end as rs from rs join bi using (clip))"""


@query(f"{_CM}{_decide_sql(CRITERIA)}{_CATEGORIES} select category, reason, count(*) as clips from (select category, unnest(list_concat([null::varchar], rs)) as reason from fc) group by all")
def filter_categories(s, d):
    """Clips that can't be built apart from those dropped for quality."""
    f = frames116(s, d)
    m = f.select("clip_id").distinct()
    n = F.substring("clip_id", 2, 9).cast("int")
    bad = m.where(n % 4 == 0).select("clip_id", F.lit("invalid_stage_output:slam").alias("reason")).unionByName(m.where(n % 7 == 0).select("clip_id", F.lit("missing_track_range").alias("reason")))
    return pipeline.category_report(pipeline.filter_clips(m, f, CRITERIA, past=6, future=3, build_issues=bad)[0])


@query(f"with {FR}, g as (select clip, bool_and(not lacks and not has_nan) as finite from fr group by clip) select clip as clip_id, finite, true as follows, finite as valid from g")
def native_vectors(s, d):
    """Actions of frames that have a vector are the next frame's state."""
    return quality.native_vectors_valid(frames116(s, d)).select("clip_id", "finite", F.col("action_is_next_state").alias("follows"), "valid")


@query(f"with {FR}, g as (select clip, f, case when not lacks then act end as act, lead(case when not lacks then state end) over (partition by clip order by f) as nxt from fr), x as (select clip, list_max(list_transform(list_zip(act, nxt), lambda p: abs(p[1] - p[2]))) as m from g where act is not null and nxt is not null) select clip as clip_id, round(max(m), 6) + 0.0 as gap from x group by clip")
def action_gaps(s, d):
    x = frames116(s, d)
    return reports.action_gap(x).where("max_abs_diff is not null").select("clip_id", r6("max_abs_diff").alias("gap"))


# --- samples and episodes

_SI = f"""with {FR}, si as (select vec_id, clip, f, vec_id // 100 as shard, vec_id as pos, {_INS} as ins, case when vec_id % 61 = 3 then ['missing_image'] else [] end as i1, case when lacks then ['missing_lowdim'] else [] end as i2, case when vec_id % 67 = 5 then ['missing_meta', 'invalid_meta'] when vec_id % 71 = 9 then ['invalid_meta'] else [] end as i3,
case when vec_id % 67 = 5 or vec_id % 71 = 9 then [] when vec_id % 7 = 0 then ['missing_instruction'] when vec_id % 7 = 1 then ['empty_instruction', 'instruction_num_mismatch'] when vec_id % 7 = 2 then ['instruction_num_mismatch'] else [] end as i4,
case when lacks then [] when has_nan then ['nonfinite_lowdim'] when bad_int then ['invalid_intrinsic'] else list_concat(case when bad_rot or next_rot then ['invalid_rot6d'] else [] end, case when bad_ext then ['invalid_extrinsic'] else [] end) end as i5 from fr),
sm as (select *, list_concat(i1, i2, i3, i4, i5) as issues from si)"""
_EP = _SI + """, ru as (select *, case when clip is not distinct from lag(clip) over w then 0 else 1 end as nw from sm window w as (partition by shard order by pos)), rn as (select *, sum(nw) over (partition by shard order by pos) - 1 as run_id from ru),
ep as (select shard, run_id::bigint as run_id, clip, count(*) as samples, min(pos) as first_pos, list_sort(list_distinct(flatten(list(issues)))) as issues from rn group by all)"""


def samples(s: SparkSession, d: str) -> DataFrame:
    """Frames as samples of shards: some without image, some with a meta that is missing or unreadable."""
    n = F.col("vec_id")
    meta = F.struct(F.lit(None).cast("string").alias("clip_id"), "instruction", "instruction_num")
    return frames116(s, d).select(
        F.floor(n / 100).alias("shard"), n.alias("pos"), F.concat("clip_id", F.lit("_f"), F.lpad(F.col("frame_idx").cast("string"), 6, "0")).alias("key"), F.when(n % 61 != 3, F.lit(b"x")).alias("image"), "lowdim", F.lit(b"m").alias("mano"),
        F.when((n % 67 != 5) & (n % 71 != 9), meta).alias("meta"), (n % 67 != 5).alias("has_meta"), "vec_id",
    )


@query(f"{_SI} select vec_id, array_to_string(issues, ',') as issues from sm")
def sample_issues(s, d):
    return reports.sample_issues(samples(s, d)).select("vec_id", F.array_join("issues", ",").alias("issues"))


@query(f"{_SI} select vec_id, clip as clip_id, 'c' as prefix from sm")
def sample_clips(s, d):
    x = samples(s, d).select("vec_id", reports.sample_clip(F.col("key"), F.col("meta.clip_id")).alias("clip_id"))
    return x.withColumn("prefix", F.substring("clip_id", 1, 1))


@query(f"{_EP} select shard, run_id, clip as clip_id, samples, first_pos, array_to_string(issues, ',') as issues, len(issues) > 0 as problematic, len(issues) > 0 as dropped from ep")
def episode_sanity(s, d):
    x = reports.sanity_by_episode(samples(s, d))
    return x.select("shard", F.col("run_id").cast("bigint").alias("run_id"), "clip_id", "samples", "first_pos", F.array_join("issues", ",").alias("issues"), "problematic", "dropped")


@query(
    f"""{_EP}, al as (select 'samples' as counter, count(*) as value from sm union all select i, count(*) from (select unnest(issues) as i from sm) group by 1 union all select 'episodes', count(*) from ep
union all select 'problematic_episodes', count(*) from ep where len(issues) > 0 union all select 'dropped_episodes', count(*) from ep where len(issues) > 0 union all select 'episodes_with_' || i, count(*) from (select unnest(issues) as i from ep) group by 1) select counter, value from al where value > 0"""
)
def sanity_counts(s, d):
    return reports.sanity_report(samples(s, d))


@query(f"{_SI}, x as (select shard, pos, unnest(issues) as issue from sm), n as (select *, row_number() over (partition by issue order by shard, pos) as r from x) select issue, pos from n where r <= 5")
def issue_samples(s, d):
    return reports.issue_examples(samples(s, d), 5).select("issue", "pos")


@query(f"{_SI} select clip as clip_id, count(*) as samples, list_aggregate(list_sort(list_distinct(list(shard))), 'string_agg', ',') as shards, arg_min('text ' || vec_id, case when vec_id % 3 > 0 then pos end) as preview, min(pos) as first_pos from sm group by clip")
def episode_previews(s, d):
    x = samples(s, d).withColumn("clip_id", reports.sample_clip(F.col("key"), F.lit(None).cast("string"))).withColumn("t", F.when(F.col("vec_id") % 3 > 0, F.concat(F.lit("text "), F.col("vec_id").cast("string"))).otherwise(" "))
    e = reports.episode_candidates(x, "clip_id", "shard", "pos", "t")
    return e.select("clip_id", "samples", F.array_join(F.transform("shards", lambda v: v.cast("string")), ",").alias("shards"), "preview", "first_pos")


@query(f"{_EP} select ['required', 'hard'][k] as kind, count(*) as episodes from ep, (select unnest([1, 2]) as k) where case when k = 1 then len(issues) > 0 else list_has_any(issues, ['missing_lowdim', 'nonfinite_lowdim', 'invalid_rot6d', 'invalid_extrinsic', 'invalid_intrinsic']) end group by 1")
def hard_episodes(s, d):
    """Episodes with any issue that drops them, and those with a numeric one (set intersection)."""
    e = checkpointed(reports.sanity_by_episode(samples(s, d)))
    low = F.array(*[F.lit(x) for x in ("missing_lowdim", "nonfinite_lowdim", "invalid_rot6d", "invalid_extrinsic", "invalid_intrinsic")])
    a = e.where("dropped").select(F.lit("required").alias("kind"))
    return a.unionByName(e.where(F.arrays_overlap("issues", low)).select(F.lit("hard").alias("kind"))).groupBy("kind").agg(F.count("*").alias("episodes"))


@query(
    f"""with {FR}, q as (select vec_id, unnest([[v[1], v[2], v[3]], [v[4], v[5], v[6]], {', '.join(f'[v[{a}] + 0.1 * v[{b + 3 * t}], v[{a + 1}] + 0.1 * v[{b + 3 * t + 1}], v[{a + 2}] + 0.1 * v[{b + 3 * t + 2}]]' for a, b in ((1, 9), (4, 24)) for t in range(5))}]) as p, cw, sw, v, cx, bad_int from fr where not lacks and not has_nan),
c as (select vec_id, cx, [cw * p[1] - sw * p[2] + v[40], sw * p[1] + cw * p[2] + v[41], p[3] + 3 + v[42]] as c, bad_int from q), z as (select vec_id, c[3] as z, round_even((case when bad_int then -1 else 500 end) * c[1] / c[3] + cx, 0) as x, round_even(500 * c[2] / c[3] + 240, 0) as y from c)
select count(*) as points, round(avg(abs(3.0 - z)), 6) as mean, round(max(abs(3.0 - z)), 6) as max, round(median(abs(3.0 - z)), 6) as median from z where x >= 0 and x < 640 and y >= 0 and y < 480"""
)
def depth_consistency(s, d):
    """Stored depth is three metres everywhere."""
    x = frames116(s, d).select("vec_id", "lowdim", F.array_repeat(F.lit(3000), 640 * 480).alias("depth_mm"), F.lit(480).alias("h"), F.lit(640).alias("w")).where(F.coalesce(G.is_finite(F.col("lowdim")), F.lit(False)))
    return reports.error_summary(reports.depth_action_errors(x, "vec_id")).select("points", *[F.round(c, 6).alias(c) for c in ("mean", "max", "median")])


@query(f"with {FR} select clip as clip_id, count(*) as n, count(*) filter (has_nan and false) as nonfinite, 1::double as min_det, 1::double as max_det, true as orthogonal from fr where not lacks group by clip")
def camera_rotations(s, d):
    x = frames116(s, d).where("lowdim is not null").withColumn("m", G.rotation_of(G.part(F.col("lowdim"), "w2c")))
    r = reports.rotation_summary(x, "m", ["clip_id"])
    return r.select("clip_id", "n", "nonfinite", F.round("min_det", 6).alias("min_det"), F.round("max_det", 6).alias("max_det"), (F.col("max_ortho_err") < 1e-9).alias("orthogonal"))


# --- geometry

@query(f"with {FR} select vec_id, " + ", ".join(f"round({e}, 6) + 0.0 as {n}" for n, e in (("cx", "-(cw * v[40] + sw * v[41])"), ("cy", "sw * v[40] - cw * v[41]"), ("cz", "-(3 + v[42])"), ("px", "cw * v[1] - sw * v[2] + v[40]"), ("py", "sw * v[1] + cw * v[2] + v[41]"), ("pz", "v[3] + 3 + v[42]"), ("tx", "0.1 * (cl * v[9] + sl * v[10]) / (1 + 1e-8)"), ("ty", "0.1 * (cl * v[10] - sl * v[9]) / (1 + 1e-8)"), ("tz", "0.1 * v[11] / (1 + 2e-8)"))) + " from fr where st = 'sane'")
def camera_geometry(s, d):
    """Camera centre, the left wrist in the camera, and its first tip in the wrist's frame."""
    a = F.col("lowdim")
    x = quality.frame_flags(frames116(s, d)).where("state = 'sane'")
    w, lw = G.part(a, "w2c"), G.part(a, "left_wrist")
    x = x.select("vec_id", G.camera_centre(w).alias("c"), G.to_camera(lw, w).alias("p"), G.in_wrist_frame(F.slice(G.part(a, "left_fingertips"), 1, 3), lw, G.part(a, "left_root_rot6d")).alias("t"))
    return x.select("vec_id", *[r6(F.col(k)[i]).alias(f"{k}{c}") for k in "cpt" for i, c in enumerate("xyz")])


_ANG = "atan2(sl, cl)"


@query(f"with {FR} select vec_id, 0::double as ax, 0::double as ay, round({_ANG}, 3) + 0.0 as az, round(cl, 3) + 0.0 as m00, round(-sl, 3) + 0.0 as m01, round(sl, 3) + 0.0 as m10, round(cl, 3) + 0.0 as r0, round(sl, 3) + 0.0 as r1, round(-sl, 3) + 0.0 as r3 from fr where not bad_rot and abs({_ANG}) < 3.1")
def rotation_round_trip(s, d):
    """Six numbers to a matrix and a rotation vector, and back."""
    n = F.col("vec_id")
    x = frames116(s, d).where((n % 41 != 7) & F.col("lowdim").isNotNull() | (n % 59 == 17) & (n % 41 != 7))
    v = load(s, d, "embeddings").where("vec_id % 41 <> 7").select("vec_id", F.get("embedding", F.lit(6)).cast("double").alias("t"))
    c, q = F.cos(8 * F.col("t")), F.sin(8 * F.col("t"))
    v = v.join(x.select("vec_id"), "vec_id").where(F.abs(F.atan2(q, c)) < 3.1).select("vec_id", G.vector(c, q, F.lit(0), -q, c, F.lit(0)).alias("r"))
    v = v.select("vec_id", G.rot6d_to_axis_angle(F.col("r")).alias("a")).select("vec_id", "a", G.axis_angle_to_matrix(F.col("a")).alias("m"), G.axis_angle_to_rot6d(F.col("a")).alias("b"))
    return v.select("vec_id", r6(F.col("a")[0]).alias("ax"), r6(F.col("a")[1]).alias("ay"), (F.round(F.col("a")[2], 3) + 0.0).alias("az"), *[(F.round(F.col("m")[i], 3) + 0.0).alias(n) for n, i in (("m00", 0), ("m01", 1), ("m10", 3))], *[(F.round(F.col("b")[i], 3) + 0.0).alias(f"r{i}") for i in (0, 1, 3)])


_QN = "sqrt(v[1] ** 2 + v[2] ** 2 + v[3] ** 2 + v[4] ** 2)"


@query(
    f"""with b as (select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings), q as (select vec_id, v, v[1] / {_QN} as x, v[2] / {_QN} as y, v[3] / {_QN} as z, v[4] / {_QN} as w from b), m as (select vec_id, v, [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), 2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)] as m from q)
select vec_id, round(m[1], 6) + 0.0 as r00, round(m[4], 6) + 0.0 as r01, round(m[7], 6) + 0.0 as r02, round(-2 * (m[1] * v[5] + m[4] * v[6] + m[7] * v[7]), 6) + 0.0 as t0, round(-2 * (m[3] * v[5] + m[6] * v[6] + m[9] * v[7]), 6) + 0.0 as t2 from m"""
)
def pose_matrices(s, d):
    """World-to-camera matrices of poses (position, then quaternion), positions doubled."""
    e = lambda i: F.get("embedding", F.lit(i - 1)).cast("double")
    x = load(s, d, "embeddings").select("vec_id", G.pose_to_w2c(F.array(e(5), e(6), e(7), e(1), e(2), e(3), e(4)), F.lit(2.0)).alias("m"))
    return x.select("vec_id", *[r6(F.col("m")[i]).alias(n) for n, i in (("r00", 0), ("r01", 1), ("r02", 2), ("t0", 3), ("t2", 11))])


_DOT = lambda a, b: " + ".join(f"v[{a + i}] * v[{b + i}]" for i in range(4))


@query(
    f"""with b as (select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings), n as (select vec_id, v, sqrt({_DOT(1, 1)}) as na, sqrt({_DOT(5, 5)}) as nb, {_DOT(1, 5)} as d0 from b), d as (select *, least(abs(d0 / (na * nb)), 1) as d, case when d0 < 0 then -1 else 1 end as g from n),
w as (select *, case when d > 0.9995 then 0.7 else sin(0.7 * acos(d)) / sin(acos(d)) end as wa, case when d > 0.9995 then 0.3 else sin(0.3 * acos(d)) / sin(acos(d)) end as wb from d), q as (select vec_id, list_transform([1, 2, 3, 4], lambda i: v[i] / na * wa + g * v[i + 4] / nb * wb) as q from w)
select vec_id, {', '.join(f'round(q[{i}] / sqrt(q[1] ** 2 + q[2] ** 2 + q[3] ** 2 + q[4] ** 2), 6) + 0.0 as q{i}' for i in range(1, 5))} from q"""
)
def quaternion_slerp(s, d):
    x = load(s, d, "embeddings").select("vec_id", G.slerp(F.slice("embedding", 1, 4).cast("array<double>"), F.slice("embedding", 5, 4).cast("array<double>"), F.lit(0.3)).alias("q"))
    return x.select("vec_id", *[r6(F.col("q")[i]).alias(f"q{i + 1}") for i in range(4)])


def _norm3(e: str) -> str:
    return f"sqrt({e}[1] ** 2 + {e}[2] ** 2 + {e}[3] ** 2)"


_CROSS = lambda a, b: f"[{a}[2] * {b}[3] - {a}[3] * {b}[2], {a}[3] * {b}[1] - {a}[1] * {b}[3], {a}[1] * {b}[2] - {a}[2] * {b}[1]]"


@query(
    f"""with b as (select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings), j as (select vec_id, [v[28] - v[1], v[29] - v[2], v[30] - v[3]] as x0, [v[16] - v[52], v[17] - v[53], v[18] - v[54]] as k from b), x as (select vec_id, list_transform(x0, lambda q: q / ({_norm3('x0')} + 1e-8)) as x, k from j),
z0 as (select vec_id, x, {_CROSS('x', 'k')} as z0 from x), z as (select vec_id, x, list_transform(z0, lambda q: q / ({_norm3('z0')} + 1e-8)) as z from z0), y as (select vec_id, x, z, {_CROSS('z', 'x')} as y from z) select vec_id, round(x[1], 5) + 0.0 as x0, round(z[1], 5) + 0.0 as z0, round(y[1], 5) + 0.0 as y0, round(y[3], 5) + 0.0 as y2 from y"""
)
def palm_frames(s, d):
    """The first 21 points of a vector as joints."""
    j = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: F.slice("embedding", i * 3 + 1, 3).cast("array<double>"))
    x = load(s, d, "embeddings").select("vec_id", j.alias("j")).select("vec_id", G.palm_frame(F.col("j")).alias("m"))
    return x.select("vec_id", *[(F.round(F.col("m")[i], 5) + 0.0).alias(n) for n, i in (("x0", 0), ("y0", 1), ("z0", 2), ("y2", 7))])


@query("select vec_id, (case when embedding[1] > 0 then 1 else 0 end + case when embedding[2] > 0 then 2 else 0 end) as mask, round(list_sum(list_transform([13, 14, 15, 25, 26, 27, 37, 38, 39, 49, 50, 51, 61, 62, 63], lambda i: embedding[i]::double)), 6) + 0.0 as tips from embeddings")
def presence_and_tips(s, d):
    v = lambda i: F.get("embedding", F.lit(i))
    j = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: F.slice("embedding", i * 3 + 1, 3).cast("array<double>"))
    x = load(s, d, "embeddings").select("vec_id", G.presence_mask(v(0) + 0.5, v(1) + 0.5).alias("mask"), j.alias("j"))
    return x.select("vec_id", "mask", r6(F.aggregate(G.fingertips(F.col("j")), F.lit(0.0), lambda t, q: t + q)).alias("tips"))


@query("select event_id, case when value > 100 then value else 320 end as focal, 320::double as cx, 240::double as cy, cast(ceil(value / 128) * 128 as bigint) as buffer, round(pow(0.25 / (0.25 + pow(value / 100, 2)), 2), 6) as weight from events")
def calibration_and_weights(s, d):
    v = F.col("value")
    c = G.calibrated(F.when(v > 100, v), F.lit(None).cast("double"), F.lit(640), F.lit(480))
    return load(s, d, "events").select("event_id", c["focal"].alias("focal"), c["cx"].alias("cx"), c["cy"].alias("cy"), G.rounded_up(v, 128).alias("buffer"), F.round(G.gmof_weight(v / 100, 0.5), 6).alias("weight"))


@query(
    """with x as (select manifest_pos, coalesce(descriptor.width, 64) as w, coalesce(descriptor.height, 48) as h from clips), y as (select *, least(greatest(round_even(w * 0.13, 0), 0), w - 1) as l, least(greatest(round_even(h * 0.21, 0), 0), h - 1) as t from x)
select manifest_pos, l::int as "left", t::int as top, least(greatest(round_even(w * 0.87, 0), l + 1), w)::int as "right", least(greatest(round_even(h * 0.5, 0), t + 1), h)::int as bottom from y"""
)
def regions(s, d):
    x = load(s, d, "clips").select("manifest_pos", F.coalesce("descriptor.width", F.lit(64)).alias("w"), F.coalesce("descriptor.height", F.lit(48)).alias("h"))
    return x.select("manifest_pos", G.roi_bounds(F.col("w"), F.col("h"), 0.13, 0.21, 0.87, 0.5).alias("r")).select("manifest_pos", "r.*")


_BASIS = [[1.0, 0.0, 2.0], [0.0, 2.0, 0.0]]


@query("select vec_id, round((embedding[1]::double - 0.1 + 2 * (embedding[3]::double - 0.3)) / 5, 6) + 0.0 as a, round((embedding[2]::double - 0.2) / 2, 6) + 0.0 as b, round(embedding[4]::double * 0.001 + 1, 9) as x from embeddings")
def pose_components(s, d):
    """A pose in two components, and a point in millimetres moved by a rigid transform."""
    e = F.col("embedding").cast("array<double>")
    m = F.array(*[F.lit(float(v)) for v in (1, 0, 0, 1, 0, 1, 0, 2, 0, 0, 1, 3, 0, 0, 0, 1)])
    x = load(s, d, "embeddings").select("vec_id", pipeline.to_components(F.slice(e, 1, 3), [0.1, 0.2, 0.3], _BASIS).alias("c"), pipeline.rigid(F.slice(e, 4, 3), m, 0.001).alias("p"))
    return x.select("vec_id", r6(F.col("c")[0]).alias("a"), r6(F.col("c")[1]).alias("b"), F.round(F.col("p")[0], 9).alias("x"))


@query(f"with {FR} select vec_id, not (bad_ext or bad_int or has_nan) as usable, case when not (bad_ext or bad_int or has_nan) then round(-(cw * v[40] + sw * v[41]), 6) + 0.0 end as x from fr where not lacks")
def depth_model_inputs(s, d):
    x = frames116(s, d).where("lowdim is not null").select("vec_id", pipeline.native_depth_inputs(F.col("lowdim")).alias("i"))
    return x.select("vec_id", F.col("i").isNotNull().alias("usable"), r6(F.col("i.cam2world")[3]).alias("x"))


@query("select vec_id, len(embedding) = 64 as is_hand, round(embedding[1]::double + 1, 6) + 0.0 as pose, round(embedding[46]::double, 6) + 0.0 as shape from embeddings")
def hand_parameter_arrays(s, d):
    """A vector and its copy as the flat parameters of two hands."""
    flat = F.concat(F.slice("embedding", 1, 55), F.slice("embedding", 1, 55)).cast("array<double>")
    x = load(s, d, "embeddings").select("vec_id", pipeline.hand_parameters(flat).alias("h"))
    return x.select("vec_id", ((F.size("h.left.pose") == 45) & (F.size("h.right.shape") == 10)).alias("is_hand"), r6(F.col("h.left.pose")[0] + 1).alias("pose"), r6(F.col("h.right.shape")[0]).alias("shape"))


# --- text over frames' keys

@query(f"with {FR} select vec_id, f::bigint as frame, (vec_id // 25)::bigint as episode, clip || '_ep' || lpad((vec_id // 25)::varchar, 6, '0') || '_f' || lpad(f::varchar, 6, '0') as key, 'lowdim' as field from fr")
def sample_keys(s, d):
    n = F.col("vec_id")
    x = frames116(s, d).select("vec_id", F.concat("clip_id", F.lit("_ep"), F.lpad(F.floor(n / 25).cast("string"), 6, "0"), F.lit("_f"), F.lpad(F.col("frame_idx").cast("string"), 6, "0"), F.lit(".lowdim.npy")).alias("name"))
    x = x.select("vec_id", T.member_parts(F.col("name")).alias("p"))
    return x.select("vec_id", T.frame_index(F.col("p.key")).alias("frame"), T.episode_index(F.col("p.key")).alias("episode"), F.col("p.key").alias("key"), F.col("p.field").alias("field"))


@query("select vec_id, case when vec_id % 5 >= vec_id % 7 then 'invalid_bounds' when vec_id % 7 - vec_id % 5 < 2 then 'too_short' when vec_id % 3 = 0 then 'invalid_status' when vec_id % 11 = 0 then 'low_quality' when vec_id % 13 = 0 then 'missing_language' end as reason from embeddings")
def segment_reasons(s, d):
    n = F.col("vec_id")
    return load(s, d, "embeddings").select("vec_id", annotation.segment_choice((n % 5).cast("double"), (n % 7).cast("double"), n % 3 != 0, n % 11 != 0, n % 13 != 0).alias("reason"))
