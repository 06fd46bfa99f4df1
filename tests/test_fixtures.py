"""Hand-made cases whose results follow from the rules."""

import math

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from framewright.functions import geometry as G
from framewright.functions import keys as K
from framewright.functions import text as T
from framewright.operators import annotation, intervals, monitor, quality, reports, resample, shards, solvers, windows


def one(spark, **cols):
    r = spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()
    return r[0] if len(cols) == 1 else r


def arr(*xs):
    return F.array(*[F.lit(float(x)) for x in xs])


def vector(x=0.0, bad=None):
    rot = [1, 0, 0, 0, 1, 0]
    state = [x, 0, 1, 0.1, 0, 1] + rot + rot + [x, 0, 1] * 5 + [0.1, 0, 1] * 5
    v = state + state + [1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1] + [100, 100, 50, 50]
    v = [float(y) for y in v]
    if bad is not None:
        v[bad] = float("nan")
    return v


def frames(spark, rows):
    return spark.createDataFrame(rows, "clip_id string, frame_idx int, lowdim array<double>, presence int, width int, height int")


def test_steps_use_gaps(spark):
    f = frames(spark, [("a", i, vector(x), 3, 100, 100) for i, x in ((0, 0.0), (1, 0.1), (3, 0.5))])
    m = quality.clip_metrics(f).first()
    assert m.max_hand_translation_step == pytest.approx(0.2)
    assert m.frames_kept_candidate == 3
    assert m.max_finger_translation_step == pytest.approx(0.2)
    assert m.presence_ratio == 1.0


def test_nonfinite_breaks_the_chain(spark):
    f = frames(spark, [("a", 0, vector(0.0), 3, 100, 100), ("a", 1, vector(0.1, bad=0), 3, 100, 100), ("a", 3, vector(0.5), 3, 100, 100)])
    m = quality.clip_metrics(f).first()
    assert (m.max_hand_translation_step, m.nonfinite_lowdim_frames, m.invalid_lowdim_frames) == (0.0, 1, 0)


def test_missing_vector_counts_as_invalid(spark):
    m = quality.clip_metrics(frames(spark, [("a", 0, None, 0, 100, 100), ("a", 1, [1.0], 0, 100, 100)])).first()
    assert (m.invalid_lowdim_frames, m.frames_kept_candidate, m.visible_left_any_point_inframe_ratio) == (2, 0, 1.0)


def test_streaks(spark):
    def streak(rows):
        v = spark.createDataFrame([("c", i, o != "n", o != "n", (o == "i", o != "i", False) if o != "n" else None, (o == "i", o != "i", False) if o != "n" else None) for i, o in rows], "clip_id string, frame_idx int, vis_left boolean, vis_right boolean, view_left struct<any_in:boolean,all_out:boolean,severe:boolean>, view_right struct<any_in:boolean,all_out:boolean,severe:boolean>")
        return quality.out_of_frame_streaks(v).first().max_visible_left_out_of_frame_streak

    assert streak([(0, "o"), (1, "o"), (3, "o"), (4, "i")]) == 3  # frame 2 was not sane and is absent
    assert streak([(0, "o"), (1, "o"), (2, "n"), (3, "o")]) == 2


def test_fences(spark):
    d = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)] + [(float("nan"),), (None,)], "x double")
    r = quality.iqr_fences(d, ["x"]).first()
    assert (r.q1, r.q3, r.lo, r.hi, r.n) == (1.75, 3.25, -2.0, 7.0, 4)
    assert quality.iqr_fences(d.where("false"), ["x"]).count() == 0


def test_equal_to_the_cap_is_kept(spark):
    m = quality.clip_metrics(frames(spark, [("a", 0, vector(0.0), 3, 100, 100), ("a", 1, vector(0.25), 3, 100, 100)]))
    lim = quality.thresholds(m, {"use_auto_camera_space_thresholds": False})
    assert quality.decide(m, {"max_hand_translation_step": 0.25, "camera_space_axis_abs_cap": None}, lim).first().keep
    assert quality.decide(m, {"max_hand_translation_step": 0.2, "camera_space_axis_abs_cap": None}, lim).first().reasons == ["hand_translation_step_exceeded"]
    r = {x.reason: x.clips for x in quality.drop_report(quality.decide(m, {"max_hand_translation_step": 0.2, "camera_space_axis_abs_cap": None}, lim)).collect()}
    assert r == {"total": 1, "dropped": 1, "hand_translation_step_exceeded": 1}


def test_auto_thresholds(spark):
    m = quality.clip_metrics(frames(spark, [(f"c{c}", i, vector(0.01 * c * i), 3, 100, 100) for c in range(6) for i in range(3)]))
    row = quality.thresholds(m, {}).first().asDict()
    assert row["wrist_upper_x"] <= 1.5 and row["wrist_abs"] is None and row["episode_translation_lower"] == 0
    row = quality.thresholds(m, {"camera_space_auto_method": "percentile_abs"}).first().asDict()
    assert row["wrist_abs"] == pytest.approx(np.percentile([r.max_camera_space_wrist_abs for r in m.collect()], 99) * 2.5)
    assert quality.decide(m).count() == 6


def test_instruction_flags(spark):
    f = lambda slots, n: one(spark, x=T.instruction_flags(F.array(*[F.lit(s) for s in slots]) if slots else F.lit(None).cast("array<string>"), n))
    assert f(["a", " "], F.lit(2))[:] == (2, False, False, True)
    assert f(["a"], F.lit("x"))[:] == (0, True, False, False)
    assert f([" "], F.lit(1))[:] == (1, False, True, True)
    assert f(None, F.lit(1))[:] == (1, False, True, True)


def test_gate_merge(spark):
    s = [(i * 15, v) for i, v in enumerate([True, True, False, False, True, False, False, False, True])]
    d = spark.createDataFrame([("v", i, ok, 1.0) for i, ok in s], "video string, idx int, ok boolean, score double")
    got = [(r.start_frame, r.end_frame) for r in windows.merged_gate_samples(d, "video", "idx", "ok", "score", 15, 15.0).orderBy("start_frame").collect()]
    assert got == [(0, 75), (120, 135)]


def test_shard_plan(spark):
    def plan(ns):
        d = spark.createDataFrame(list(enumerate(ns)), "i bigint, n bigint")
        return [r.shard_idx for r in shards.shard_plan(d, "i", "n", 10).orderBy("i").collect()]

    assert plan([6, 5, 10, 3]) == [0, 1, 2, 3]
    assert plan([4, 6, 25, 1]) == [0, 0, 1, 2]
    assert plan([4, 0, 6]) == [0, None, 0]


def test_segments_and_runs(spark):
    d = spark.createDataFrame([("e", f) for f in (3, 4, 5, 8, 9)], "ep string, f int")
    r = windows.contiguous_segments(d, ["ep"], "f").orderBy("f").collect()
    assert [x.part_id for x in r] == ["000"] * 3 + ["001"] * 2 and r[0].segment_count == 2
    d = spark.createDataFrame(list(enumerate("AABA")), "pos int, clip string")
    assert [x.run_id for x in windows.episode_runs(d, [], ["pos"], "clip").orderBy("pos").collect()] == [0, 0, 1, 2]


def test_numbering(spark):
    f = lambda s: one(spark, x=T.without_numbering(F.lit(s)))
    assert (f("1. Pick up"), f(" 2.  Place "), f("3.x")) == ("Pick up", "Place", "3.x")


def test_candidates(spark):
    c = one(spark, x=T.annotation_candidates(F.lit("f001_w002_v00003_i004")))
    assert c[3] == "factory_001_worker_002_0003_cut004.annotation.json" and len(c) == 4 and c[1].startswith("factory001/")
    assert one(spark, x=T.annotation_candidates(F.lit("abc"))) == ["abc.annotation.json"]


def test_model_answers(spark):
    raw = 'Sure:\n{"status": "VALID", "is_good_quality": true, "language_instructions": {"level2": " b ", "level1": "a"}} ok'
    p = one(spark, x=T.annotation_payload(F.lit(raw)))
    assert (p.status, p.is_good_quality, p.instruction, p.language) == ("Valid", True, ["a", "b"], "b")
    p = one(spark, x=T.annotation_payload(F.lit('```json\n{"status": "Invalid", "language_instructions": {"level1": "a"}}\n```')))
    assert (p.status, p.instruction_num, p.language) == ("Invalid", 0, None)
    s = one(spark, x=F.transform(T.segments(F.lit('{"segments": [{"begin": 1, "finish": 2.5}, 3]}')), lambda x: T.segment_bounds(x)))
    assert [x[:] for x in s] == [(1.0, 2.5)]


def test_resample(spark):
    fr = spark.createDataFrame([("c", i, 10.0 * i) for i in range(3)], "clip string, f int, v double")
    cl = spark.createDataFrame([("c", 3, 6, 5.0, 10.0)], "clip string, n int, m int, s double, g double")
    g = resample.target_grid(cl, "clip", F.col("n"), F.col("m"), F.col("s"), F.col("g"))
    assert [r.v for r in resample.resample_linear(fr, g, "clip", "f", ["v"]).orderBy("t").collect()] == [0, 5, 10, 15, 20, 20]
    assert [r.v / 10 for r in resample.resample_nearest(fr, g, "clip", "f", ["v"]).orderBy("t").collect()] == [0, 0, 1, 2, 2, 2]


def test_millimetres(spark):
    f = lambda x: one(spark, x=G.to_millimetres(F.lit(x)))
    assert [f(0.0005), f(0.0015), f(-1.0), f(float("nan")), f(99.0)] == [0, 2, 0, 0, 65535]


def test_event_replay(spark):
    lines = ['{"event": "stage_success", "video": "v", "stage": "s", "wall_sec": 2}', "not json", '{"event": "stage_failure", "video": "v", "stage": "s", "error": "x", "time": "2026-01-01T00:00:00Z"}', ""]
    e = monitor.parsed_events(spark.createDataFrame(list(enumerate(lines)), "pos bigint, value string"))
    v = spark.createDataFrame([("v",), ("w",)], "video string")
    st = {(r.video, r.stage): r.status for r in monitor.replayed(e, v, ["s", "t"]).collect()}
    assert st == {("v", "s"): "failed", ("v", "t"): "pending", ("w", "s"): "pending", ("w", "t"): "pending"}
    assert e.where("malformed").count() == 1
    s = monitor.run_summary(monitor.replayed(e, v, ["s", "t"]), e, F.to_timestamp(F.lit("2026-01-01 01:00:00"))).first()
    assert (s.total, s.malformed, s.age_sec, s.health) == (2, 1, 3600, "stalled")
    r = monitor.stage_stats(e).first()
    assert (r.success, r.failure, r.avg_sec) == (1, 1, 2.0)


def test_projection(spark):
    w2c, k = arr(1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1), arr(100, 100, 50, 50)
    uv = one(spark, x=G.project(arr(0, 0, 1), w2c, k))
    assert uv[:] == (50, 50)
    v = one(spark, x=G.hand_in_view(F.array(arr(0, 0, 1)), w2c, k, F.lit(100), F.lit(100)))
    assert v[:] == (True, False, False)
    assert one(spark, x=G.hand_in_view(F.array(arr(0, 0, -1)), w2c, k, F.lit(100), F.lit(100)))[:] == (False, True, True)


def test_rot6d(spark):
    r = arr(1, 0, 0, 0, 1, 0)
    assert one(spark, x=G.rot6d_to_matrix(r)) == pytest.approx([1, 0, 0, 0, 1, 0, 0, 0, 1], abs=1e-6)
    assert one(spark, x=G.rot6d_is_sane(r)) and not one(spark, x=G.rot6d_is_sane(arr(1, 0, 0, 1, 0, 0)))


def test_rotations_round_trip(spark):
    rng = np.random.default_rng(0)
    for _ in range(5):
        v = rng.normal(size=3)
        got = one(spark, x=G.rot6d_to_axis_angle(G.axis_angle_to_rot6d(arr(*v))))
        a = np.linalg.norm(v)
        assert got == pytest.approx(list(v if a <= math.pi else v * (1 - 2 * math.pi / a)), abs=1e-5)
    q = one(spark, x=G.slerp(arr(0, 0, 0, 1), arr(0, 0, math.sin(0.5), math.cos(0.5)), F.lit(0.5)))
    assert q == pytest.approx([0, 0, math.sin(0.25), math.cos(0.25)], abs=1e-9)
    m = one(spark, x=G.pose_to_w2c(arr(1, 2, 3, 0, 0, 0, 1), F.lit(2.0)))
    assert m == [1, 0, 0, -2, 0, 1, 0, -4, 0, 0, 1, -6, 0, 0, 0, 1]
    assert one(spark, x=G.camera_centre(G.pose_to_w2c(arr(1, 2, 3, 0.1, 0.2, 0.3, 0.9)))) == pytest.approx([1, 2, 3])


def test_window_extremes_need_present_frames(spark):
    d = spark.createDataFrame([("c", f, float(f)) for f in (0, 1, 5)], "clip string, f int, v double")
    r = windows.window_extremes(d, "clip", "f", "v", 2, 1).orderBy("f").collect()
    assert [(x.lo, x.hi) for x in r] == [(0, 1), (0, 1), (5, 5)]


def test_chunk_stitching(spark):
    d = spark.createDataFrame([("c", k, f, p, 1.0 if k == 0 else 2.0) for k, f in ((0, 0), (0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (1, 4), (1, 5)) for p in range(4)], "clip string, chunk int, f int, px int, d double")
    r = solvers.overlap_ratios(d, "clip", "chunk", "f", "px", "d", least=2)
    x = r.first()
    assert x.ratio == pytest.approx(0.5) and x.trusted
    c = spark.createDataFrame([("c", 0, None, False), ("c", 1, 0.5, True), ("c", 2, 9.0, False)], "clip string, chunk int, ratio double, t boolean")
    assert [round(y.correction, 6) for y in windows.chained_correction(c, "clip", "chunk", "ratio", F.col("t")).orderBy("chunk").collect()] == [1, 0.5, 0.5]
    o = windows.owner_chunk(d.select("clip", "f", "chunk", F.when(F.col("chunk") == 0, 1.5).otherwise(3.5).alias("centre")).distinct(), ["clip"], "f", "centre", "chunk")
    assert {y.f: y.chunk for y in o.collect()} == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1}


def test_too_few_frames_for_a_scale(spark):
    d = spark.createDataFrame([("c", i, 1.0, 2.0, True) for i in range(5)], "clip string, f int, a double, b double, ok boolean")
    assert {(r.alpha, r.applied) for r in solvers.smooth_scale(d, ["clip"], "f", "a", "b", "ok").collect()} == {(2.0, False)}


def test_banded_solver_equals_dense():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 9, 40):
        a, b = rng.uniform(0.5, 2, n), rng.uniform(0.5, 2, n)
        d = np.zeros((max(n - 2, 0), n))
        for i in range(n - 2):
            d[i, i : i + 3] = 1, -2, 1
        m = np.diag(a * a + 1e-6) + 50.0 * (d.T @ d)
        assert solvers._banded_solve(a * a + 1e-6, 50.0, a * b) == pytest.approx(np.linalg.solve(m, a * b), rel=1e-8)
    x, ok = solvers.fit_scale(np.ones(30), np.full(30, 1.7), np.ones(30, bool), 50, 0.1)
    assert ok and x == pytest.approx(np.full(30, 1.7), abs=1e-4)
    assert solvers.metric_scale(np.full(50, 0.25), np.full(50, 0.5)) == pytest.approx(2.0, abs=1e-6)


def test_presence_is_strict(spark):
    assert one(spark, x=G.presence_mask(F.lit(0.6), F.lit(0.5))) == 1


def test_uniform_indices(spark):
    assert one(spark, x=shards.uniform_indices(F.lit(10), 4)) == [0, 3, 6, 9]
    assert one(spark, x=shards.uniform_indices(F.lit(3), 8)) == [0, 1, 2] and one(spark, x=shards.uniform_indices(F.lit(0), 8)) == []


def test_weighted_partition(spark):
    d = spark.createDataFrame(list(enumerate([5, 1, 1, 5])), "i bigint, w bigint")
    assert [r[:] for r in shards.weighted_partition(d, "i", "w", 2).orderBy("shard_id").collect()] == [(0, 0, 2, 6), (1, 2, 4, 6)]


def test_action_of_the_last_frame(spark):
    d = spark.createDataFrame([("c", 0, [1.0]), ("c", 1, [2.0])], "clip string, f int, s array<double>")
    r = windows.next_state(d, "clip", ["f"], "s", arr(0)).orderBy("f").collect()
    assert [x.action for x in r] == [[2.0], [0.0]]
    assert windows.next_state(d, "clip", ["f"], "s", arr(0), drop_last=True).count() == 1


def test_box_repair():
    b = np.array([[0, 0, 10, 10, 0.9], [0] * 5, [2, 0, 12, 10, 0.9], [0, 0, 100, 100, 0.2], [4, 0, 14, 10, 0.9]], float)
    out = solvers.prune_and_fill(b)
    assert out[1, 0] == 1 and out[3, 0] == 3


def test_track_rules(spark):
    rows = [("c", 1, i, True, 0.9, False, 1, 0.0, 0.0, 10.0, 10.0) for i in range(6)] + [("c", 2, i, True, 0.1, False, 0, 0.0, 0.0, 9.0, 9.0) for i in range(6)]
    d = spark.createDataFrame(rows, "clip string, track_id int, frame int, det boolean, conf double, is_near_edge boolean, handedness int, x1 double, y1 double, x2 double, y2 double")
    assert [(r.track_id, r.hand) for r in solvers.hands_of_tracks(d, "clip", "track_id").collect()] == [(1, 1)]
    t = solvers.track_inputs(d.where("track_id = 1"), ["clip", "track_id"], "frame")
    assert t.count() == 6 and t.first().is_right
    g = solvers.gate_edges(d, "clip", ["frame", "track_id"], F.lit(100), F.lit(100))
    assert g.where("track_id = 1").count() == 0 or g.count() > 0


def test_keyframe_interpolation(spark):
    keys = spark.createDataFrame([("c", 2, 0.0, [0.0, 0.0, 0.0, 1.0]), ("c", 4, 10.0, [0.0, 0.0, math.sin(0.5), math.cos(0.5)])], "clip string, t bigint, x double, q array<double>")
    spine = spark.createDataFrame([("c", i) for i in range(6)], "clip string, t bigint")
    r = resample.between_keyframes(spine, keys, "clip", "t", ["x"], "q").orderBy("t").collect()
    assert [y.x for y in r] == [0, 0, 0, 5, 10, 10] and r[3].q[2] == pytest.approx(math.sin(0.25))
    poses = spark.createDataFrame([("c", i, float(i)) for i in range(3)], "clip string, row bigint, x double")
    k = spark.createDataFrame([("c", 0, 1), ("c", 1, 3), ("c", 2, 3), ("c", 3, 2)], "clip string, row bigint, t bigint")
    assert [(y.t, y.x) for y in resample.clean_keyframes(k, poses, "clip", "t", "row").orderBy("t").collect()] == [(1, 0.0), (2, 1.0), (3, 2.0)]


def test_repair_of_gaps(spark):
    d = spark.createDataFrame([("c", i, v) for i, v in enumerate([0.0, float("nan"), 2.0, float("inf"), 4.0])], "clip string, f int, x double")
    r = [y.x for y in windows.repaired(d, ["clip"], "f", ["x"], 3).orderBy("f").collect()]
    assert r == pytest.approx([0, 1, 2, 3, 4])
    d = spark.createDataFrame([("c", 0, float("nan")), ("c", 1, 5.0)], "clip string, f int, x double")
    assert [y.x for y in windows.repaired(d, ["clip"], "f", ["x"]).orderBy("f").collect()] == [0.0, 5.0]


def test_chunks(spark):
    f = lambda n, b, o: [(r.start, r.end, r.ref) for r in one(spark, x=windows.overlapping_chunks(F.lit(n), b, o))]
    assert f(10, 4, 2) == [(0, 4, 2), (2, 6, 4), (4, 8, 6), (6, 10, 8)] and f(3, 4, 1) == [(0, 3, 1)] and f(0, 4, 1) == []


def test_annotations(spark):
    c = spark.createDataFrame([("f001_w002_v00003_i004",), ("b",), ("c",), ("d",)], "clip_id string")
    s = spark.createDataFrame([("factory001/f001_w002_v00003_i004.annotation.json", '{"instruction": ["1. go"], "language": " x "}'), ("b.annotation.json", "{"), ("c.annotation.json", '{"status": "Invalid"}')], "path string, body string")
    r = {x.clip_id: (x.annotation_error, x.instruction) for x in annotation.with_annotations(c, s).collect()}
    assert r == {"f001_w002_v00003_i004": (None, ["go"]), "b": ("invalid_json", []), "c": ("invalid_status", []), "d": ("missing_annotation", [])}
    a = annotation.with_annotations(c, s)
    assert annotation.annotated(a, True).count() == 1 and annotation.annotated(a, False).count() == 4
    assert annotation.issue_summary(a).first()[:] == (1, 1, 1, 0, 0, 3)


def test_names_and_ages(spark):
    assert one(spark, x=T.age(F.lit(3700))) == "1h" and one(spark, x=T.age(F.lit(None).cast("double"))) == "-"
    assert one(spark, x=T.safe_stem(F.lit("/a/b c.tar.gz"))) == "b_c.tar" and one(spark, x=T.clip_id_of_path(F.lit("a/b/c.mp4"))) == "a__b__c"
    assert one(spark, x=T.tar_frame_name(F.lit("c"), F.lit(5), F.lit(3), F.lit("JPG"), F.lit(2))) == "c_f007.jpg"
    assert one(spark, x=T.padded(F.lit(12345), F.lit(3))) == "12345"
    assert one(spark, x=T.member_parts(F.lit("a.b_f1.meta.json")))[:] == ("a.b_f1", "meta.json", "meta")
    assert str(one(spark, x=T.iso_time(F.lit("2026-01-02T03:04:05Z")))) == "2026-01-02 03:04:05" and one(spark, x=T.iso_time(F.lit("x"))) is None
    assert len(set(T.dimension_names())) == 116


def test_keys(spark):
    f = lambda s: one(spark, x=K.clip_key(F.lit(s)))
    assert f(" F006_W02_V0014_I05.mp4 ") == f("f006_w002_v00014_i005") == f("factory_006_worker_002_0014_cut005")
    assert f("Galley_1_-_take_003_-_seg_03") == f("galley_1/take_3/seg_3") and f(" ") is None
    g = lambda a, b: one(spark, x=K.group_key(F.lit(a), F.lit(b)))
    assert g(" Bench-01/", "/x") == "bench_01" and g("", "/a/Fac_2/") == "fac_2"


def test_sanity_report(spark):
    meta = Row(clip_id="a", instruction=["x"], instruction_num=1)
    schema = "shard string, pos bigint, key string, image binary, lowdim array<double>, mano binary, meta struct<clip_id:string,instruction:array<string>,instruction_num:int>, has_meta boolean"
    rows = [("s", 0, "a_f0", b"", vector(), b"", meta, True), ("s", 1, "a_f1", None, vector(bad=3), b"", meta, True), ("s", 2, "b_f0", b"", vector(), b"", None, False), ("s", 3, "a_f2", b"", vector(), b"", meta, True)]
    r = {x.counter: x.value for x in reports.sanity_report(spark.createDataFrame(rows, schema)).collect()}
    assert r["episodes"] == 3 and r["dropped_episodes"] == 2 and r["missing_meta"] == r["invalid_meta"] == 1 and r["nonfinite_lowdim"] == 1 and r["samples"] == 4


def test_native_validation(spark):
    f = frames(spark, [("a", i, vector(0.0), 3, 1, 1) for i in range(3)] + [("b", i, vector(float(i)), 3, 1, 1) for i in range(3)])
    r = {x.clip_id: x.valid for x in quality.native_vectors_valid(f).collect()}
    assert r == {"a": True, "b": False}


def test_merge_of_intervals(spark):
    d = spark.createDataFrame([("v", 0, 5), ("v", 5, 7), ("v", 9, 10), ("v", 2, 3)], "v string, s int, e int")
    assert sorted(r[:] for r in intervals.merge_intervals(d, "v", "s", "e").collect()) == [("v", 0, 7), ("v", 9, 10)]
