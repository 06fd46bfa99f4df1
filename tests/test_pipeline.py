"""Configuration, stages, hooks, and the filter and build paths on small tables."""

import io

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_fixtures import frames, vector

from framewright.functions import geometry as G
from framewright.plans import pipeline as P


def test_settings_and_stages():
    c = P.RunConfig.from_mapping({"criteria": {"a": 1, "b": 2}}, {"criteria": {"b": 3}, "target_fps": 10.0})
    assert c.criteria == {"a": 1, "b": 3} and c.target_fps == 10.0 and c.resume
    with pytest.raises(ValueError):
        P.RunConfig.from_mapping({"nonsense": 1})
    assert P.selected_stages("build, infer") == ["detect_track", "motion", "slam", "infiller", "build"]
    assert P.selected_stages("all", True)[-3:] == ["filter", "build", "validate"] and "slam" not in P.selected_stages("all", True)
    with pytest.raises(ValueError):
        P.selected_stages("x")


def test_adapters_models_and_answers(spark):
    a = P.Adapters()
    a.register("one")(lambda s, c: s.range(c["n"]))
    assert a.descriptors("one", spark, {"n": 3}).count() == 3 and P.preflight({"a": spark.range(1)}, {"a": ["id", "x"], "b": []}) == ["missing table b", "missing column a.x"]
    with pytest.raises(KeyError):
        a.descriptors("two", spark, {})
    d = spark.range(4)
    assert [r.y for r in P.with_model(d, "y bigint", lambda: lambda p: p.rename(columns={"id": "y"}) * 2).orderBy("y").collect()] == [0, 2, 4, 6]
    q = spark.createDataFrame([("ok",), ("bad",)], "p string")

    def call(x):
        if x == "bad":
            raise RuntimeError("429")
        return x.upper()

    assert {(r.p, r.answer, r.error) for r in P.with_answers(q, "p", call, 2, 0.0).collect()} == {("ok", "OK", None), ("bad", None, "429")}


def test_filter_and_build(spark):
    m = spark.createDataFrame([(0, "a", 3), (1, "b", 5), (2, "c", 4)], "manifest_pos bigint, clip_id string, n bigint")
    f = frames(spark, [("a", i, vector(0.001 * i), 3, 100, 100) for i in range(3)] + [("b", 0, vector(bad=1), 0, 100, 100)])
    d, report = P.filter_clips(m, f, {"camera_space_axis_abs_cap": 1.5})
    assert {r.clip_id: r.reasons[:1] for r in d.collect()} == {"a": [], "b": ["nonfinite_lowdim"], "c": ["empty_frames"]}
    assert {r.reason: r.clips for r in report.collect()}["dropped"] == 2
    side = spark.createDataFrame([("a.annotation.json", '{"instruction": ["go"]}')], "path string, body string")
    e = P.prepared_episodes(m, side, "n", P.RunConfig(frames_per_shard=6))
    assert [(r.episode_index, r.export_frames, r.shard_idx) for r in e.orderBy("episode_index").collect()] == [(0, 2, 0), (1, 4, 0), (2, 3, 1)]
    assert {r.code: r.clips for r in P.prepare_stats(e).collect()} == {"kept": 1, "missing_annotation": 2}
    assert P.prepared_episodes(m, side, "n", P.RunConfig(require_annotation=True)).count() == 1


def test_gates_and_encodings(spark):
    b = spark.createDataFrame([("v", 0, 0.0, 0.0, 50.0, 50.0, 0.9), ("v", 0, 50.0, 50.0, 90.0, 90.0, 0.5), ("v", 1, 0.0, 0.0, 50.0, 50.0, 0.9)], "video string, f int, x1 double, y1 double, x2 double, y2 double, conf double")
    assert {r.f: (r.valid, round(r.score, 2)) for r in P.detection_gate(b, ["video", "f"], 100, 100).collect()} == {0: (True, 0.7), 1: (False, 0.9)}
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(P.motion_gate(F.lit(5.0), F.lit(0.4), F.lit(100), F.lit(50))) and not one(P.motion_gate(F.lit(None).cast("double"), F.lit(1.0), F.lit(1), F.lit(1)))
    r = np.random.default_rng(0)
    basis, mean, coef = r.normal(size=(3, 5)), r.normal(size=5), r.normal(size=3)
    c = F.array(*[F.lit(float(v)) for v in coef])
    assert one(P.to_components(P.from_components(c, mean.tolist(), basis.tolist()), mean.tolist(), basis.tolist())) == pytest.approx(coef)
    p = one(P.hand_parameters(F.array(*[F.lit(float(v)) for v in range(110)])))
    assert p.right.shape[0] == 100 and len(p.left.pose) == 45
    v = F.array(*[F.lit(x) for x in vector()])
    assert one(P.native_depth_inputs(v)).cam2world == [1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1]


def test_predictions_and_depths(spark):
    out = io.BytesIO()
    np.savez(out, pred_trans=np.ones((2, 3, 3)), pred_rot=np.zeros((2, 3, 3)), pred_hand_pose=np.zeros((2, 3, 45)), pred_betas=np.zeros((2, 3, 10)), pred_valid=np.ones((2, 3)))
    d = spark.createDataFrame([("a", bytearray(out.getvalue())), ("b", bytearray(b"junk"))], "path string, content binary")
    assert P.pose_arrays(d).where("hand = 1 and valid = 1").count() == 3
    k, dep = spark.createDataFrame([("c", 0), ("c", 9)], "clip string, f int"), spark.createDataFrame([("c", 0, 1.0)], "clip string, f int, d double")
    assert P.keyframe_depths(k.where("f = 0"), dep, ["clip", "f"]).count() == 1
    with pytest.raises(Exception, match="no depth for key frame"):
        P.keyframe_depths(k, dep, ["clip", "f"]).collect()
    assert P.aligned_depths(dep, "clip", "f", spark.createDataFrame([("c", 1), ("e", 2)], "clip string, n_frames int")).where("ok").count() == 1
    spine = spark.createDataFrame([("c", i) for i in range(3)], "clip string, f int")
    left = spark.createDataFrame([("c", 0, 5.0)], "clip string, f int, x double")
    got = {(r.hand, r.f): r.x for r in P.merged_world(spine, left, left, "clip", "f", ["x"]).collect()}
    assert got[0, 0] == 0.0 and got[1, 0] == 5.0 and got[1, 2] == 0.0
    j = spark.createDataFrame([("c", i, 1.0) for i in range(12)], "clip string, f int, z double")
    px = spark.createDataFrame([("c", i, 1.2) for i in range(12) for _ in range(60)], "clip string, f int, depth double")
    a = [r.alpha for r in P.depth_aligned_hands(j, px, "clip", "f").collect()]
    assert len(a) == 12 and a == pytest.approx([1.2] * 12, abs=1e-3)
