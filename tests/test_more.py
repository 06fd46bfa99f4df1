"""Further hand-made cases of solvers, shapes and reports."""

import pytest
from pyspark.sql import functions as F

from framewright.functions import geometry as G
from framewright.operators import monitor, quality, reports, solvers, windows


def test_disparity_raster(spark):
    d = spark.createDataFrame([("c", 0, 0.0, 0.0, 2.0), ("c", 0, 0.2, 0.0, 4.0), ("c", 0, 9.0, 9.0, 6.0), ("c", 1, 0.0, 0.0, 0.0)], "clip string, k int, x double, y double, disp double")
    r = {(x.k, x.iy, x.ix): x.disp for x in solvers.disparity_raster(d, "clip", "k", 2, 2).collect()}
    assert r == {(0, 0, 0): 3.0, (0, 0, 1): 4.0, (0, 1, 0): 4.0, (0, 1, 1): 6.0, (1, 0, 0): 0.01, (1, 0, 1): 0.01, (1, 1, 0): 0.01, (1, 1, 1): 0.01}


def test_stabilised_shape(spark):
    d = spark.createDataFrame([("c", i, [float(i), 1.0], [1.0, 2.0], s) for i, s in enumerate((1.0, 2.0, 4.0))], "clip string, f int, betas array<double>, t array<double>, size double")
    r = quality.stabilised_shape(d, ["clip"], "f", "betas", "t", "size").orderBy("f").collect()
    assert [x.betas for x in r] == [[1.0, 1.0]] * 3 and [x.t[0] for x in r] == [2.0, 1.0, 0.5]


def test_clip_scales(spark):
    d = spark.createDataFrame([("c", [0.25] * 20, [0.5] * 20), ("c", [0.1] * 20, [50.0] * 20)], "clip string, slam array<double>, pred array<double>")
    x = solvers.clip_scales(d, "clip", "slam", "pred").first()
    assert x.keyframes == 1 and x.scale == pytest.approx(2.0, abs=1e-6)


def test_anchored_median(spark):
    d = spark.createDataFrame([("c", 1.0, 10.0), ("c", 2.0, 20.0), ("c", 3.0, 30.0)], "clip string, raw double, z double")
    assert sorted(x.z for x in windows.anchored(d, ["clip"], "raw", "z").collect()) == pytest.approx([1.0, 2.0, 3.0])


def test_resume_and_counts(spark):
    s = spark.createDataFrame([("v", "s", "running"), ("w", "s", "running"), ("x", "s", "failed")], "video string, stage string, status string")
    m = spark.createDataFrame([("w", "s")], "video string, stage string")
    assert {r.video: r.status for r in monitor.resumed(s, m).collect()} == {"v": "pending", "w": "completed", "x": "failed"}
    v = reports.validation_counts(spark.createDataFrame([("a", True), ("a", False), ("b", True)], "check string, failed boolean"))
    assert {r.check: r.failures for r in v.collect()} == {"a": 1, "b": 1, "total": 2}


def test_depth_errors_and_rotations(spark):
    low = [0.0, 0.0, 1.0, 0.0, 0.0, 2.0] + [1.0, 0, 0, 0, 1, 0] * 2 + [0.0, 0.0, 1.0] * 10 + [0.0] * 48 + [1.0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1] + [1.0, 1.0, 0.0, 0.0]
    d = spark.createDataFrame([("k", [float(x) for x in low], [1500], 1, 1)], "key string, lowdim array<double>, depth_mm array<int>, h int, w int")
    e = reports.error_summary(reports.depth_action_errors(d)).first()
    assert (e.points, e.mean, e.max) == (12, 0.5, 0.5)
    r = reports.rotation_summary(spark.createDataFrame([("a", [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]), ("a", [2.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0])], "g string, m array<double>"), "m", ["g"]).first()
    assert (r.min_det, r.max_det, r.max_ortho_err) == (1.0, 2.0, 3.0)


def test_small_geometry(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    arr = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    assert one(G.gmof_weight(F.lit(0.0), 0.5)) == 1.0 and one(G.rounded_up(F.lit(130), 128)) == 256
    assert one(G.calibrated(F.lit(0.0), F.lit(None).cast("double"), F.lit(640), F.lit(480)))[:] == (320.0, 320.0, 240.0)
    assert one(G.along_ray(arr(1, 1, 1), arr(0, 0, 0), F.lit(2.0))) == [2, 2, 2]
    assert one(G.roi_bounds(F.lit(100), F.lit(50), 0.1, 0.0, 0.9, 1.0))[:] == (10, 0, 90, 50)
    assert one(G.extrinsic_is_sane(arr(1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1))) and not one(G.extrinsic_is_sane(arr(*[0] * 16)))
    assert one(G.in_wrist_frame(arr(1, 2, 3), arr(1, 1, 1), arr(1, 0, 0, 0, 1, 0))) == pytest.approx([0, 1, 2], abs=1e-6)
