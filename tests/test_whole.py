"""Queries that must take every row."""

import math

from framewright.operators import annotation, monitor
from framewright.plans import queries as core
from framewright.sources import manifest


def test_chained_correction_takes_every_chunk(spark):
    d = "/root/testdata/sf0.001"
    clips = {}
    for e in sorted(spark.read.parquet(f"{d}/events.parquet").collect(), key=lambda e: (e.ts, e.event_id)):
        clips.setdefault(e.user_id, []).append(e.value)
    want, cut = {}, 0
    for clip, values in clips.items():
        product = 1.0
        for f, v in enumerate(values):
            product *= v / 50 if v is not None and 5 <= v <= 200 else 1.0
            want[clip, f] = math.log(product)
            cut += f >= 6
    got = {(r.clip, r.f): r.log_correction for r in core.QUERIES["chained_correction"](spark, d).collect()}
    assert cut and got.keys() == want.keys()
    assert all(abs(got[k] - x) < 1e-5 for k, x in want.items())


def test_sets_hold_every_event(spark, tmp_path):
    rows = [(1, 7, "view"), (2, 7, "purchase"), (3, 7, "refund"), (4, 7, "error"), (5, 8, "signup"), (7, 8, "error"), (9, 9, None)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = {tuple(r) for r in core.QUERIES["required_and_hard_sets"](spark, str(tmp_path)).collect()}
    assert got == {(7, "", 1), (8, "purchase,refund,view", 2), (9, "purchase,refund,view", 0)}


def test_index_is_built_once(spark, tmp_path):
    made = []

    def members():
        made.append(1)
        return spark.createDataFrame([("a.tar", "c_f1.jpg", 0, 5), ("a.tar", "c_f2.jpg", 5, 5)], "shard string, name string, offset bigint, size bigint")

    one = spark.createDataFrame([("a.tar",), ("empty.tar",)], "shard string")
    path = f"{tmp_path}/index"
    for shards, times in ((one, 1), (one, 1), (one.where("shard = 'a.tar'"), 2)):
        got = manifest.load_or_build_index(spark, path, members, shards)
        assert [r.clip_id for r in got.collect()] == ["c"] and len(made) == times


def test_cache_holds_its_parameters(spark, tmp_path):
    x = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    manifest.write_cache(x.where("k = 'a'"), f"{tmp_path}/c", 3, {"fps": 30.0})
    manifest.write_cache(x.where("k = 'b'"), f"{tmp_path}/c", 3, {"fps": 25.0})
    got = manifest.cached(spark.read.parquet(f"{tmp_path}/c"), x.select("k"), "k", 3, {"fps": 30.0})
    assert {r.k: r.v for r in got.collect()} == {"a": 1.0, "b": None}


def test_status_falls_back(spark):
    kind = "video string, stage string, status string, failures bigint, error string"
    good, bad = spark.createDataFrame([("v", "s", "failed", 1, "x")], kind), spark.createDataFrame([("v", None, "failed", 1, "x")], kind)
    replay = spark.createDataFrame([("v", "s", "completed", 0, None)], kind)
    pick = lambda *xs: monitor.status_with_fallback(list(xs), replay).first().status
    assert pick(good, None) == "failed" and pick(bad, good) == "failed" and pick(bad, None) == "completed" and pick(good.where("false")) == "completed"


def test_issues_are_written(spark, tmp_path):
    d = spark.createDataFrame([(0, "a", "p", "invalid_json"), (1, "b", "q", None), (2, "c", "r", "missing_annotation")], "manifest_pos int, clip_id string, path string, annotation_error string")
    annotation.write_issues(d, str(tmp_path))
    assert [r.clip_id for r in spark.read.json(f"{tmp_path}/issues").orderBy("manifest_pos").collect()] == ["a", "c"]
    s = spark.read.json(f"{tmp_path}/summary").first()
    assert (s.invalid_json, s.missing_annotation, s.total) == (1, 1, 2)
