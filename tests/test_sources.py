"""Tar shards, payloads, manifests, adapters and streams, with files made here."""

import io
import json
import tarfile
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.operators import shards
from framewright.sources import manifest as M
from framewright.sources import tar as T
from framewright.streaming import events as E


def make_tar(path, files):
    with tarfile.open(path, "w") as t:
        for name, data in files:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def sample(key, i, depth=False):
    out = [(f"{key}.image.jpg", b"img%d" % i), (f"{key}.lowdim.npy", T.encode_npy(np.arange(116, dtype=np.float32) + i)), (f"{key}.mano.npy", T.encode_npy(np.zeros((2, 55), np.float32))), (f"{key}.meta.json", json.dumps({"clip_id": "c", "n": i}).encode())]
    return out + ([(f"{key}.depth.png", b"d")] if depth else [])


def test_samples_and_headers(spark, tmp_path):
    make_tar(tmp_path / "a.tar", sample("c_f000000", 0) + sample("c_f000001", 1, True))
    make_tar(tmp_path / "b.tar", sample("d_f000000", 2))
    s = T.read_samples(spark, str(tmp_path))
    assert s.count() == 3 and s.rdd.getNumPartitions() == 2
    v = s.select("key", T.decoded_lowdim(F.col("lowdim")).alias("v"), T.parsed_meta(F.col("meta"), "clip_id string, n int").alias("m")).orderBy("key").collect()
    assert v[1].v[:2] == [1.0, 2.0] and v[2].m.n == 2
    h = T.read_samples(spark, str(tmp_path), ["key", "meta"], 0, 1).collect()
    assert len(h) == 2 and b'"n": 0' in bytes(h[0].meta)
    with pytest.raises(Exception, match="bad shard range"):
        T.read_samples(spark, str(tmp_path), start=5).count()
    make_tar(tmp_path / "z.tar", [("oops.txt", b"")])
    with pytest.raises(Exception, match="no member of a sample"):
        T.read_samples(spark, str(tmp_path)).count()


def test_payload_round_trip(spark):
    d = spark.createDataFrame([([1.5, -2.0],), (None,)], "a array<double>")
    r = d.select(T.npy_to_array(T.array_to_npy(F.col("a"))).alias("b")).collect()
    assert r[0].b == [1.5, -2.0] and r[1].b is None
    assert spark.createDataFrame([(bytearray(b"junk"),)], "x binary").select(T.npy_to_array(F.col("x")).alias("b")).first().b is None


def test_members_index_and_bytes(spark, tmp_path):
    make_tar(tmp_path / "a.tar", [(f"x_f{i:04d}.jpg", b"%d" % i * 3) for i in (3, 1, 2)] + [("y_f0.jpg", b"q")])
    make_tar(tmp_path / "b.tar", [("y_f1.jpg", b"q"), ("z_f1.jpg", b"1"), ("z_f3.jpg", b"3"), ("w_f1.jpg", b"1"), ("w_f2.png", b"3")])
    m = T.read_members(spark, str(tmp_path))
    idx = {r.clip_id: r for r in M.clip_index(m).collect()}
    assert set(idx) == {"x", "z", "w"} and idx["z"].error == "not_contiguous" and idx["w"].error == "mixed_extensions"
    assert (idx["x"].frame_count, idx["x"].frame_start_idx, idx["x"].frame_index_width) == (3, 1, 4)
    fr = m.select(F.col("shard").alias("shard_path"), "offset", "size", "name")
    got = {r.name: bytes(r.data) for r in T.frame_bytes(fr).collect()}
    assert got["x_f0002.jpg"] == b"222" and got["z_f3.jpg"] == b"3"
    assert {r.name: bytes(r.data) for r in T.frame_bytes(fr.withColumn("offset", F.lit(None).cast("bigint"))).collect()} == got
    index = M.clip_index(m)
    assert M.index_is_stale(index, spark.createDataFrame([(str(tmp_path / "a.tar"),), ("new.tar",)], "shard string")).select("change").orderBy("change").collect()[0].change == "added"
    d = M.descriptors(index, F.lit("/r/fac_1"))
    rec = M.records(d, "src", "train").first()
    assert rec.clip_id == "x" and rec.group_id == "fac_1" and d.select(M.with_frame_names(F.col("descriptor"))[1]).first()[0] == "x_f0002.jpg"
    assert M.offsets_of(index, spark.createDataFrame([("x",)], "clip_id string")).count() == 1
    rm = M.remapped(d, "/out", spark.createDataFrame([("/out/fac_1/x",)], "path string")).first()
    assert rm.descriptor.seq_folder == "/out/fac_1/x"


def test_shard_writer(spark, tmp_path):
    rows = [(0, "a", 0, i, f"a_f{i:06d}", b"i", b"l", b"m", None, b"{}") for i in range(3)] + [(0, "b", 1, 0, "b_f000000", None, b"l", b"m", None, b"{}")] + [(1, "c", 2, 0, "c_f000000", b"i", b"l", b"m", b"d", b"{}"), (None, "e", 3, 0, "e_f0", b"", b"", b"", None, b"")]
    d = spark.createDataFrame(rows, "shard_idx bigint, clip_id string, episode_index bigint, frame_idx bigint, key string, image binary, lowdim binary, mano binary, depth binary, meta binary")
    r = {x.shard_idx: x for x in T.write_shards(d, str(tmp_path / "out")).collect()}
    assert (r[0].frames, r[0].clips, r[0].skipped_clips) == (3, 1, 1) and r[1].frames == 1
    back = T.read_samples(spark, str(tmp_path / "out"))
    assert sorted(x.key for x in back.select("key").collect()) == ["a_f000000", "a_f000001", "a_f000002", "c_f000000"]
    with tarfile.open(tmp_path / "out" / "shard-000001.tar") as t:
        assert t.getnames() == [f"c_f000000.{s}" for s in ("image.jpg", "lowdim.npy", "mano.npy", "depth.png", "meta.json")]
    tot = shards.build_totals(spark.createDataFrame([("written", 3, 1), ("reused", 2, 0)], "status string, frames bigint, skipped_clips bigint")).first()
    assert (tot.written_frames, tot.reused_shards, tot.skipped_clips) == (3, 1, 1)


def test_manifest_round_trip(spark, tmp_path):
    lines = ['{"clip_id": "b", "split": "train", "descriptor": {"video_key": "b", "factory_dir": "/x/fac_9/", "frame_names": ["f1"], "storage_kind": "image_sequence", "frame_dir": "/d"}}', "", '{"clip_id": "a", "group_id": "g", "descriptor": {"clip_id": "a", "storage_kind": "tar_shard", "extra": {}}}']
    (tmp_path / "m.jsonl").write_text("\n".join(lines))
    m = M.read_manifest(spark, str(tmp_path / "m.jsonl")).orderBy("manifest_pos")
    r = m.collect()
    assert [(x.manifest_pos, x.clip_id, x.group_id) for x in r] == [(0, "b", "fac_9"), (1, "a", "g")] and r[0].descriptor.clip_id == "b"
    assert [x.e for x in m.select(M.descriptor_error(F.col("descriptor")).alias("e")).collect()] == [None, "empty_frames"]
    T.write_manifest(m, str(tmp_path / "out"))
    assert M.read_manifest(spark, str(tmp_path / "out")).count() == 2
    assert M.batch_input(spark, manifest=str(tmp_path / "m.jsonl"), start=1).first().clip_id == "a"
    assert M.batch_input(spark, names=["p", "q"], end=1).count() == 1
    with pytest.raises(ValueError):
        M.batch_input(spark)


def test_listings(spark, tmp_path):
    for p in ("clip1/b.jpg", "clip1/a.jpg", "clip2/x.png", "v/one.mp4", "factory_007/worker_2/t.tar"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(b"x")
    f = M.listing(spark, str(tmp_path))
    assert {r.clip_id: r.frame_names for r in M.image_sequences(f, ["clip1"]).collect()} == {"clip1": ["a.jpg", "b.jpg"]}
    assert M.video_folder(f, str(tmp_path)).first().clip_id == "v__one"
    w = M.walked_tars(f).first()
    assert (w.factory, w.worker, w.stem) == (7, 2, "t")
    got = M.decoded_videos(M.video_folder(f, str(tmp_path)), lambda p: iter([(0, b"a"), (1, b"b")])).collect()
    assert [(r.clip_id, r.frame_idx) for r in got] == [("v__one", 0), ("v__one", 1)]
    k = M.retained(spark.createDataFrame([("/a/result.npz",), ("/a/SLAM/x",), ("/a/t.npy",)], "path string"), "slam")
    assert [r.delete for r in k.orderBy("path").collect()] == [False, False, True]


def test_adapters(spark):
    m = [("s", f"p_ep000001_f{i:06d}{x}", 10 * i, 5) for i in (0, 1, 4) for x in (".image.jpg", ".lowdim.npy")] + [("s", "p_ep000002_f000000.image.jpg", 0, 1)]
    d = spark.createDataFrame(m, "shard string, name string, offset bigint, size bigint")
    r = {(x.episode, x.part_idx): x for x in M.episode_segments(d).collect()}
    assert r[1, 0].frames == 2 and r[1, 1].clip_id == "ep000001_part001" and r[2, 0].error == "missing_payload"
    assert {x.error for x in M.episode_segments(d, split=False).collect()} == {"not_contiguous", "missing_payload"}
    t = spark.createDataFrame([("/d/Subject_1_open_jar_2.tar", f"a_f{i}.image.jpg") for i in range(3)] + [("/d/Subject_1_open_jar_2.tar", "a_f0.depth.png"), ("/d/junk.tar", "a_f0.image.jpg")], "shard string, name string")
    e = {x.shard: (x.clip_id, x.error) for x in M.sequence_tars(t).collect()}
    assert e == {"/d/Subject_1_open_jar_2.tar": ("FPHA_Subject_1_open_jar_2", "depth_mismatch"), "/d/junk.tar": (None, "bad_name")}


def test_skeleton_and_camera(spark):
    lines = spark.createDataFrame([("c", " ".join(map(str, [i + 1, *range(63)]))) for i in range(3)] + [("c", "1 2 3")], "clip_id string, value string")
    s = M.skeleton_lines(lines)
    a = M.aligned_rows(s, spark.createDataFrame([("c", 4)], "clip_id string, n_frames int")).orderBy("frame_idx").collect()
    assert [x.joints is None for x in a] == [False, False, False, True]
    cams = M.camera_of_clip(spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "clip_id string, t int"), spark.createDataFrame([("a", 2, [1.0] * 4), ("b", 2, None), ("z", 2, None)], "clip_id string, n_frames int, k array<double>"))
    assert {r.clip_id: (r.mode, r.k[0]) for r in cams.collect()} == {"a": ("direct", 1.0), "b": ("interpolate", 500.0), "z": ("identity", 500.0)}
    c = M.cached(spark.createDataFrame([("a", 11, 30.0, 1), ("b", 9, 30.0, 2)], "k string, version int, fps double, x int"), spark.createDataFrame([("a",), ("b",)], "k string"), "k", 11, {"fps": 30.0})
    assert {r.k: r.x for r in c.collect()} == {"a": 1, "b": None}
    f = M.first_valid(spark.createDataFrame([("a", 0, False), ("a", 1, True), ("a", 2, True)], "k string, r int, ok boolean"), "k", "r", F.col("ok")).first()
    assert f.r == 1
    assert M.completed_members(spark.range(3), spark.range(2), ["id"]).count() == 1


def test_event_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    ev = lambda v, e, t, w=1.0: json.dumps({"event": e, "video": v, "stage": "s", "time": t, "wall_sec": w})
    (src / "0.jsonl").write_text("\n".join([ev("a", "stage_failure", "2026-01-01T00:01:00Z"), "junk", ev("b", "stage_success", "2026-01-01T00:02:00Z", 3.0)]))
    (src / "1.jsonl").write_text("\n".join([ev("a", "stage_success", "2026-01-01T02:00:00Z"), ev("a", "stage_success", "2026-01-01T00:03:00Z")]))
    (src / "2.jsonl").write_text(ev("d", "stage_success", "2026-01-01T04:00:00Z"))
    (src / "3.jsonl").write_text(ev("c", "stage_success", "2026-01-01T00:05:00Z"))
    for i in range(4):
        import os

        os.utime(src / f"{i}.jsonl", (1_700_000_000 + i, 1_700_000_000 + i))
    q = E.stage_windows(E.read_events(spark, str(src))).writeStream.format("memory").queryName("w").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    first = spark.table("w").orderBy("start").first()
    assert (first.success, first.failure) == (2, 1)  # the event of the last file came too late
    q = E.running_states(E.read_events(spark, str(src), 10)).writeStream.format("memory").queryName("r").outputMode("update").option("checkpointLocation", str(tmp_path / "c2")).start()
    try:
        for _ in range(120):
            if q.lastProgress and spark.table("r").count() >= 4:
                break
            time.sleep(0.5)
        got = {(r.video): (r.status, r.failures) for r in spark.table("r").collect()}
    finally:
        q.stop()
    assert got["b"] == ("completed", 0) and got["a"] == ("completed", 1)
