"""Problems 2, 5 and 6 on small cases: brute force, nulls, ties, repeated rows, empty tables, extra columns."""

import math
import random

import pytest
from pyspark.sql import functions as F

from framewright import session
from framewright.operators import compaction, control_charts, intervals

IV = "interval_id bigint, video string, fps double, start_frame bigint, end_frame bigint, start_sec double, end_sec double, score double, s string, e int, kind string"


def iv(spark, rows):
    return spark.createDataFrame([(i, *r, 0.5, "extra", 7, "x") for i, r in enumerate(rows)], IV)


def brute_periods(rows):
    by = {}
    for v, fps, a, z, sa, sz in rows:
        a = a if a is not None else (round(sa * fps) if sa is not None and fps is not None else None)
        z = z if z is not None else (round(sz * fps) if sz is not None and fps is not None else None)
        if v is not None and a is not None and z is not None and z > a:
            by.setdefault(v, []).append((a, z))
    out = []
    for v, xs in by.items():
        per = []
        for a, z in sorted(xs):
            if per and a <= per[-1][1]:
                per[-1][1] = max(per[-1][1], z)
            else:
                per.append([a, z])
        out += [(v, "period", a, z) for a, z in per] + [(v, "gap", p[1], q[0]) for p, q in zip(per, per[1:])]
    return sorted(out)


@pytest.mark.parametrize("shard", [4, 16, 1 << 16])
def test_periods_against_brute_force(spark, shard):
    r = random.Random(shard)
    rows = []
    for _ in range(300):
        a = r.randint(-20, 400)
        rows.append((r.choice(["a", "b", "b", "b", None]), 10.0, None if r.random() < 0.1 else a, None if r.random() < 0.1 else a + r.choice([-3, 0, 1, 2, 5, 30]), a / 10 if r.random() < 0.7 else None, (a + 4) / 10 if r.random() < 0.7 else None))
    rows += rows[:40]
    got = sorted(tuple(x) for x in intervals.periods_and_gaps(iv(spark, rows), shard).collect())
    assert got == brute_periods(rows)


def test_periods_edge_cases(spark):
    assert intervals.periods_and_gaps(iv(spark, []).where("false")).count() == 0
    rows = [("v", 10.0, 0, 10**12, None, None), ("v", None, None, 5, 1.0, None), ("v", 10.0, None, None, float("nan"), 2.0), ("w", 1.0, 5, 5, None, None), ("w", 1.0, 6, 4, None, None)]
    assert [tuple(x) for x in intervals.periods_and_gaps(iv(spark, rows)).collect()] == [("v", "period", 0, 10**12)]


ST = "stat_id bigint, clip_id string, source_id string, group_id string, clip_seq int, eval_time timestamp, " + ", ".join(f"{m} double" for m in control_charts.STEP_METRICS) + ", metric string, reason string, m int, b int"


def stats(spark, rows):
    from datetime import datetime, timedelta

    t0 = datetime(2026, 1, 1)
    return spark.createDataFrame([(i, c, s, g, q, None if q is not None and q % 11 == 0 else t0 + timedelta(minutes=i), *x, "extra", "extra", 1, 2) for i, (c, s, g, q, x) in enumerate(rows)], ST)


def flagged(df, reason=None):
    return {(r.clip_id, r.metric) for r in df.collect() if reason in (None, r.reason)}


def test_readings(spark):
    r = random.Random(3)
    H, FI, CT, CR = control_charts.STEP_METRICS
    rows = [(f"c{i}", "src", f"g{i // 40}", i % 40, [r.lognormvariate(-3, 0.5) for _ in range(4)]) for i in range(600)]
    top = max(x[4][0] for x in rows)
    rows[5][4][0] = top * 3.3
    rows[6][4][0] = top * 900
    rows[7][4][1], rows[8][4][2], rows[9][4][3] = -1.0, float("inf"), 2.9
    rows[10][4][0], rows[11][4][0], rows[12][4][0] = None, float("nan"), 0.0
    for i in range(50, 58):
        rows[i][4][2] = 0.0123456 * (1 + 1e-6 * (i % 2))
    rows[53][4][2] = None  # skipped, the run goes on
    rows.append(rows[5])  # delivered twice
    out = control_charts.implausible_readings(stats(spark, rows))
    assert flagged(out, "spike") == {("c5", H), ("c6", H)}
    assert flagged(out, "physical") == {("c7", FI), ("c8", CT), ("c9", CR)}
    assert flagged(out, "stuck") == {(f"c{i}", CT) for i in range(50, 58) if i != 53}
    assert control_charts.implausible_readings(stats(spark, rows).where("false")).count() == 0


@pytest.mark.parametrize("block", [4, 7, 4096])
def test_stuck_runs_over_block_borders(spark, block):
    r = random.Random(block)
    vals, i = [], 0
    while len(vals) < 260:
        n = r.choice([1, 1, 1, 2, 5, 6, 9, 20])
        v = r.random() + 0.1
        vals += [v] * n
    vals = [None if r.random() < 0.1 else v for v in vals]
    rows = [(f"c{i:03d}", "s", "g", i, [v, None, None, None]) for i, v in enumerate(vals)]
    df = stats(spark, rows)
    got = {x.clip_id for x in control_charts.stuck_readings(df, ["source_id", "group_id"], "clip_seq", "clip_id", [control_charts.STEP_METRICS[0]], block=block).collect()}
    kept = [(f"c{i:03d}", v) for i, v in enumerate(vals) if v is not None]
    want = set()
    for i in range(len(kept) - 5):
        w = [v for _, v in kept[i : i + 6]]
        if max(w) - min(w) <= 1e-4 * max(w):
            want |= {c for c, _ in kept[i : i + 6]}
    assert got == want


TS = "listing_id bigint, tar_path string, frame_names array<string>, frame_offsets array<array<bigint>>, tar_bytes bigint, listed_at timestamp, clip_id string, name string"


def tars(spark, rows):
    from datetime import datetime

    return spark.createDataFrame([(i, p, n, o, 10_000, datetime(2026, 1, 1), "x", "y") for i, (p, n, o) in enumerate(rows)], TS)


def test_repeated_frames_and_plan(spark):
    d = "/r/src/grp/"
    rows = [(d + "a.tar", ["c_f1.jpg", "./c_f002.JPG", "frames/c_f00003.jpeg"], [[0, 10], [10, 0]]), (d + "b.tar", ["c_f02.jpg", "d_f0.png", None, "notes.txt"], None), (d + "a.tar", ["c_f1.jpg", "./c_f002.JPG", "frames/c_f00003.jpeg"], [[0, 10], [10, 0]]), (d + "c.tar", ["d_f7.jpg", "d_f07.jpg"], [[0, 5], [5, 5]]), (d + "e.tar", [], []), (None, ["z_f1.jpg"], None)]
    t = tars(spark, rows)
    assert {(r.clip_id, r.frame_idx) for r in compaction.repeated_frames(t).collect()} == {("c", 2), ("d", 7)}
    p = compaction.compaction_plan(t, max_small=2).collect()
    assert sorted((r.clip_id, r.frame_idx) for r in p) == [("c", 1), ("c", 2), ("c", 3), ("d", 0), ("d", 7)]
    assert {r.action for r in p} == {"rewrite"} and len({r.out_path for r in p}) == 1
    assert {r.action for r in compaction.compaction_plan(t, max_small=50).collect()} == {"rewrite"}  # it holds a frame twice
    assert {r.action for r in compaction.compaction_plan(t.where("listing_id = 0"), max_small=50).collect()} == {"keep"}
    two = tars(spark, [("/r/src/g1/x/a.tar", ["c_f1.jpg"], [[0, 10]]), ("/r/src/g2/x/b.tar", ["c_f1.jpg", "c_f2.jpg"], [[0, 10], [10, 5]]), ("/r/src/g3/x/d.tar", ["d_f1.jpg"], [[0, 10]])])
    got = {(r.clip_id, r.frame_idx): (r.action, r.out_path) for r in compaction.compaction_plan(two, max_small=50).collect()}
    assert {k: v[0] for k, v in got.items()} == {("c", 1): "rewrite", ("c", 2): "rewrite", ("d", 1): "keep"}
    assert {v[1] for k, v in got.items() if k[0] == "c"} == {"/r/src/compact-000000.tar"}  # partitions far below a file share one
    assert compaction.repeated_frames(t.where("false")).count() == compaction.compaction_plan(t.where("false")).count() == 0
    small = compaction.compaction_plan(t, target_bytes=1, max_small=0).collect()
    assert len({r.out_path for r in small}) == 2


def test_table_compaction(spark, tmp_path):
    t = compaction.SnapshotTable(spark, str(tmp_path / "t"), "p")
    for k in range(6):
        t.append(spark.createDataFrame([(k, "a", None), (k, "a", None), (k + 100, "b", 1.0)], "x int, p string, y double").coalesce(1))
    before = sorted((r.x, r.p, r.y) for r in t.read().collect())
    v = t.version()
    other = compaction.SnapshotTable(spark, str(tmp_path / "t"), "p")
    assert t.compact(max_small=3) == v + 1
    assert sorted((r.x, r.p, r.y) for r in t.read().collect()) == before
    assert {p: len(f) for p, f in t.files().items()} == {"a": 1, "b": 1}
    assert t.compact() is None and len(t.files(v)["a"]) == 6
    with pytest.raises(compaction.Conflict):
        other._commit(v, {"a": []})
    assert other._commit(v, {"new": []}) == v + 2


def test_guarded_join_beyond_the_bound(spark, monkeypatch):
    big = spark.range(200).select(F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (None, "c")], "k bigint, v string")
    for how in ("left", "inner", "left_semi"):
        a = sorted(map(str, session.guarded_join(big, small, ["k"], how).collect()))
        with monkeypatch.context() as m:
            m.setattr(session, "BROADCAST_BYTES", 1)
            b = sorted(map(str, session.guarded_join(big, small, ["k"], how).collect()))
        c = sorted(map(str, session.salted_join(big, small, ["k"], how, per=10).collect()))
        assert a == b == c and a


def test_size_of(spark):
    d = spark.createDataFrame([("abc", [1.0, 2.0], ["x", None], {"k": "v"}, (1, "yy"), None)], "s string, a array<double>, b array<string>, m map<string,string>, r struct<i:int,t:string>, n int")
    rows, size = session.size_of(d)
    assert rows == 1 and 100 < size < 400 and session.size_of(d.where("false")) == (0, 0)


def test_a_source_that_stands_still(spark):
    H = control_charts.STEP_METRICS[0]
    rows = [(f"c{i}", "still", "g", i, [0.02 if i == 40 else 0.0, 0.1 + i % 3 / 100, None, 0.0]) for i in range(80)]
    rows += [(f"d{i}", "moves", "h", i, [0.0 if i % 4 else 0.03 + i % 5 / 1000, None, None, None]) for i in range(20)]
    rows += [(f"e{i}", "moves", "k", i, [0.0 if i % 4 == 0 else 0.03 + i % 5 / 1000, None, None, None]) for i in range(80)]
    out = control_charts.implausible_readings(stats(spark, rows))
    assert flagged(out, "spike") == {("c40", H)}


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_charts_carry_their_state_between_batches(spark, batch):
    r = random.Random(9)
    rows = [(f"c{i}", f"s{i % 2}", "g", i, [r.lognormvariate(-3 + i / 400, 0.4) for _ in range(4)]) for i in range(400)]
    df = stats(spark, rows).coalesce(1).withColumn("__blk", F.lit(1))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {(x.ident, x.m) for x in control_charts.charted(df, "source_id", "__blk", ["clip_seq"], "stat_id", dict.fromkeys(control_charts.STEP_METRICS)).collect() if x.ident is not None}
        split = control_charts.charted(df, "source_id", "__blk", ["clip_seq"], "stat_id", dict.fromkeys(control_charts.STEP_METRICS), series_rows=50).count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = set()
    lv = {x.source_id: x for x in control_charts.source_levels(df, "source_id", dict.fromkeys(control_charts.STEP_METRICS)).collect()}
    for s in (0, 1):
        for m in range(4):
            mean, sd0 = lv[f"s{s}"][f"__c{m}"], lv[f"s{s}"][f"__s{m}"]
            var = sd0 * sd0
            for i in range(s, 400, 2):
                v, sd = math.log(rows[i][4][m]), math.sqrt(var)
                if v - mean > 2.5 * sd:
                    want.add((i, m))
                c = min(max(v - mean, -2.5 * sd), 2.5 * sd)
                mean += 0.05 * c
                var = min(max(0.95 * var + 0.05 * min(c * c, 2.25 * var) * 1.3, 0.25 * sd0 * sd0), 2.25 * sd0 * sd0)
    assert got == want and want and split > 0
