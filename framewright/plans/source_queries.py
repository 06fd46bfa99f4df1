"""Queries of sources, writers, gates and solvers. Paths and member names are made from ids of the test tables by one recipe in both languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.functions import text as T
from framewright.operators import annotation, monitor, reports, shards, solvers, windows
from framewright.plans import pipeline
from framewright.plans.frame_queries import FR, frames116, r6
from framewright.session import load, scratch
from framewright.sources import manifest, tar

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


EV = "ev as (select event_id, user_id as clip, row_number() over (partition by user_id order by ts, event_id) - 1 as f, ts, event_type, value from events)"


def frames(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return load(s, d, "events").select("event_id", F.col("user_id").alias("clip"), (F.row_number().over(w) - 1).alias("f"), "ts", "event_type", "value")


def text_of(*parts) -> F.Column:
    return F.concat(*[F.lit(p[1:]) if p.startswith("'") else F.col(p).cast("string") for p in parts])


# --- manifests and indexes

@query(r"select row_number() over (order by manifest_pos) - 1 as pos, coalesce(clip_id, descriptor.clip_id) as clip_id, source_id, split, case when group_id <> '' then group_id else regexp_extract(regexp_replace(descriptor.root_dir, '/+$', ''), '([^/]+)$', 1) end as group_id, coalesce(len(descriptor.frame_offsets), -1) as offsets from clips")
def manifest_round_trip(s, d):
    """The clip table written as JSON lines and read back."""
    path = scratch(s, "manifest")
    tar.write_manifest(load(s, d, "clips"), path)
    return manifest.read_manifest(s, path).select(F.col("manifest_pos").alias("pos"), "clip_id", "source_id", "split", "group_id", F.coalesce(F.size("descriptor.frame_offsets"), F.lit(-1)).alias("offsets"))


_IX = r"one as (select tar_path, arg_min(frame_names, listing_id) as names from tar_sources where tar_path is not null group by tar_path), mem as (select tar_path as shard, unnest(names) as name from one), cl as (select regexp_extract(name, '([^/]+)_[fF][0-9]+\.[A-Za-z0-9]+\s*$', 1) as clip, min(shard) as shard, count(*) as n from mem group by 1 having count(distinct shard) = 1)"


def _index(s: SparkSession, d: str) -> DataFrame:
    from framewright.plans.queries import members

    return manifest.clip_index(members(s, d))


@query(f"with {_IX}, li as (select distinct tar_path as shard from tar_sources where tar_bytes > 40000), ix as (select distinct shard from cl) select shard, 'added' as change from li where shard not in (select shard from ix) union all select shard, 'removed' from ix where shard not in (select shard from li)")
def index_changes(s, d):
    return manifest.index_is_stale(_index(s, d), load(s, d, "tar_sources").where("tar_bytes > 40000").select(F.col("tar_path").alias("shard")))


@query(f"with {_IX} select clip as clip_id, n as frames from cl where clip >= 'f2'")
def clip_offsets(s, d):
    i = _index(s, d)
    return manifest.offsets_of(i, i.where("clip_id >= 'f2'")).select("clip_id", F.size("frame_offsets").cast("bigint").alias("frames"))


_SOUND = r"""one as (select tar_path, arg_min(frame_names, listing_id) as names from tar_sources where tar_path is not null group by tar_path), mem as (select tar_path as shard, unnest(names) as name from one),
p as (select shard, regexp_extract(name, '([^/]+)_[fF][0-9]+\.[A-Za-z]+$', 1) as clip, cast(nullif(regexp_extract(name, '_[fF]([0-9]+)\.[A-Za-z]+$', 1), '') as bigint) as f, lower(regexp_extract(name, '\.([A-Za-z]+)$', 1)) as ext from mem), ok as (select clip, count(*) as n from p where clip <> '' group by clip having count(distinct shard) = 1 and count(distinct ext) = 1 and max(f) - min(f) + 1 = count(*) and count(distinct f) = count(*))"""


@query(f"with {_SOUND} select clip as clip_id, 'hands' as source_id, 'train' as split, 'set_a' as group_id, 'tar_shard' as kind, true as light, n as frames from ok")
def index_records(s, d):
    """Manifest records of the indexed clips without error."""
    r = manifest.records(manifest.descriptors(_index(s, d), F.lit("/data/set_a/"), 30.0), "hands", "train")
    return r.select("clip_id", F.col("descriptor.frame_count_override").cast("bigint").alias("frames"), "source_id", "split", "group_id", F.col("descriptor.storage_kind").alias("kind"), (manifest.storage_class(F.col("descriptor")) == "light_tar").alias("light"))


@query(
    f"""with {EV}, k as (select clip, f, bool_or(event_type = 'refund') over (partition by clip) as lacks, f - row_number() over (partition by clip order by f) as g from ev where event_type <> 'error'), p as (select *, dense_rank() over (partition by clip order by g) - 1 as part_idx from k)
select clip as episode, part_idx, max(part_idx) over (partition by clip) + 1 as part_count, case when lacks then 'missing_payload' end as error, min(f) as start_frame, max(f) as end_frame, count(*) as frames from p group by clip, part_idx, lacks"""
)
def episode_segments(s, d):
    """Samples of episodes: errors are gaps, refunds lack their payload."""
    x = frames(s, d).where("event_type <> 'error'").withColumn("key", F.format_string("x_ep%d_f%d", "clip", "f"))
    m = x.select(F.lit("s").alias("shard"), (F.col("event_id") * 2).alias("offset"), F.lit(1).cast("bigint").alias("size"), F.concat("key", F.lit(".image.jpg")).alias("name"))
    m = m.unionByName(x.where("event_type <> 'refund'").select(F.lit("s").alias("shard"), (F.col("event_id") * 2 + 1).alias("offset"), F.lit(1).cast("bigint").alias("size"), F.concat("key", F.lit(".lowdim.npy")).alias("name")))
    return manifest.episode_segments(m).select("episode", "part_idx", "part_count", "error", "start_frame", "end_frame", "frames")


@query(
    f"""with {EV}, k as (select clip, count(*) as n, min(f) as a, max(f) as z, count(*) filter (event_type <> 'refund') as d from ev where event_type <> 'error' group by clip)
select (clip % 6 + 1)::varchar as subject, clip as trial, n as frame_count, d as depth_frames, case when z - a + 1 <> n then 'not_contiguous' when d > 0 and d <> n then 'depth_mismatch' end as error from k"""
)
def sequence_tars(s, d):
    x = frames(s, d).where("event_type <> 'error'").withColumn("shard", F.format_string("/d/Subject_%d_open_jar_%d.tar", F.col("clip") % 6 + 1, F.col("clip")))
    m = x.select("shard", F.format_string("a_f%d.image.jpg", "f").alias("name")).unionByName(x.where("event_type <> 'refund'").select("shard", F.format_string("a_f%d.depth.png", "f").alias("name")))
    return manifest.sequence_tars(m).select("subject", F.col("trial").cast("bigint").alias("trial"), F.col("frame_count").cast("bigint").alias("frame_count"), F.col("depth_frames").cast("bigint").alias("depth_frames"), "error")


@query("select listing_id, cast(listing_id % 9 as int) as factory, case when listing_id % 4 > 0 then cast(listing_id % 5 as int) end as worker, 't' || listing_id as stem from tar_sources where listing_id % 7 > 0")
def walked_tars(s, d):
    n = F.col("listing_id")
    worker = F.when(n % 4 > 0, F.format_string("worker_%02d/", n % 5)).otherwise("")
    f = load(s, d, "tar_sources").select(F.concat(F.lit("/r/"), F.when(n % 7 > 0, F.format_string("factory_%03d/", n % 9)).otherwise("other/"), worker, F.format_string("t%d.tar", n)).alias("path"))
    return manifest.walked_tars(f).select(F.substring("stem", 2, 20).cast("bigint").alias("listing_id"), "factory", "worker", "stem")


@query("select user_id::varchar as clip_id, count(*) filter (event_type <> 'error') as frame_count, min(event_id) filter (event_type <> 'error') as first_id from events group by 1 having count(*) filter (event_type <> 'error') > 0")
def image_folders(s, d):
    f = load(s, d, "events").select(F.concat(F.lit("/imgs/"), F.col("user_id").cast("string"), F.lit("/"), F.lpad(F.col("event_id").cast("string"), 12, "0"), F.when(F.col("event_type") == "error", ".txt").when(F.col("event_type") == "view", ".PNG").otherwise(".jpg")).alias("path"))
    return manifest.image_sequences(f).select("clip_id", F.col("frame_count").cast("bigint").alias("frame_count"), F.substring(F.get("frame_names", F.lit(0)), 1, 12).cast("bigint").alias("first_id"))


@query("select 'd' || user_id || '__v' || event_id as clip_id, event_id from events where event_type <> 'error'")
def video_files(s, d):
    f = load(s, d, "events").select(F.concat(F.lit("/videos/d"), F.col("user_id").cast("string"), F.lit("/v"), F.col("event_id").cast("string"), F.when(F.col("event_type") == "error", ".txt").otherwise(".MP4")).alias("path"))
    return manifest.video_folder(f, "/videos/").select("clip_id", F.regexp_extract("media_path", r"v(\d+)\.", 1).cast("bigint").alias("event_id"))


@query("select n_nationkey, case when n_nationkey % 3 = 0 then '/out/c' || n_nationkey when n_nationkey % 3 = 1 then '/out/grp/c' || n_nationkey else '/out/c' || n_nationkey end as folder from nation")
def moved_folders(s, d):
    k = F.col("n_nationkey").cast("string")
    x = load(s, d, "nation").select(F.concat(F.lit("c"), k).alias("clip_id"), F.struct(F.concat(F.lit("c"), k).alias("clip_id"), F.col("n_name").alias("clip_name"), F.lit("/in/grp/").alias("root_dir"), F.lit(None).cast("string").alias("seq_folder")).alias("descriptor"), "n_nationkey")
    there = x.where("n_nationkey % 3 = 0").select(F.concat(F.lit("/out/"), "clip_id").alias("path")).unionByName(x.where("n_nationkey % 3 < 2").select(F.concat(F.lit("/out/grp/"), "clip_id").alias("path")))
    return manifest.remapped(x, "/out/", there).select("n_nationkey", F.col("descriptor.seq_folder").alias("folder"))


@query("with p as (select user_id as clip, count(*) filter (event_type = 'view') as n, count(*) as m from events group by 1) select clip as clip_id, case when n = 0 then 'identity' when n = least(m, 4) then 'direct' else 'interpolate' end as mode, case when n = 0 then 500 else clip end::double as fx from p")
def clip_cameras(s, d):
    e = load(s, d, "events")
    c = e.groupBy(F.col("user_id").alias("clip_id")).agg(F.least(F.count("*"), F.lit(4)).alias("n_frames")).withColumn("k", F.array(F.col("clip_id").cast("double"), F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    return manifest.camera_of_clip(e.where("event_type = 'view'").select(F.col("user_id").alias("clip_id")), c).select("clip_id", "mode", F.col("k")[0].alias("fx"))


@query("select p_partkey, case when p_partkey % 3 = 0 and p_partkey % 2 = 0 then p_size end as cached from part")
def cached_features(s, d):
    p = load(s, d, "part")
    c = p.select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, 11).otherwise(9).alias("version"), F.when(F.col("p_partkey") % 2 == 0, 30.0).otherwise(25.0).alias("fps"), F.col("p_size").alias("cached"))
    return manifest.cached(c, p.select("p_partkey"), "p_partkey", 11, {"fps": 30.0})


@query("select c_custkey as id, cast(min(o_orderkey) filter (o_totalprice > 100000) as bigint) as first_valid from orders join customer on c_custkey = o_custkey group by c_custkey having count(*) filter (o_totalprice > 100000) > 0")
def first_valid_candidates(s, d):
    o = load(s, d, "orders").select(F.col("o_custkey").cast("bigint").alias("id"), F.col("o_orderkey").cast("bigint").alias("first_valid"), "o_totalprice")
    r = manifest.first_valid(o, "id", "first_valid", F.col("o_totalprice") > 100000)
    return r.join(load(s, d, "customer").select(F.col("c_custkey").cast("bigint").alias("id")), "id", "left_semi").select("id", "first_valid")


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def absent_members(s, d):
    return manifest.completed_members(load(s, d, "customer").select("c_custkey"), load(s, d, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query(f"with {FR} select clip as clip_id, row_number() over (partition by clip order by f) - 1 as frame_idx, (100 * vec_id + 3 * [0, 1, 6, 7, 8, 2, 9, 10, 11, 3, 12, 13, 14, 4, 15, 16, 17, 5, 18, 19, 20][8])::double as j7, (100 * vec_id + 2)::double as wrist_z from fr")
def skeletons(s, d):
    """Lines of 64 numbers (a frame from 1 with gaps, 21 points), brought to frames 0 .. n-1 in order; joint 7 is the eleventh point."""
    x = frames116(s, d).select("clip_id", "frame_idx", "vec_id")
    lines = x.select("clip_id", F.concat_ws(" ", F.col("frame_idx") + 1000, F.array_join(F.transform(F.sequence(F.lit(0), F.lit(62)), lambda i: (F.col("vec_id") * 100 + i).cast("string")), " ")).alias("value"))
    n = x.groupBy("clip_id").agg(F.count("*").cast("int").alias("n_frames"))
    return manifest.aligned_rows(manifest.skeleton_lines(lines), n).select("clip_id", F.col("frame_idx").cast("bigint").alias("frame_idx"), F.col("joints")[7][0].alias("j7"), F.col("joints")[0][2].alias("wrist_z"))


@query("select event_id, case event_id % 4 when 0 then false else true end as everything, case event_id % 4 when 0 then false when 1 then false else true end as cameras from events")
def retained_files(s, d):
    """What a cleanup would delete with only the result kept, and with camera files kept too."""
    n = F.col("event_id")
    f = load(s, d, "events").select("event_id", F.concat(F.lit("/o/"), n.cast("string"), F.when(n % 4 == 0, "/result.npz").when(n % 4 == 1, "/SLAM/cam.npz").when(n % 4 == 2, "/track.npz").otherwise("/frame.jpg")).alias("path"))
    return manifest.retained(f, "none").select("event_id", F.col("delete").alias("everything")).join(manifest.retained(f, "slam").select("event_id", F.col("delete").alias("cameras")), "event_id")


@query(f"with {FR}, bad as (select distinct clip, vec_id // 100 as sh from fr where lacks) select clip || '_f' || lpad(f::varchar, 6, '0') as key, round(list_sum(list_transform(state, lambda x: x::float::double)), 3) + 0.0 as state_sum, vec_id // 100 as shard, presence from fr where not exists (select 1 from bad where bad.clip = fr.clip and bad.sh = fr.vec_id // 100)")
def shard_round_trip(s, d):
    """Frame vectors written to tar shards and read back; clips with a frame that lacks its vector are left out."""
    n = F.col("vec_id")
    x = frames116(s, d).select(
        F.floor(n / 100).alias("shard_idx"), "clip_id", F.floor(n / 25).alias("episode_index"), "frame_idx", F.concat("clip_id", F.lit("_f"), F.lpad(F.col("frame_idx").cast("string"), 6, "0")).alias("key"),
        F.lit(b"jpg").alias("image"), tar.array_to_npy(F.col("lowdim")).alias("lowdim"), tar.array_to_npy(F.array(F.lit(1.0))).alias("mano"), F.lit(None).cast("binary").alias("depth"), tar.meta_bytes(F.struct("clip_id", "presence")).alias("meta"),
    )
    folder = scratch(s, "shards").removeprefix("file:")
    tar.write_shards(x, folder).count()
    r = tar.read_samples(s, folder, ["shard", "pos", "key", "lowdim", "meta"])
    total = F.aggregate(F.slice(tar.decoded_lowdim(F.col("lowdim")), 1, 48), F.lit(0.0), lambda t, v: t + v)
    return r.select("key", (F.round(total, 3) + 0.0).alias("state_sum"), F.regexp_extract("shard", r"shard-(\d+)\.tar", 1).cast("bigint").alias("shard"), tar.parsed_meta(F.col("meta"), "clip_id string, presence int")["presence"].cast("bigint").alias("presence"))


# --- texts and times

@query("select event_id, case when user_id % 3 = 0 then null else 'factory_' || lpad((user_id % 1000)::varchar, 3, '0') || '_worker_007_0012_cut034' end as long_name, 'run-my-host-' || strftime(ts, '%Y%m%d_%H%M%S') as tag, date_trunc('second', ts) as at, case user_id % 3 when 0 then '/e' when 1 then '/o/c' else '/r/c' end as folder from events")
def names_and_times(s, d):
    n = F.col("user_id")
    e = load(s, d, "events").withColumn("at", F.date_trunc("second", F.col("ts").cast("timestamp")))
    clip = F.when(n % 3 == 0, "other").otherwise(F.format_string("f%d_w7_v12_i34", n % 1000))
    stamp = F.concat(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    none = F.lit(None).cast("string")
    folder = T.seq_folder(F.when(n % 3 == 0, "/e").otherwise(none), F.when(n % 3 == 1, "/o/").otherwise(F.lit("")), F.lit("/r"), F.lit("c"))
    return e.select("event_id", T.long_clip_name(clip).alias("long_name"), T.run_tag(F.lit("run-{hostname}-{timestamp}"), F.lit(" My Host "), F.col("at")).alias("tag"), T.iso_time(stamp).cast("timestamp_ntz").alias("at"), folder.alias("folder"))


@query("select event_id, k, (event_id % 7 + k)::double as start, case when k = 0 then (event_id % 11)::double else 0 end as \"end\" from events, (select unnest([0, 1]) as k)")
def answer_segments(s, d):
    """Two segments of an answer under different names."""
    n = F.col("event_id")
    raw = F.format_string('```json\n{"segments": [{"start": %d, "end_sec": %d}, {"begin": %d}, 5]}\n```', n % 7, n % 11, n % 7 + 1)
    x = load(s, d, "events").select("event_id", F.posexplode(T.segments(raw)).alias("k", "seg"))
    return x.select("event_id", "k", T.segment_bounds(F.col("seg")).alias("b")).select("event_id", "k", "b.start", "b.end")


# --- gates, tracks, depths

def boxes(s: SparkSession, d: str) -> DataFrame:
    """A user is a track; boxes grow with the value, and errors have none."""
    v, e = F.col("value"), F.col("event_type") == "error"
    return frames(s, d).select("clip", "f", F.when(e, 0.0).otherwise(v).alias("x1"), F.when(e, 0.0).otherwise(v / 2).alias("y1"), F.when(e, 0.0).otherwise(v + 20).alias("x2"), F.when(e, 0.0).otherwise(v / 2 + 30).alias("y2"), ((F.col("event_id") % 10) / 10).alias("conf"), "event_type", "event_id")


@query(f"with {EV} select clip, count(*) filter (event_type <> 'error' and event_id % 10 >= 3 and value < 150 and value / 2 < 75) >= 2 as valid, round(coalesce(avg(case when event_type <> 'error' and event_id % 10 >= 3 and value < 150 and value / 2 < 75 then event_id % 10 / 10.0 end), 0), 6) as score from ev group by clip")
def gated_detections(s, d):
    g = pipeline.detection_gate(boxes(s, d), ["clip"], 200.0, 100.0, (0.0, 0.0, 0.75, 0.75), 0.3, (0.02, 0.5), 2)
    return g.select("clip", "valid", F.round("score", 6).alias("score"))


@query("select event_id, coalesce(value / 1000 <= 0.05 * 640 / 320 and event_id % 10 / 10.0 >= 0.3, false) as ok from events")
def gated_motion(s, d):
    e = load(s, d, "events")
    return e.select("event_id", pipeline.motion_gate(F.col("value") / 1000, (F.col("event_id") % 10) / 10, F.lit(2), F.lit(1), 0.05, 0.3).alias("ok"))


@query(
    f"""with {EV}, b as (select clip, f, case when event_type = 'error' then 0 else value + 10 end as cx, case when event_type = 'error' then 0 else value / 2 + 15 end as cy, case when event_type = 'error' then 0 else sqrt(1300) end as dg from ev), p as (select *, lag(cx) over w as px, lag(cy) over w as py, lag(dg) over w as pd from b window w as (partition by clip order by f))
select clip, f, px is null or case when dg + pd > 0 then sqrt((cx - px) ** 2 + (cy - py) ** 2) / ((dg + pd) / 2) else 0 end < 3 as valid from p"""
)
def steady_boxes(s, d):
    return solvers.velocity_valid(boxes(s, d), ["clip"], "f").select("clip", "f", "valid")


@query(f"with {EV}, g as (select clip, count(*) as n, avg(case when event_type <> 'error' then event_id % 10 / 10.0 end) as c, avg(case when value > 80 then 1 else 0 end) as e, avg(case when event_type <> 'error' then event_id % 2 end) as r from ev group by clip) select clip, case when r < 0.5 then 0 else 1 end as hand from g where n >= 5 and c >= 0.3 and e <= 0.7")
def tracks_by_hand(s, d):
    x = boxes(s, d).select("clip", F.lit(1).alias("track"), (F.col("event_type") != "error").alias("det"), "conf", (F.col("x1") + 0 > 80).alias("near"), (F.col("event_id") % 2).alias("handedness"), "event_id")
    e = load(s, d, "events").select("event_id", (F.col("value") > 80).alias("is_near_edge"))
    return solvers.hands_of_tracks(x.join(e, "event_id"), "clip", "track").select("clip", "hand")


@query(
    f"""with {EV}, v as (select clip, f // 20 as chunk, f, value / 50 + 0.1 as dep from ev where event_type <> 'error'), p as (select unnest(generate_series(0, 4)) as pixel), a as (select clip, chunk, f, pixel, dep * (1 + pixel / 10.0) * (1 + chunk / 5.0) as dep from v, p),
b as (select clip, chunk + 1 as chunk, f, pixel, ln(dep) as l from a), o as (select clip, f // 20 as chunk, f from ev where event_type <> 'error'), w as (select clip, chunk + 1 as chunk, f, value / 50 + 0.1 as dep from (select ev.*, f // 20 as chunk from ev where event_type <> 'error') where f % 20 >= 16),
c as (select w.clip, w.chunk, w.f, pixel, ln((1 + (w.chunk - 1) / 5.0) / (1 + w.chunk / 5.0)) as lr from w, p) select clip, chunk, round(exp(median(lr)), 6) as ratio, true as trusted from c group by clip, chunk"""
)
def chunk_scale_ratios(s, d):
    """Chunks of 20 frames that also hold the last four frames of the chunk before, each chunk at a scale of its own."""
    x = frames(s, d).where("event_type <> 'error'").select("clip", F.floor(F.col("f") / 20).alias("chunk"), "f", (F.col("value") / 50 + 0.1).alias("dep"))
    x = x.unionByName(x.where("f % 20 >= 16").withColumn("chunk", F.col("chunk") + 1)).withColumn("pixel", F.explode(F.sequence(F.lit(0), F.lit(4))))
    x = x.withColumn("dep", F.col("dep") * (1 + F.col("pixel") / 10) * (1 + F.col("chunk") / 5))
    r = solvers.overlap_ratios(x, "clip", "chunk", "f", "pixel", "dep", least=5)
    return r.select("clip", "chunk", F.round("ratio", 6).alias("ratio"), "trusted")


@query(f"with {EV}, z as (select clip, f // 10 as g, median(value / 50) as z from ev where value > 0 group by all), q as (select clip, f // 10 as g, median(value / 100) as d, count(*) as n from ev where value / 100 between 0.05 and 5 and event_type = 'view' group by all having count(*) >= 2), a as (select distinct clip, f // 10 as g from ev) select a.clip, a.g, round(z, 6) as z, round(d, 6) as d, z is not null and d is not null as valid from a left join z using (clip, g) left join q using (clip, g)")
def hand_depth_targets(s, d):
    x = frames(s, d).withColumn("g", F.floor(F.col("f") / 10))
    r = solvers.depth_targets(x.withColumn("z", F.col("value") / 50), x.where("event_type = 'view'").withColumn("depth", F.col("value") / 100), "clip", "g", least=2)
    return r.select("clip", "g", F.round("z", 6).alias("z"), F.round("d", 6).alias("d"), "valid")


@query(
    f"""with {EV}, p as (select clip, f // 16 as k, round_even(value / 100, 0) as x, case when event_type = 'error' then 0 else value / 10 end as disp, (event_id % 2)::int as iy from ev), c as (select clip, k, iy, least(greatest(x, 0), 2)::int as ix, avg(disp) as v from p where disp > 1e-6 group by all), m as (select clip, k, median(disp) as m from p where disp > 1e-6 group by all),
g as (select distinct clip, k, iy, ix from p, (select unnest([0, 1, 2]) as ix), (select unnest([0, 1]) as iy2)), h as (select distinct p.clip, p.k, y.iy, x.ix from p, (select unnest([0, 1]) as iy) y, (select unnest([0, 1, 2]) as ix) x) select h.clip, h.k, h.iy, h.ix, round(coalesce(v, m, 0.01), 6) as disp from h left join c using (clip, k, iy, ix) left join m using (clip, k)"""
)
def disparity_rasters(s, d):
    x = frames(s, d).select("clip", F.floor(F.col("f") / 16).alias("k"), (F.col("value") / 100).alias("x"), (F.col("event_id") % 2).cast("double").alias("y"), F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value") / 10).alias("disp"))
    return solvers.disparity_raster(x, "clip", "k", 2, 3).withColumn("disp", F.round("disp", 6))


@query(f"with {EV}, k as (select clip, f from ev where f % 5 = 0) select k.clip, k.f, ev.value from k join ev using (clip, f)")
def keyframe_depth_rows(s, d):
    x = frames(s, d)
    return pipeline.keyframe_depths(x.where("f % 5 = 0").select("clip", "f"), x.select("clip", "f", "value"), ["clip", "f"])


@query(f"with {EV}, n as (select clip, count(*) // 2 as n from ev group by clip), b as (select distinct clip from ev join n using (clip) where f < n and event_type = 'error') select clip, n > 0 and clip not in (select clip from b) as ok from n")
def depth_alignment(s, d):
    """Artifacts as long as the clip for half of its frames; frames of errors are missing."""
    x = frames(s, d)
    n = x.groupBy("clip").agg(F.floor(F.count("*") / 2).alias("n_frames"))
    return pipeline.aligned_depths(x.where("event_type <> 'error'"), "clip", "f", n)


@query(f"with {EV}, w as (select clip from ev group by clip having count(*) filter (event_type = 'error') = 0) select clip, f, h as hand, case when h = 0 and clip in (select clip from w) then value when h = 1 and event_type <> 'view' then value else 0 end as v from ev, (select unnest([0, 1]) as h)")
def merged_hands(s, d):
    """The left hand covers a clip unless it has an error; the right one lacks views."""
    x = frames(s, d).withColumn("v", F.col("value"))
    return pipeline.merged_world(x, x.where("event_type <> 'error'"), x.where("event_type <> 'view'"), "clip", "f", ["v"]).select("clip", "f", "hand", "v")


@query(f"with {EV}, m as (select clip, median(value) as a, median(value * (1 + f / 10.0)) as b from ev group by clip) select clip, f, round(value * (1 + f / 10.0) * coalesce(a / nullif(b, 0), 1), 6) as z from ev join m using (clip)")
def anchored_depths(s, d):
    x = frames(s, d).withColumn("z", F.col("value") * (1 + F.col("f") / 10))
    return windows.anchored(x, ["clip"], "value", "z").select("clip", "f", F.round("z", 6).alias("z"))


# --- builds and runs

@query("with s as (select clip_id, min(text) as body from documents where doc_type = 'raw_response' and clip_id is not null and text is not null group by 1) select coalesce(case when s.body is null then 'missing_annotation' end, 'other') as code, count(*) as clips from clips left join s using (clip_id) group by 1")
def prepared_codes(s, d):
    """Clips prepared for a build by annotation code; what answers there are don't count as sidecars."""
    docs = load(s, d, "documents").where("doc_type = 'raw_response' and clip_id is not null and text is not null").select(F.concat("clip_id", F.lit(".annotation.json")).alias("path"), F.col("text").alias("body"))
    e = pipeline.prepared_episodes(load(s, d, "clips").select("clip_id", "manifest_pos", F.lit(5).alias("n")), docs, "n", pipeline.RunConfig())
    p = pipeline.prepare_stats(e)
    return p.groupBy(F.when(F.col("code") == "missing_annotation", F.col("code")).otherwise("other").alias("code")).agg(F.sum("clips").alias("clips"))


@query("select count(*) filter (event_type = 'view') as written_shards, count(*) filter (event_type = 'click') as reused_shards, count(*) filter (event_type = 'error') as failed_shards, coalesce(sum(event_id % 100) filter (event_type = 'view'), 0)::bigint as written_frames, coalesce(sum(event_id % 100) filter (event_type = 'click'), 0)::bigint as reused_frames, sum(event_id % 3)::bigint as skipped_clips from events")
def totals_of_build(s, d):
    t = F.col("event_type")
    e = load(s, d, "events").select(F.when(t == "view", "written").when(t == "click", "reused").when(t == "error", "failed").otherwise("other").alias("status"), (F.col("event_id") % 100).alias("frames"), (F.col("event_id") % 3).alias("skipped_clips"))
    return shards.build_totals(e)


@query("select coalesce(event_type, 'none') as \"check\", count(*) filter (value > 50) as failures from events group by 1 union all select 'total', count(*) filter (value > 50) from events")
def failed_checks(s, d):
    return reports.validation_counts(load(s, d, "events").select(F.coalesce("event_type", F.lit("none")).alias("check"), (F.col("value") > 50).alias("failed")))


@query("select event_id, case when event_id % 5 = 0 then 'completed' when event_type = 'view' then 'pending' else event_type end as status from events")
def resumed_states(s, d):
    t = F.col("event_type")
    e = load(s, d, "events").select(F.col("event_id").cast("string").alias("video"), F.lit("s").alias("stage"), F.when(t == "view", "running").otherwise(t).alias("status"), "event_id")
    return monitor.resumed(e, e.where("event_id % 5 = 0").select("video", "stage")).select("event_id", "status")


@query("select event_id, 2 as instruction_num, 'put, ' || event_type as instruction, event_type as kept from events where event_type is not null")
def new_instructions(s, d):
    e = load(s, d, "events").where("event_type is not null").select("event_id", F.struct(F.array(F.lit("old")).alias("instruction"), F.lit(1).alias("instruction_num"), F.col("event_type").alias("kept")).alias("meta"))
    r = annotation.with_new_instruction(e, F.array(F.lit("put"), F.col("meta.kept")))
    return r.select("event_id", F.col("meta.instruction_num").alias("instruction_num"), F.array_join("meta.instruction", ", ").alias("instruction"), F.col("meta.kept").alias("kept"))


@query(f"with {EV}, p as (select clip, f, value, lead(value) over (partition by clip order by f) as nv from ev), n as (select clip, count(*) as n from ev group by clip), g as (select clip, t, n, least(t * (n - 1)::double / 9, n - 1) as pos from n, (select unnest(generate_series(0, 9)) as t)) select g.clip, g.t, round(value + case when pos > floor(pos) then (pos - floor(pos)) * (nv - value) else 0 end, 5) as value from g join p on p.clip = g.clip and p.f = floor(case when n = 10 then t else pos end)")
def spread_frames(s, d):
    """Ten target frames of each clip without frame rates, spread evenly."""
    from framewright.operators import resample

    x = frames(s, d)
    n = x.groupBy("clip").agg(F.count("*").alias("n"))
    zero = F.lit(0.0)
    g = resample.target_grid(n, "clip", F.col("n"), F.lit(10), zero, zero)
    return resample.resample_linear(x, g, "clip", "f", ["value"]).select("clip", "t", F.round("value", 5).alias("value"))
