"""Core queries over the test tables, and the SQL that must give the same rows.

The tables hold no 116-number frame vectors, so the frame operators run on stand-ins: a user of ``events`` is a clip, its events in
time order are frames and ``value`` is a scalar track. The clip, interval, tar and text tables are used as what they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.functions import geometry as G
from framewright.functions import keys as K
from framewright.functions import text as T
from framewright.operators import annotation, compaction, control_charts, intervals, monitor, quality, reports, resample, shards, solvers, windows
from framewright.session import load, scratch
from framewright.sources import manifest

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- tables as the operators want them, in both languages

EV = "ev as (select event_id, user_id as clip, row_number() over (partition by user_id order by ts, event_id) - 1 as f, ts, event_type, value from events)"
TAR1 = "one as (select tar_path, arg_min(frame_names, listing_id) as names, arg_min(frame_offsets, listing_id) as offs from tar_sources where tar_path is not null group by tar_path)"
MEM = TAR1 + ", mem as (select tar_path as shard, i - 1 as pos, names[i] as name, offs[i][1] as o, offs[i][2] as z from (select *, unnest(generate_series(1, len(names))) as i from one))"
FRM = MEM + r", frm as (select *, regexp_extract(name, '([^/]+)_[fF][0-9]+\.[A-Za-z0-9]+\s*$', 1) as clip, cast(regexp_extract(name, '_[fF]([0-9]+)\.[A-Za-z0-9]+\s*$', 1) as bigint) as frame from mem)"
FIN = "case when isfinite({0}) then {0} end"


def frames(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return load(s, d, "events").select("event_id", F.col("user_id").alias("clip"), (F.row_number().over(w) - 1).alias("f"), "ts", "event_type", "value")


def members(s: SparkSession, d: str) -> DataFrame:
    one = load(s, d, "tar_sources").where("tar_path is not null").groupBy("tar_path").agg(F.min_by(F.struct("frame_names", "frame_offsets"), "listing_id").alias("r"))
    m = one.select(F.col("tar_path").alias("shard"), F.col("r.frame_offsets").alias("o"), F.posexplode("r.frame_names").alias("pos", "name"))
    at = F.get("o", F.col("pos"))
    return m.select("shard", "pos", "name", F.get(at, F.lit(0)).alias("offset"), F.get(at, F.lit(1)).alias("size"))


def parsed(s: SparkSession, d: str) -> DataFrame:
    return members(s, d).withColumn("clip", K.frame_clip(F.col("name"))).withColumn("frame", K.frame_number(F.col("name")))


# --- problems of the core

P2 = """with iv as (select video, coalesce(start_frame, cast(round(start_sec * fps) as bigint)) as s, coalesce(end_frame, cast(round(end_sec * fps) as bigint)) as e from clip_intervals),
ok as (select distinct * from iv where video is not null and s is not null and e is not null and e > s),
n as (select *, case when max(e) over (partition by video order by s, e rows between unbounded preceding and 1 preceding) >= s then 0 else 1 end as new from ok),
g as (select *, sum(new) over (partition by video order by s, e rows unbounded preceding) as k from n),
p as (select video, min(s) as s, max(e) as e from g group by video, k)
select video, 'period' as kind, s as start_frame, e as end_frame from p
union all select video, 'gap', e, ns from (select video, e, lead(s) over (partition by video order by s) as ns from p) where ns is not null"""


@query(P2)
def p2_found(s, d):
    return intervals.periods_and_gaps(load(s, d, "clip_intervals"))


def _p5_sql() -> str:
    head = "with one as (select clip_id, arg_min(struct_pack(source_id, group_id, clip_seq, " + ", ".join(control_charts.STEP_METRICS) + "), stat_id) as r from clip_quality_stats group by clip_id), "
    long = " union all ".join(f"select clip_id, r.source_id as src, r.group_id as g, r.clip_seq as q, '{m}' as metric, r.{m} as x from one" for m in control_charts.STEP_METRICS)
    lim = "case when metric = 'max_camera_rotation_step' then 2 * sqrt(2) else 'infinity'::double end"
    return head + f"""l as (select * from ({long}) where x is not null and not isnan(x)),
bad as (select clip_id, metric from l where x < 0 or isinf(x) or x > {lim}),
ord as (select *, lag(x) over w as below, percent_rank() over w as pr from l where x > 0 and not isinf(x) and x <= {lim} window w as (partition by src, metric order by x)),
still as (select src, metric from l where not isinf(x) and x between 0 and {lim} group by src, metric having count(*) filter (x = 0) * 2 > count(*)),
cut as (select src, metric, min(below) as h from ord anti join still using (src, metric) where pr >= 0.75 and x > 3 * below group by src, metric union all select src, metric, 0.0 from still),
spike as (select l.clip_id, l.metric from l join cut using (src, metric) where l.x > 3 * h and not isinf(l.x) and l.x <= {lim}),
st as (select *, min(x) over w as lo, max(x) over w as hi, count(*) over w as n from l window w as (partition by src, g, metric order by q rows between 5 preceding and current row)),
en as (select *, n = 6 and lo > 0 and not isinf(hi) and hi - lo <= 1e-4 * hi as e from st),
stuck as (select clip_id, metric from (select *, max(cast(e as int)) over (partition by src, g, metric order by q rows between current row and 5 following) as f from en) where f = 1)
select * from bad union select * from spike union select * from stuck"""


@query(_p5_sql())
def p5_found(s, d):
    return control_charts.implausible_readings(load(s, d, "clip_quality_stats")).select("clip_id", "metric").distinct()


@query()
def p5_reasons(s, d):
    return control_charts.implausible_readings(load(s, d, "clip_quality_stats")).distinct()


@query(f"with {FRM} select clip as clip_id, frame as frame_idx from frm group by all having count(*) > 1")
def p6_found(s, d):
    return compaction.repeated_frames(load(s, d, "tar_sources"))


@query()
def p6_compaction_plan(s, d):
    return compaction.compaction_plan(load(s, d, "tar_sources"))


@query(f"with {FRM} select clip as clip_id, count(distinct frame) as frames from frm group by clip")
def p6_plan_frames(s, d):
    """Frames held per clip by the plan: each frame named exactly once."""
    return compaction.compaction_plan(load(s, d, "tar_sources")).groupBy("clip_id").agg(F.count("*").alias("frames"))


@query("select event_type, count(*) as rows, 8 as files_before, 1 as files_after, true as same from events group by event_type")
def p6_rewrite(s, d):
    """Events by type in eight small files a partition, rewritten as one each."""
    return compaction.rewritten(load(s, d, "events").select("event_id", "user_id", "value", "props", "event_type"), scratch(s, "compaction"), "event_type")


# --- scans and descriptors

NCOUNT = "coalesce(descriptor.frame_count_override, len(descriptor.frame_names), 0)"
LIGHT = "(coalesce(len(descriptor.frame_names), 0) = 0 and descriptor.frame_offsets is null)"
CLASS = f"case when descriptor.storage_kind = 'tar_shard' and {LIGHT} then 'light_tar' when descriptor.storage_kind = 'tar_shard' then 'heavy_tar' else descriptor.storage_kind end"


@query(
    f"""select manifest_pos, {CLASS} as storage_class, {NCOUNT} as frame_count, case
when {NCOUNT} <= 0 then 'empty_frames' when descriptor.storage_kind = 'tar_shard' and coalesce(descriptor.shard_path, '') = '' then 'missing_shard_path'
when descriptor.storage_kind = 'tar_shard' and len(descriptor.frame_offsets) <> {NCOUNT} then 'offset_count' when descriptor.storage_kind = 'tar_shard' and len(descriptor.frame_names) > 0 and len(descriptor.frame_names) <> {NCOUNT} then 'name_count'
when {CLASS} = 'light_tar' and descriptor.extra['frame_ext'] is null then 'missing_frame_ext' when {CLASS} = 'light_tar' and descriptor.extra['frame_start_idx'] is null then 'missing_frame_start_idx'
when {CLASS} = 'light_tar' and descriptor.extra['frame_index_width'] is null then 'missing_frame_index_width' when {CLASS} = 'light_tar' and coalesce(try_cast(descriptor.extra['frame_index_width'] as int), 0) < 1 then 'bad_frame_index_width'
when descriptor.storage_kind = 'image_sequence' and coalesce(descriptor.frame_dir, '') = '' then 'missing_frame_dir' when descriptor.storage_kind = 'image_sequence' and len(descriptor.frame_names) is distinct from {NCOUNT} then 'name_count'
when coalesce(descriptor.storage_kind not in ('tar_shard', 'image_sequence'), true) then 'unsupported_storage' end as error from clips"""
)
def storage_class(s, d):
    x = F.col("descriptor")
    return load(s, d, "clips").select("manifest_pos", manifest.storage_class(x).alias("storage_class"), manifest.frame_count(x).alias("frame_count"), manifest.descriptor_error(x).alias("error"))


@query(
    f"""with l as (select manifest_pos, descriptor.clip_id as c, {NCOUNT} as n, coalesce(try_cast(descriptor.extra['frame_start_idx'] as int), 0) as st, coalesce(try_cast(descriptor.extra['frame_index_width'] as int), 6) as w,
'.' || lower(ltrim(coalesce(descriptor.extra['frame_ext'], 'jpg'), '.')) as ext from clips where {CLASS} = 'light_tar' and {NCOUNT} > 0)
select manifest_pos, n as names, c || '_f' || lpad(st::varchar, greatest(w, len(st::varchar))::int, '0') || ext as first_name, c || '_f' || lpad((st + n - 1)::varchar, greatest(w, len((st + n - 1)::varchar))::int, '0') || ext as last_name from l"""
)
def inferred_frame_names(s, d):
    x = F.col("descriptor")
    c = load(s, d, "clips").where((manifest.storage_class(x) == "light_tar") & (manifest.frame_count(x) > 0)).select("manifest_pos", manifest.with_frame_names(x).alias("n"))
    return c.select("manifest_pos", F.size("n").alias("names"), F.get("n", F.lit(0)).alias("first_name"), F.element_at("n", -1).alias("last_name"))


@query(
    f"""with {FRM}, p as (select *, lower(regexp_extract(name, '\\.([A-Za-z]+)$', 1)) as ext, len(regexp_extract(name, '_[fF]([0-9]+)\\.[A-Za-z]+$', 1)) as w from frm),
g as (select clip, count(distinct shard) as k, min(shard) as shard, count(*) as n, min(frame) as a, max(frame) as z, max(w) as w, count(distinct ext) as x, min(ext) as ext, count(distinct frame) as u from p group by clip)
select clip as clip_id, shard, n as frame_count, a as frame_start_idx, w as frame_index_width, '.' || ext as frame_ext, case when x > 1 then 'mixed_extensions' when z - a + 1 <> n then 'not_contiguous' when u <> n then 'repeated_frame' end as error from g where k = 1"""
)
def clip_index(s, d):
    return manifest.clip_index(members(s, d)).drop("frame_offsets")


@query(f"with {FRM} select clip as clip_id, count(distinct shard) as shards from frm group by clip having count(distinct shard) > 1")
def cross_shard_clips(s, d):
    m = parsed(s, d)
    return m.groupBy(F.col("clip").alias("clip_id")).agg(F.countDistinct("shard").alias("shards")).where("shards > 1")


@query(
    f"""with {FRM}, u as (select distinct clip, frame from frm), g as (select *, frame - row_number() over (partition by clip order by frame) as k from u)
select clip, min(frame) as start_frame, max(frame) as end_frame, count(*) as frames, lpad((dense_rank() over (partition by clip order by k) - 1)::varchar, 3, '0') as part_id from g group by clip, k"""
)
def contiguous_segments(s, d):
    u = parsed(s, d).select("clip", "frame").distinct()
    g = windows.contiguous_segments(u, ["clip"], "frame")
    return g.groupBy("clip", "part_id").agg(F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"), F.count("*").alias("frames"))


@query(r"select manifest_pos, cast(regexp_extract(descriptor.root_dir, 'factory_?([0-9]+)', 1) as int) as factory from clips where try_cast(nullif(regexp_extract(descriptor.root_dir, 'factory_?([0-9]+)', 1), '') as int) between 100 and 2000")
def factory_range(s, d):
    return manifest.factory_range(load(s, d, "clips").select("manifest_pos", F.col("descriptor.root_dir").alias("root")), "root", 100, 2000).select("manifest_pos", "factory")


@query("select g.x as clip from (select unnest(generate_series(0, (select max(user_id) from events) + 100)) as x) g where g.x not in (select distinct user_id from events)")
def missing_groups(s, d):
    e = load(s, d, "events").select(F.col("user_id").alias("clip"))
    return manifest.missing_groups(e, "clip", 0, (e.agg(F.max("clip")).first()[0] or 0) + 100)


@query(f"with {EV} select clip, count(*) as n, (count(distinct f) = count(*) and min(f) = 0 and max(f) = count(*) - 1) as dense from ev where event_type <> 'error' group by clip")
def dense_frames(s, d):
    return manifest.dense_frames(frames(s, d).where("event_type <> 'error'"), "clip", "f")


@query("select adapter, count(*) as records from clips join sources using (source_id) group by adapter")
def lookup_join(s, d):
    c = load(s, d, "clips").select("source_id", "manifest_pos")
    return monitor.with_lookup(c, load(s, d, "sources").select("source_id", "adapter"), ["source_id"]).where("adapter is not null").groupBy("adapter").agg(F.count("*").alias("records"))


@query(f"select {CLASS} as kind, count(*) as clips from clips group by 1")
def prepare_summary(s, d):
    return load(s, d, "clips").groupBy(manifest.storage_class(F.col("descriptor")).alias("kind")).agg(F.count("*").alias("clips"))


# --- keys, names, text

_NP = r"regexp_extract({0}, '(?i)([^/]+)_f([0-9]+)\.(jpe?g|png)$', {1})"


@query(f"with {MEM} select shard, pos, {_NP.format('name', 1)} as clip, cast({_NP.format('name', 2)} as bigint) as frame, lower({_NP.format('name', 3)}) as ext from mem where {_NP.format('name', 1)} <> ''")
def frame_names(s, d):
    m = members(s, d).select("shard", F.col("pos").cast("bigint").alias("pos"), T.frame_name_parts(F.col("name")).alias("p"))
    return m.where("p is not null").select("shard", "pos", "p.*")


@query(
    r"""select doc_id, md5(coalesce(source, '')) as cache_key, substr(sha1(coalesce(source, '')), 1, 12) as scratch_key, coalesce(nullif(regexp_replace(regexp_replace(source, '[^A-Za-z0-9_.\-]+', '_', 'g'), '^[._\-]+|[._\-]+$', '', 'g'), ''), 'video') as slug,
case when n_chars is null then '-' when n_chars < 60 then n_chars || 's' when n_chars < 3600 then (n_chars // 60) || 'm' else (n_chars // 3600) || 'h' end as age from documents where source is not null and coalesce(n_chars, 0) >= 0"""
)
def keys_and_ages(s, d):
    x = load(s, d, "documents").where("source is not null and coalesce(n_chars, 0) >= 0")
    src = F.col("source")
    return x.select("doc_id", T.cache_key(src).alias("cache_key"), T.scratch_key(src).alias("scratch_key"), T.slug(src).alias("slug"), T.age(F.col("n_chars").cast("double")).alias("age"))


@query(r"select distinct tar_path, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(regexp_extract(tar_path, '([^/]*)$', 1), '(.)\.[^.]+$', '\1'), '[^\p{L}\p{N}\-_.]', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'clip') as stem, replace(regexp_replace(ltrim(tar_path, '/'), '([^/])\.[^./]+$', '\1'), '/', '__') as clip_id from tar_sources")
def stems_and_ids(s, d):
    p = load(s, d, "tar_sources").select("tar_path").distinct()
    return p.select("tar_path", T.safe_stem(F.col("tar_path")).alias("stem"), T.clip_id_of_path(F.ltrim("tar_path", F.lit("/"))).alias("clip_id"))


_LINES = "list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '^\\s*[0-9]+\\.\\s+', ''), chr(9) || chr(10) || chr(13) || ' '))"


@query(f"select doc_id, len(list_filter({_LINES}, lambda x: x <> '')) as instruction_num, substr(list_filter({_LINES}, lambda x: x <> '')[1], 1, 160) as preview from documents where text is not null")
def instruction_normalise(s, d):
    x = load(s, d, "documents").where("text is not null").select("doc_id", T.instructions(F.split("text", "\n"), F.create_map().cast("map<string,string>")).alias("i"))
    return x.select("doc_id", F.size("i").alias("instruction_num"), T.preview(F.col("i")).alias("preview"))


_SLOT = "string_split(coalesce(doc_type, ''), '_')"


@query(
    f"""with x as (select doc_id, {_SLOT} as slots, greatest(coalesce(reading, 0), 0) as n from (select *, cast(n_chars % 4 as int) as reading from documents)),
y as (select *, case when n > 0 then slots[1:n] else [] end as used from x), z as (select *, len(list_filter(used, lambda v: trim(v) <> '')) as k from y)
select doc_id, n, n <= 0 as missing, (n > 0 and k = 0) as empty, (n > 0 and (len(slots) < n or k <> least(n, len(used)))) as mismatch from z"""
)
def instruction_flags(s, d):
    x = load(s, d, "documents")
    f = T.instruction_flags(F.split(F.coalesce("doc_type", F.lit("")), "_"), F.col("n_chars") % 4)
    return x.select("doc_id", f.alias("f")).select("doc_id", "f.*")


_JT = r"trim(regexp_replace(regexp_replace(trim(text), '^```(json)?\s*', '', 'i'), '\s*```$', ''))"
_JL = ", ".join(f"nullif(trim(json_extract_string(j, '$.language_instructions.level{i}')), '')" for i in range(1, 6))


@query(
    rf"""with c as (select doc_id, {_JT} as t from documents where doc_type = 'raw_response' and text is not null),
j as (select doc_id, case when json_valid(t) then t::json when json_valid(regexp_extract(t, '(?s)\{{.*\}}')) then regexp_extract(t, '(?s)\{{.*\}}')::json end as j from c), k as (select doc_id, j, lower(trim(json_extract_string(j, '$.status'))) = 'invalid' as bad, list_filter([{_JL}], lambda x: x is not null) as ls from j)
select doc_id, case when coalesce(bad, false) then 'Invalid' else 'Valid' end as status, (not coalesce(bad, false) and coalesce(cast(json_extract(j, '$.is_good_quality') as boolean), false)) as is_good_quality,
case when coalesce(bad, false) then 0 else len(ls) end as instruction_num,
case when not coalesce(bad, false) then coalesce(nullif(trim(json_extract_string(j, '$.language_instructions.level5')), ''), nullif(trim(json_extract_string(j, '$.language_instructions.level2')), ''), ls[-1]) end as language from k"""
)
def model_answers(s, d):
    x = load(s, d, "documents").where("doc_type = 'raw_response' and text is not null").select("doc_id", T.annotation_payload(F.col("text")).alias("p"))
    return x.select("doc_id", "p.status", "p.is_good_quality", "p.instruction_num", "p.language")


@query(
    f"""with k as (select distinct clip_id from clips where clip_id is not null), s as (select clip_id || '.annotation.json' as path, min({_JT}) as body from documents where doc_type = 'raw_response' and clip_id is not null and text is not null group by 1),
c as (select clip_id, r, path from (select clip_id, 0 as r, clip_id || '.annotation.json' as path from k)), b as (select clip_id, arg_min(body, r) as body from c join s using (path) group by 1),
e as (select case when b.body is null then 'missing_annotation' when not json_valid(b.body) or json_type(case when json_valid(b.body) then b.body::json end) <> 'OBJECT' then 'invalid_json'
when coalesce(trim(json_extract_string(case when json_valid(b.body) then b.body::json end, '$.status')), 'Valid') <> 'Valid' then 'invalid_status' else 'empty_instruction' end as err from clips left join b using (clip_id))
select count(*) filter (err = 'missing_annotation') as missing_annotation, count(*) filter (err = 'invalid_json') as invalid_json, count(*) filter (err = 'invalid_status') as invalid_status, count(*) filter (err = 'empty_instruction') as empty_instruction, cast(0 as bigint) as other, count(*) as total from e"""
)
def annotation_issues(s, d):
    """The test answers hold levels under another key than sidecars do, so every valid one is an empty instruction."""
    docs = load(s, d, "documents").where("doc_type = 'raw_response' and clip_id is not null and text is not null").select(F.concat("clip_id", F.lit(".annotation.json")).alias("path"), T.json_text(F.col("text")).alias("body"))
    return annotation.issue_summary(annotation.with_annotations(load(s, d, "clips").select("clip_id", "manifest_pos"), docs))


@query("select doc_id from documents where contains(lower(concat_ws(' ', text, source)), 'tower') or contains(lower(concat_ws(' ', text, source)), 'towel')")
def text_search(s, d):
    x = load(s, d, "documents").select("doc_id", "text", "source")
    cols = [F.col("text"), F.col("source")]
    return annotation.search(x, cols, "tower").unionByName(annotation.search(x, cols, "Towel")).select("doc_id").distinct()


@query("select manifest_pos from clips where clip_id in (select clip_id from documents where clip_id is not null) and manifest_pos < 1000")
def allowlist_head(s, d):
    c = load(s, d, "clips").select("manifest_pos", "clip_id")
    return shards.head(monitor.produced(c, load(s, d, "documents").select("clip_id")), "manifest_pos", 1000).select("manifest_pos")


@query("select doc_type as code, count(*) as n from documents where doc_type is not null group by 1")
def status_histogram(s, d):
    return load(s, d, "documents").where("doc_type is not null").groupBy(F.col("doc_type").alias("code")).agg(F.count("*").alias("n"))


@query("select count(*) filter (event_type = 'view') as view, count(*) filter (event_type = 'error') as error, cast(0 as bigint) as unknown, count(*) as total from events")
def status_counts(s, d):
    return annotation.status_counts(load(s, d, "events"), "event_type", ["view", "error", "unknown"])


# --- metrics, fences, decisions

M4 = control_charts.STEP_METRICS


@query(f"with {EV}, s as (select *, abs(value - lag(value) over w) / greatest(1, f - lag(f) over w) as step from ev where event_type <> 'error' window w as (partition by clip order by f)) select clip, round(max(step), 6) as max_step, round(avg(step), 6) as mean_step, count(step) as steps from s group by clip")
def clip_step_metrics(s, d):
    w = Window.partitionBy("clip").orderBy("f")
    x = frames(s, d).where("event_type <> 'error'").withColumn("step", F.abs(F.col("value") - F.lag("value").over(w)) / F.greatest(F.lit(1), F.col("f") - F.lag("f").over(w)))
    return x.groupBy("clip").agg(F.round(F.max("step"), 6).alias("max_step"), F.round(F.avg("step"), 6).alias("mean_step"), F.count("step").alias("steps"))


@query(f"with {EV}, s as (select *, abs(value - lag(value) over w) as step, lag(f) over w as g from ev window w as (partition by clip order by f)) select clip, round(max(step), 6) as step, arg_max(g, (step, -f)) as from_frame, arg_max(f, (step, -f)) as to_frame from s where step is not null group by clip")
def largest_step(s, d):
    x = frames(s, d).withColumn("p", F.array("value"))
    return quality.largest_step(x, "clip", "f", "p").select("clip", F.round("step", 6).alias("step"), "from_frame", "to_frame")


def _fence_sql(m: str) -> str:
    x = FIN.format(m)
    return f"select '{m}' as metric, count({x}) as n, round(quantile_cont({x}, 0.25), 6) as q1, round(quantile_cont({x}, 0.75), 6) as q3, round(quantile_cont({x}, 0.75) + 2.5 * (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)), 6) as hi, max({x}) as max from clip_quality_stats"


@query(" union all ".join(_fence_sql(m) for m in M4))
def iqr_fences(s, d):
    r = quality.iqr_fences(load(s, d, "clip_quality_stats"), list(M4))
    return r.select("metric", "n", F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"), F.round("hi", 6).alias("hi"), "max")


@query(" union all ".join(f"select '{m}' as metric, count({FIN.format(m)}) as n, " + ", ".join(f"round(quantile_cont({FIN.format(m)}, {p}), 6) as p{round(p * 100)}" for p in (0.5, 0.9, 0.95, 0.99)) + f", max({FIN.format(m)}) as max from clip_quality_stats" for m in M4))
def metric_percentiles(s, d):
    r = quality.metric_percentiles(load(s, d, "clip_quality_stats"), list(M4))
    return r.select("metric", "n", *[F.round(f"p{p}", 6).alias(f"p{p}") for p in (50, 90, 95, 99)], "max")


CAPS = {"max_hand_translation_step": 0.3, "max_finger_translation_step": 0.3, "max_camera_translation_step": 0.2, "max_camera_rotation_step": 0.7, "max_wrist_rotation_step": 0.99, "min_presence_ratio": 0.5, "min_instruction_num": 1, "camera_space_auto_method": "percentile_abs"}


def _metrics(s: SparkSession, d: str) -> DataFrame:
    x = load(s, d, "clip_quality_stats")
    num = [*M4, "max_wrist_rotation_step", "max_camera_space_wrist_abs", "max_camera_space_hand_abs", "presence_ratio"]
    x = x.select("stat_id", "frames_kept_candidate", "nonfinite_lowdim_frames", "instruction_num_max", *[quality.finite(F.col(c)).alias(c) for c in num])
    return x.withColumns({f"mean_camera_{k}_step": F.col(f"max_camera_{k}_step") for k in ("translation", "rotation")})


def _decided(s: SparkSession, d: str) -> DataFrame:
    return quality.decide(_metrics(s, d), CAPS)


def _decision_sql() -> str:
    num = [*M4, "max_wrist_rotation_step", "max_camera_space_wrist_abs", "max_camera_space_hand_abs", "presence_ratio"]
    m = "m as (select stat_id, frames_kept_candidate, nonfinite_lowdim_frames, instruction_num_max, " + ", ".join(f"{FIN.format(c)} as {c}" for c in num) + " from clip_quality_stats)"
    q = lambda c, p: f"quantile_cont({c}, {p})"
    fence = lambda k: f"{q(f'max_camera_{k}_step', .25)} - 2.5 * ({q(f'max_camera_{k}_step', .75)} - {q(f'max_camera_{k}_step', .25)}) as {k}_lo, {q(f'max_camera_{k}_step', .75)} + 2.5 * ({q(f'max_camera_{k}_step', .75)} - {q(f'max_camera_{k}_step', .25)}) as {k}_hi"
    t = f"t as (select {fence('translation')}, {fence('rotation')}, {q('max_camera_space_wrist_abs', .99)} * 2.5 as wrist_abs, {q('max_camera_space_hand_abs', .99)} * 2.5 as hand_abs from m where frames_kept_candidate > 0)"
    rules = [("nonfinite_lowdim", "nonfinite_lowdim_frames > 0"), ("instruction_num_below_min", "instruction_num_max < 1"), ("presence_ratio_below_min", "presence_ratio < 0.5")]
    rules += [(f"{k}_step_exceeded", f"max_{k}_step > {CAPS[f'max_{k}_step']}") for k in ("hand_translation", "finger_translation", "camera_translation", "camera_rotation", "wrist_rotation")]
    rules += [(f"camera_space_{n}_abs_exceeded", f"max_camera_space_{n}_abs > {n}_abs") for n in ("wrist", "hand")]
    rules += [(f"episode_camera_{k}_iqr_exceeded", f"(max_camera_{k}_step < {k}_lo or max_camera_{k}_step > {k}_hi)") for k in ("translation", "rotation")]
    return f"{m}, {t}, r as (select stat_id, list_filter([" + ", ".join(f"case when {c} then '{n}' end" for n, c in rules) + "], lambda x: x is not null) as reasons from m cross join t)"


@query(f"with {_decision_sql()} select stat_id, len(reasons) = 0 as keep, array_to_string(reasons, ',') as reasons from r")
def quality_decision(s, d):
    return _decided(s, d).select("stat_id", "keep", F.array_join("reasons", ",").alias("reasons"))


@query(f"with {_decision_sql()} select reason, count(*) as clips from (select unnest(list_concat(['total', case when len(reasons) = 0 then 'kept' else 'dropped' end], reasons)) as reason from r) group by 1")
def drop_report(s, d):
    return quality.drop_report(_decided(s, d))


@query(f"with {EV}, x as (select *, cast(value > 40 as int) as c, cast(value <= 40 or event_type = 'error' as int) as z from ev), i as (select *, sum(z) over (partition by clip order by f) as k from x), n as (select clip, k, sum(case when z = 0 then c else 0 end) as n from i group by 1, 2) select clip, max(n) as streak from n group by clip")
def out_of_range_streak(s, d):
    return windows.longest_streak(frames(s, d), ["clip"], ["f"], F.col("value") > 40, (F.col("value") <= 40) | (F.col("event_type") == "error"))


@query(f"with {EV} select clip, event_type, round(median(value), 6) as z from ev group by 1, 2")
def group_medians(s, d):
    return frames(s, d).groupBy("clip", "event_type").agg(F.round(F.percentile("value", 0.5), 6).alias("z"))


@query(f"with {EV}, r as (select clip, median(value / 50) as m, count(*) as n from ev where event_type = 'view' and value > 0 group by clip) select clip, n as frames, round(case when n >= 8 then least(greatest(m, 0.5), 2.0) else 1.0 end, 6) as k, case when n < 8 then 'too_few_frames' end as reason from r")
def anchor_factor(s, d):
    x = frames(s, d).where("event_type = 'view' and value > 0").withColumn("r", F.col("value") / 50)
    return quality.hand_depth_anchor(x, "clip", "r").withColumn("k", F.round("k", 6))


# --- windows over frames

@query(
    f"""with {EV}, s as (select clip, f * 15 as idx, value < 60 as ok, value as score, row_number() over (partition by clip order by f) as r from ev), v as (select *, case when r - lag(r) over (partition by clip order by idx) - 1 < 3 then 0 else 1 end as new from s where ok),
g as (select *, sum(new) over (partition by clip order by idx) as i from v) select clip as video, min(idx) as start_frame, max(idx) + 15 as end_frame, round(avg(score), 6) as score from g group by clip, i having max(idx) + 15 - min(idx) >= 60"""
)
def valid_interval_merge(s, d):
    x = frames(s, d).select(F.col("clip").alias("video"), (F.col("f") * 15).alias("idx"), (F.col("value") < 60).alias("ok"), F.col("value").alias("score"))
    return windows.merged_gate_samples(x, "video", "idx", "ok", "score", 15, 60.0, 3).withColumn("score", F.round("score", 6))


@query(f"with {EV} select clip, f, min(value) over w as lo, max(value) over w as hi from ev window w as (partition by clip order by f range between 180 preceding and 30 following)")
def chunk_window_extremes(s, d):
    return windows.window_extremes(frames(s, d), "clip", "f", "value", 180, 30).select("clip", "f", "lo", "hi")


@query(f"with {EV} select clip, f, coalesce(lead(value) over (partition by clip order by f), 0) as action from ev")
def next_state_action(s, d):
    return windows.next_state(frames(s, d), "clip", ["f"], "value", F.lit(0.0)).select("clip", "f", "action")


@query(f"with {EV} select clip, count(*) - 1 as frames from ev group by clip having count(*) > 1")
def drop_last(s, d):
    return windows.next_state(frames(s, d), "clip", ["f"], "value", F.lit(0.0), drop_last=True).groupBy("clip").agg(F.count("*").alias("frames"))


@query(f"with {EV}, n as (select *, case when event_type is not distinct from lag(event_type) over (partition by clip order by f) and f > 0 then 0 else 1 end as new from ev) select clip, f, sum(new) over (partition by clip order by f) - 1 as run_id from n")
def episode_runs(s, d):
    return windows.episode_runs(frames(s, d), ["clip"], ["f"], "event_type").select("clip", "f", "run_id")


@query("select n_nationkey + 25 * r as episode_index, r as repeat_index, n_name from nation, (select unnest([0, 1, 2]) as r)")
def repeat_episodes(s, d):
    x = load(s, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("episode_index"), "n_name")
    return windows.repeated(x, ["episode_index"], 3)


@query(f"with {EV}, c as (select distinct clip, f // 20 as chunk, (f // 20) * 20 + 14.5 as centre from ev), o as (select ev.clip, ev.f, c.chunk, c.centre from ev join c on ev.clip = c.clip and c.chunk between ev.f // 20 - 1 and ev.f // 20) select clip, f, arg_min(chunk, (abs(f - centre), chunk)) as chunk from o group by clip, f")
def owner_chunk(s, d):
    x = frames(s, d).select("clip", "f", F.floor(F.col("f") / 20).alias("k"))
    c = x.select("clip", "k").distinct()
    o = x.select("clip", "f", F.explode(F.array(F.col("k") - 1, F.col("k"))).alias("chunk")).join(c.withColumnRenamed("k", "chunk"), ["clip", "chunk"]).withColumn("centre", F.col("chunk") * 20 + 14.5)
    return windows.owner_chunk(o, ["clip"], "f", "centre", "chunk").select("clip", "f", "chunk")


@query(f"with {EV} select clip, f, round(sum(case when value between 5 and 200 then ln(value / 50) else 0 end) over (partition by clip order by f), 6) as log_correction from ev")
def chained_correction(s, d):
    """As a logarithm, since a long product loses its decimals."""
    x = frames(s, d).withColumn("r", F.col("value") / 50)
    return windows.chained_correction(x, "clip", "f", "r", F.col("value").between(5, 200)).select("clip", "f", F.round(F.ln("correction"), 6).alias("log_correction"))


@query(f"with {EV} select clip, f, coalesce(max(case when event_type = 'view' then f end) over (partition by clip order by f), min(f) over (partition by clip)) as window_start from ev")
def fill_window_start(s, d):
    return windows.fill_window_start(frames(s, d), ["clip"], "f", F.col("event_type") == "view").select("clip", "f", "window_start")


@query("select l_returnflag, l_orderkey, l_linenumber, l_partkey from (select *, row_number() over (partition by l_returnflag order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as r from lineitem) where r <= 32")
def first_examples(s, d):
    x = windows.first_examples(load(s, d, "lineitem"), ["l_returnflag"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], 32)
    return x.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey")


@query("select user_id, arg_max(props, event_id) as props, min(event_id) as first_pos from events where event_type = 'error' group by user_id order by first_pos limit 5")
def latest_errors(s, d):
    return windows.latest_errors(load(s, d, "events").where("event_type = 'error'"), "user_id", "event_id", "props", 5)


@query(f"with n as (select manifest_pos, {NCOUNT} as n from clips), c as (select *, case when n > 0 then cast(greatest(ceil((n - 8) / 6.0), 0) as bigint) + 1 else 0 end as k from n) select manifest_pos, i - 1 as chunk, (i - 1) * 6 as start_frame, least((i - 1) * 6 + 8, n) as end_frame from (select *, unnest(generate_series(1, k)) as i from c)")
def overlapping_chunks(s, d):
    c = load(s, d, "clips").select("manifest_pos", windows.overlapping_chunks(manifest.frame_count(F.col("descriptor")), 8, 2).alias("c"))
    return c.select("manifest_pos", F.posexplode("c").alias("chunk", "x")).select("manifest_pos", F.col("chunk").cast("bigint").alias("chunk"), F.col("x.start").alias("start_frame"), F.col("x.end").alias("end_frame"))


@query(
    f"""with {EV}, g as (select clip, f, case when event_type <> 'error' then value end as x, count(*) over (partition by clip) as n from ev), k as (select clip, f, x from g where x is not null), c as (select clip, count(*) as m from k group by clip),
a as (select g.*, p.f as pf, p.x as px from g asof left join k p on g.clip = p.clip and g.f >= p.f), z as (select a.*, q.f as qf, q.x as qx from a asof left join k q on a.clip = q.clip and a.f <= q.f),
i as (select clip, f, x, n, case when px is null then qx when qx is null or qf = pf then px else px + (f - pf) / (qf - pf)::double * (qx - px) end as y from z), o as (select i.clip, i.f, d.d, least(greatest(i.f + d.d, 0), i.n - 1) as at from i, (select unnest([-2, -1, 0, 1, 2]) as d) d where i.x is null),
s as (select o.clip, o.f, avg(i.y) as y from o join i on i.clip = o.clip and i.f = o.at group by all) select i.clip, i.f, round(case when i.x is not null then i.x when coalesce(c.m, 0) < 2 then 0 else s.y end, 4) + 0.0 as x from i left join s on s.clip = i.clip and s.f = i.f left join c on c.clip = i.clip"""
)
def repaired_gaps(s, d):
    """Gaps at error events: interpolated in time, then smoothed over five frames with the ends repeated."""
    x = frames(s, d).withColumn("x", F.when(F.col("event_type") != "error", F.col("value")))
    return windows.repaired(x, ["clip"], "f", ["x"]).select("clip", "f", (F.round("x", 4) + 0.0).alias("x"))


# --- resampling and as-of joins

_GRID = "n as (select clip, count(*) as n from ev group by clip), g as (select clip, t, least(greatest(t * 5.0 / 12.0, 0), n - 1) as pos from (select clip, n, unnest(generate_series(0, cast(floor(n * 12.0 / 5.0) as bigint) - 1)) as t from n))"


def _grid(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    x = frames(s, d)
    n = x.groupBy("clip").agg(F.count("*").alias("n"))
    return x, resample.target_grid(n, "clip", F.col("n"), F.floor(F.col("n") * 12.0 / 5.0), F.lit(5.0), F.lit(12.0))


@query(f"with {EV}, {_GRID}, p as (select clip, f, value, lead(value) over (partition by clip order by f) as nv from ev) select g.clip, g.t, round(p.value + case when g.pos > floor(g.pos) then (g.pos - floor(g.pos)) * (nv - p.value) else 0 end, 4) as value from g join p on g.clip = p.clip and p.f = floor(g.pos)")
def resample_linear(s, d):
    x, g = _grid(s, d)
    return resample.resample_linear(x, g, "clip", "f", ["value"]).withColumn("value", F.round("value", 4))


@query(f"with {EV}, {_GRID} select g.clip, g.t, ev.value from g join ev on g.clip = ev.clip and ev.f = round_even(g.pos, 0)")
def resample_nearest(s, d):
    x, g = _grid(s, d)
    return resample.resample_nearest(x, g, "clip", "f", ["value"])


@query(
    f"""with {EV}, k as (select clip, f as t, value as x from ev where f % 7 = 3), b as (select e.clip, e.f as t, a.t as ta, a.x as xa from ev e asof left join k a on e.clip = a.clip and e.f >= a.t), c as (select b.*, z.t as tz, z.x as xz from b asof left join k z on b.clip = z.clip and b.t <= z.t)
select clip, t, round(case when xa is null then xz when xz is null or tz = ta then xa else xa + (t - ta) / (tz - ta)::double * (xz - xa) end, 4) as x from c"""
)
def asof_interpolate(s, d):
    x = frames(s, d)
    keys = x.where("f % 7 = 3").select("clip", F.col("f").alias("t"), F.col("value").alias("x"))
    return resample.between_keyframes(x.select("clip", F.col("f").alias("t")), keys, "clip", "t", ["x"]).withColumn("x", F.round("x", 4))


@query(f"with {EV}, n as (select clip, max(f) as last from ev group by clip), w as (select clip, f * 3 - 10 as f from ev) select w.clip, w.f, ev.value from w join n using (clip) join ev on ev.clip = w.clip and ev.f = least(greatest(w.f, 0), n.last)")
def clipped_lookup(s, d):
    x = frames(s, d)
    w = x.select("clip", (F.col("f") * 3 - 10).alias("f"))
    return resample.at_clipped_frame(w, x.select("clip", "f", "value"), "clip", "f").select("clip", "f", "value")


# --- plans of shards

def _orders(s: SparkSession, d: str) -> DataFrame:
    return load(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).withColumn("i", F.row_number().over(Window.orderBy("o_custkey")) - 1)


OC = "oc as (select o_custkey, count(*) as n, row_number() over (order by o_custkey) - 1 as i from orders group by o_custkey)"


@query(
    f"""with recursive {OC}, w as (select -1::bigint as i, 0::bigint as shard, 0::bigint as held, -1::bigint as num union all
select oc.i, case when p.held > 0 and p.held + oc.n > 60 then p.shard + 1 else p.shard end + case when (case when p.held > 0 and p.held + oc.n > 60 then 0 else p.held end) + oc.n >= 60 then 1 else 0 end,
case when (case when p.held > 0 and p.held + oc.n > 60 then 0 else p.held end) + oc.n >= 60 then 0 else (case when p.held > 0 and p.held + oc.n > 60 then 0 else p.held end) + oc.n end,
case when p.held > 0 and p.held + oc.n > 60 then p.shard + 1 else p.shard end from w p join oc on oc.i = p.i + 1)
select num as shard_idx, count(*) as episodes, sum(oc.n) as frames, min(i) as first_episode, max(i) as last_episode from w join oc using (i) group by num"""
)
def shard_plan(s, d):
    return shards.shard_summary(shards.shard_plan(_orders(s, d), "i", "n", 60), "i", "n")


@query(
    f"""with recursive {OC}, w as (select -1::bigint as i, 0::bigint as b, 0::bigint as k, 0::bigint as held, -1::bigint as num union all
select i, case when k2 + 1 >= 7 or h2 + n >= 80 then b2 + 1 else b2 end, case when k2 + 1 >= 7 or h2 + n >= 80 then 0 else k2 + 1 end, case when k2 + 1 >= 7 or h2 + n >= 80 then 0 else h2 + n end, b2 from
(select oc.i, oc.n, case when p.k > 0 and p.held + oc.n > 80 then p.b + 1 else p.b end as b2, case when p.k > 0 and p.held + oc.n > 80 then 0 else p.k end as k2, case when p.k > 0 and p.held + oc.n > 80 then 0 else p.held end as h2 from w p join oc on oc.i = p.i + 1))
select i, num as batch_idx from w where i >= 0"""
)
def precompute_batches(s, d):
    return shards.batches(_orders(s, d), "i", "n", 7, 80).select("i", "batch_idx")


@query(
    f"""with recursive {OC}, t as (select count(*) as c, sum(n) as tot from oc), w as (select -1::bigint as i, 0::bigint as shard, 0::bigint as held, -1::bigint as num union all
select oc.i, case when c - oc.i - 1 >= 12 - p.shard - 1 and (p.held + oc.n >= greatest(1.0, tot / 12.0) or c - oc.i - 1 = 12 - p.shard - 1) then p.shard + 1 else p.shard end,
case when c - oc.i - 1 >= 12 - p.shard - 1 and (p.held + oc.n >= greatest(1.0, tot / 12.0) or c - oc.i - 1 = 12 - p.shard - 1) then 0 else p.held + oc.n end, p.shard from w p join oc on oc.i = p.i + 1 cross join t)
select num as shard_id, min(i) as start, max(i) + 1 as "end", sum(n) as weight from w join oc using (i) group by num"""
)
def weighted_partition(s, d):
    return shards.weighted_partition(_orders(s, d), "i", "n", 12)


@query("select distinct tar_path from tar_sources where tar_path not in (select tar_path from tar_sources where tar_bytes > 50000)")
def pending_shards(s, d):
    t = load(s, d, "tar_sources")
    return shards.pending_shards(t.select("tar_path").distinct(), t.select("tar_path", F.when(F.col("tar_bytes") > 50000, 1).otherwise(0).alias("bytes")), "tar_path")


@query(f"with x as (select manifest_pos, coalesce(descriptor.shard_path, chr(0) || manifest_pos) as sh, {NCOUNT} as work from clips), y as (select *, sum(work) over (partition by sh) as sw from x) select manifest_pos, row_number() over (order by sw desc, sh, work desc, manifest_pos) - 1 as rank from y")
def locality_order(s, d):
    c = load(s, d, "clips").select("manifest_pos", F.col("descriptor.shard_path").alias("sh"), manifest.frame_count(F.col("descriptor")).alias("n"))
    return shards.locality_order(c, "manifest_pos", F.col("n"), "sh").select("manifest_pos", "rank")


@query(f"with n as (select manifest_pos, {NCOUNT} as n from clips) select manifest_pos, case when n <= 0 then '' when n <= 8 then array_to_string(generate_series(0, n - 1), ',') else array_to_string(list_transform(generate_series(0, 7), lambda i: cast(round_even(i * (n - 1) / 7.0, 0) as bigint)), ',') end as sampled from n")
def uniform_frames(s, d):
    c = load(s, d, "clips").select("manifest_pos", shards.uniform_indices(manifest.frame_count(F.col("descriptor")), 8).alias("u"))
    return c.select("manifest_pos", F.array_join(F.transform("u", lambda x: x.cast("string")), ",").alias("sampled"))


@query(f"select manifest_pos, row_number() over (order by manifest_pos) - 1 as episode_index from clips where {NCOUNT} > 20")
def episode_numbers(s, d):
    return shards.numbered(load(s, d, "clips").where(manifest.frame_count(F.col("descriptor")) > 20).select("manifest_pos"), "manifest_pos")


# --- run state

def _events(s: SparkSession, d: str) -> DataFrame:
    e = load(s, d, "events")
    kind = F.when(F.col("event_type") == "purchase", "stage_success").when(F.col("event_type") == "error", "stage_failure").otherwise(F.col("event_type"))
    return e.select(F.col("event_id").alias("pos"), F.lit(False).alias("malformed"), kind.alias("event"), F.col("user_id").cast("string").alias("video"), F.concat(F.lit("s"), F.col("event_id") % 4).alias("stage"), F.col("value").alias("wall_sec"), F.col("props").alias("error"), F.col("ts").cast("timestamp").alias("at"))


SE = "se as (select event_id as pos, case event_type when 'purchase' then 'stage_success' when 'error' then 'stage_failure' else event_type end as event, user_id::varchar as video, 's' || (event_id % 4) as stage, value as wall_sec, ts from events)"
ST = (
    SE
    + ", l as (select video, stage, arg_max(case event when 'stage_success' then 'completed' else 'failed' end, pos) as status, count(*) filter (event = 'stage_failure') as failures from se where event in ('stage_success', 'stage_failure') group by 1, 2), st as (select v.video, g.stage, coalesce(l.status, 'pending') as status, coalesce(l.failures, 0) as failures from (select distinct video from se) v cross join (select unnest(['s0', 's1', 's2', 's3', 's4']) as stage) g left join l using (video, stage))"
)


def _status(s: SparkSession, d: str) -> DataFrame:
    e = _events(s, d)
    return monitor.replayed(e, e.select("video").distinct(), ["s0", "s1", "s2", "s3", "s4"])


@query(f"with {ST} select video, stage, status, failures from st")
def event_replay(s, d):
    return _status(s, d).drop("error")


@query(f"with {ST} select video, case when bool_and(status = 'completed') then 'completed' when bool_or(status = 'failed') then 'failed' when bool_or(status = 'completed') then 'partial' else 'pending' end as state from st group by video")
def video_states(s, d):
    return monitor.video_states(_status(s, d))


@query(f"with {SE} select stage, count(*) filter (event = 'stage_success') as success, count(*) filter (event = 'stage_failure') as failure, min(wall_sec) as min_sec, round(avg(wall_sec), 4) as avg_sec, max(wall_sec) as max_sec from se where event in ('stage_success', 'stage_failure') group by stage")
def stage_stats(s, d):
    return monitor.stage_stats(_events(s, d)).withColumn("avg_sec", F.round("avg_sec", 4))


@query(f"with {SE} select event, count(*) as n from se group by event")
def event_counts(s, d):
    return monitor.event_counts(_events(s, d))


@query(f"with {ST} select a.video from st a join st b on a.video = b.video and b.stage = 's0' and b.status = 'completed' where a.stage = 's1' and a.status in ('pending', 'failed')")
def pending_work(s, d):
    return monitor.pending_work(_status(s, d), "s1", "s0")


@query(f"with {ST}, v as (select video, case when bool_and(status = 'completed') then 'completed' when bool_or(status = 'failed') then 'failed' when bool_or(status = 'completed') then 'partial' else 'pending' end as state from st group by video) select count(*) as total, count(*) filter (state = 'completed') as completed, count(*) filter (state = 'failed') as failed, count(*) filter (state = 'partial') as partial, count(*) filter (state = 'pending') as pending, cast(0 as bigint) as malformed, case when count(*) filter (state in ('completed', 'failed')) < count(*) then 'stalled' else 'failed' end as health from v")
def run_summary(s, d):
    e = _events(s, d)
    return monitor.run_summary(_status(s, d), e, F.to_timestamp(F.lit("2030-01-01 00:00:00"))).drop("last_event", "age_sec")


@query("select video, arg_max(start_frame, (end_frame, start_frame)) as start, max(end_frame) as \"end\" from clip_intervals where start_frame is not null and end_frame is not null group by video")
def newest_range(s, d):
    r = load(s, d, "clip_intervals").where("start_frame is not null and end_frame is not null").select("video", F.col("start_frame").alias("start"), F.col("end_frame").alias("end"))
    return monitor.newest_range(r, "video")


@query("with r as (select user_id::varchar as run, max(case when event_type = 'purchase' then ts end) as last_event from events group by 1) select run from r order by last_event desc nulls last, run limit 12")
def recent_runs(s, d):
    r = load(s, d, "events").groupBy(F.col("user_id").cast("string").alias("run")).agg(F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last_event"))
    return monitor.recent_runs(r).select("run")


@query(f"with {ST} select c.manifest_pos from clips c where c.manifest_pos::varchar in (select video from st where stage = 's2' and status = 'completed') or c.clip_id in (select video from st where stage = 's2' and status = 'completed')")
def completed_manifest(s, d):
    m = load(s, d, "clips").select("manifest_pos", "clip_id", F.col("manifest_pos").cast("string").alias("video_key"))
    return monitor.completed_manifest(m, _status(s, d), "s2").select("manifest_pos")


# --- sets

@query("select user_id, array_to_string(list_sort(list_filter(['view', 'purchase', 'refund'], lambda x: not list_contains(t, x))), ',') as missing, len(list_filter(['error', 'signup'], lambda x: list_contains(t, x))) as hard from (select user_id, coalesce(list(distinct event_type) filter (event_type is not null), []) as t from events group by user_id)")
def required_and_hard_sets(s, d):
    t = load(s, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("t"))
    lits = lambda *xs: F.array(*[F.lit(x) for x in xs])
    return t.select("user_id", F.array_join(F.array_sort(F.array_except(lits("view", "purchase", "refund"), "t")), ",").alias("missing"), F.size(F.array_intersect("t", lits("error", "signup"))).alias("hard"))


@query("select user_id, list_sort(list(distinct event_type) filter (event_id % 2 = 0)) = list_sort(list(distinct event_type) filter (event_id % 2 = 1)) as equal from events group by user_id")
def set_equality(s, d):
    e = load(s, d, "events")
    half = lambda k: F.array_sort(F.collect_set(F.when(F.col("event_id") % 2 == k, F.col("event_type"))))
    return e.groupBy("user_id").agg((half(0) == half(1)).alias("equal"))


# --- vectors

@query("with v as (select vec_id, unnest(embedding)::double as x, unnest(generate_series(0, len(embedding) - 1)) as dim from embeddings) select dim, count(x) as n, min(x) as min, max(x) as max, round(avg(x), 6) as mean, round(quantile_cont(x, 0.01), 6) as q01, round(quantile_cont(x, 0.99), 6) as q99 from v group by dim")
def dimension_stats(s, d):
    r = reports.dimension_stats(load(s, d, "embeddings"), "embedding")
    return r.select("dim", "n", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "q01", "q99")])


@query("with v as (select vec_id, unnest(embedding)::double as x, unnest(generate_series(0, len(embedding) - 1)) as dim from embeddings), j as (select a.dim, abs(a.x - b.x) as d from v a join v b on a.dim = b.dim and b.vec_id = a.vec_id + 1) select dim, round(max(d), 6) as max_diff, round(avg(d), 6) as mean_diff from j group by dim order by max(d) desc, dim desc limit 10")
def largest_differences(s, d):
    e = load(s, d, "embeddings").select("vec_id", "embedding")
    r = reports.largest_differences(e, e.withColumn("vec_id", F.col("vec_id") - 1), "vec_id", "embedding")
    return r.select("dim", F.round("max_diff", 6).alias("max_diff"), F.round("mean_diff", 6).alias("mean_diff"))


_E = "list_transform(embedding, lambda x: x::double)"


@query(f"select vec_id, round(sqrt(list_sum(list_transform({_E}, lambda x: x * x))), 5) as norm, list_bool_and(list_transform(embedding, lambda x: isfinite(x))) as finite from embeddings")
def vector_norms(s, d):
    v = F.col("embedding")
    return load(s, d, "embeddings").select("vec_id", F.round(G.norm(v), 5).alias("norm"), G.is_finite(v).alias("finite"))


_N3 = "sqrt({0}[{1}]^2 + {0}[{2}]^2 + {0}[{3}]^2)"


@query(
    f"""with e as (select vec_id, {_E} as v from embeddings), a as (select vec_id, v, {_N3.format('v', 1, 2, 3)} + 1e-8 as n from e), b as (select vec_id, v, [v[1] / n, v[2] / n, v[3] / n] as b1 from a), c as (select *, b1[1] * v[4] + b1[2] * v[5] + b1[3] * v[6] as k from b),
g as (select vec_id, b1, [v[4] - k * b1[1], v[5] - k * b1[2], v[6] - k * b1[3]] as a2 from c), h as (select vec_id, b1, a2, {_N3.format('a2', 1, 2, 3)} + 1e-8 as m from g)
select vec_id, round(b1[1], 5) as m00, round(a2[1] / m, 5) as m01, round(b1[2] * a2[3] / m - b1[3] * a2[2] / m, 5) as m02, round(b1[3], 5) as m20, round(b1[1] * a2[2] / m - b1[2] * a2[1] / m, 5) as m22 from h"""
)
def rot6d_matrices(s, d):
    m = load(s, d, "embeddings").select("vec_id", G.rot6d_to_matrix(F.slice("embedding", 1, 6)).alias("m"))
    return m.select("vec_id", *[F.round(F.col("m")[i], 5).alias(n) for n, i in (("m00", 0), ("m01", 1), ("m02", 2), ("m20", 6), ("m22", 8))])


@query(f"with e as (select vec_id, {_E} as v from embeddings) select vec_id, v[3] > 1e-6 as seen, case when v[3] > 1e-6 then round(100 * v[1] / v[3] + 50, 3) end as u, case when v[3] > 1e-6 then round(100 * v[2] / v[3] + 50, 3) end as v from e")
def project_points(s, d):
    k, m = F.array(*[F.lit(float(x)) for x in (100, 100, 50, 50)]), F.array(*[F.lit(float(x)) for x in (1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1)])
    p = load(s, d, "embeddings").select("vec_id", G.project(F.slice("embedding", 1, 3), m, k).alias("p"))
    return p.select("vec_id", F.col("p").isNotNull().alias("seen"), F.round("p.u", 3).alias("u"), F.round("p.v", 3).alias("v"))


@query("select event_id, cast(least(round_even((value::float * 0.01::float)::float * 1000::float, 0), 65535) as int) as mm from events where value > 0")
def depth_millimetres(s, d):
    x = load(s, d, "events").where("value > 0")
    return x.select("event_id", G.to_millimetres((F.col("value").cast("float") * F.lit(0.01).cast("float")).cast("float")).alias("mm"))


# --- operators without SQL: checked against NumPy or a second way in the tests

@query()
def smooth_scale(s, d):
    x = frames(s, d).withColumn("b", F.col("value") * 1.5 + F.col("f") % 3).withColumn("ok", F.col("event_type") != "error")
    return solvers.smooth_scale(x, ["clip"], "f", "value", "b", "ok")


@query()
def box_repair(s, d):
    x = frames(s, d)
    b = x.select("clip", "f", *[F.when(F.col("event_type") == "error", 0.0).otherwise(e).alias(n) for n, e in (("x1", F.col("f") * 1.0), ("y1", F.col("f") * 1.0), ("x2", F.col("f") + F.col("value")), ("y2", F.col("f") + F.col("value")), ("conf", (F.col("event_id") % 10) / 10.0))])
    return solvers.filled_boxes(b, ["clip"], "f")


# --- further modules of queries

from framewright.plans import frame_queries, source_queries  # noqa: E402

for _m in (frame_queries, source_queries):
    QUERIES.update(_m.QUERIES)
    ORACLES.update(_m.ORACLES)
