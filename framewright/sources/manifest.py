"""Clip manifests and the indexes, listings and adapters they are made from."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.functions.text import clip_id_of_path, frame_name_parts, tar_frame_name

DESCRIPTOR = (
    "clip_id string, clip_name string, storage_kind string, root_dir string, seq_folder string, frame_names array<string>, frame_offsets array<array<bigint>>, "
    "shard_path string, frame_dir string, media_path string, fps double, width int, height int, frame_count_override int, extra map<string,string>"
)
#: Older names of descriptor fields.
OLD_NAMES = {"clip_id": "video_key", "clip_name": "video_name", "root_dir": "factory_dir"}


def _struct_ddl(cols: str) -> str:
    return ", ".join(": ".join(x.strip().split(" ", 1)) for x in _split_top(cols))


def _split_top(cols: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in cols:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    return [*out, cur]


def record_schema() -> str:
    old = "".join(f", {v}: string" for v in OLD_NAMES.values())
    return f"clip_id string, source_id string, split string, group_id string, descriptor struct<{_struct_ddl(DESCRIPTOR)}{old}>, metadata map<string,string>"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON-lines manifest with ``manifest_pos`` in file order (file by file in name order); blank lines are skipped.

    Older field names are accepted, and a missing group is named after the last part of the root folder. Positions are counted per
    file part and offset by the parts before, so no sort gathers the records.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__b"), F.monotonically_increasing_id().alias("__m"))
    d = raw.where(F.trim("value") != "").withColumn("r", F.from_json("value", record_schema()))
    part = Window.partitionBy("__f", "__b")
    d = d.withColumn("__i", F.row_number().over(part.orderBy("__m")))
    n = d.groupBy("__f", "__b").agg(F.count("*").alias("__n"))
    before = n.select("__f", "__b", (F.sum("__n").over(Window.orderBy("__f", "__b")) - F.col("__n")).alias("__o"))
    d = d.join(before, ["__f", "__b"])
    de = F.col("r.descriptor")
    for new, old in OLD_NAMES.items():
        de = de.withField(new, F.coalesce(F.col(f"r.descriptor.{new}"), F.col(f"r.descriptor.{old}")))
    de = de.dropFields(*OLD_NAMES.values())
    group = F.coalesce(F.when(F.col("r.group_id") != "", F.col("r.group_id")), F.regexp_extract(F.regexp_replace(de["root_dir"], "/+$", ""), r"([^/]+)$", 1))
    return d.select((F.col("__o") + F.col("__i") - 1).alias("manifest_pos"), F.coalesce("r.clip_id", de["clip_id"]).alias("clip_id"), "r.source_id", "r.split", group.alias("group_id"), de.alias("descriptor"), "r.metadata")


def storage_class(d: Column) -> Column:
    """``light_tar`` (a tar without names or offsets), ``heavy_tar``, ``image_sequence`` or the kind as it is."""
    light = (F.coalesce(F.size(d["frame_names"]), F.lit(0)) <= 0) & d["frame_offsets"].isNull()
    return F.when((d["storage_kind"] == "tar_shard") & light, "light_tar").when(d["storage_kind"] == "tar_shard", "heavy_tar").otherwise(d["storage_kind"])


def frame_count(d: Column) -> Column:
    return F.coalesce(d["frame_count_override"], F.when(F.size(d["frame_names"]) >= 0, F.size(d["frame_names"])), F.lit(0))


def descriptor_error(d: Column) -> Column:
    """First reason a descriptor's frames can't be read, or null."""
    n = frame_count(d)
    names, offs, ex = F.size(d["frame_names"]), F.size(d["frame_offsets"]), d["extra"]
    has = lambda k: F.coalesce(F.try_element_at(ex, F.lit(k)).isNotNull(), F.lit(False))
    tar = d["storage_kind"] == "tar_shard"
    light = tar & (storage_class(d) == "light_tar")
    none = lambda c: F.coalesce(c, F.lit("")) == ""
    rules = [
        (n <= 0, "empty_frames"), (tar & none(d["shard_path"]), "missing_shard_path"), (tar & d["frame_offsets"].isNotNull() & (offs != n), "offset_count"),
        (tar & (names > 0) & (names != n), "name_count"),
        *[(light & ~has(k), f"missing_{k}") for k in ("frame_ext", "frame_start_idx", "frame_index_width")],
        (light & (F.coalesce(F.try_element_at(ex, F.lit("frame_index_width")).try_cast("int"), F.lit(0)) < 1), "bad_frame_index_width"),
        ((d["storage_kind"] == "image_sequence") & none(d["frame_dir"]), "missing_frame_dir"), ((d["storage_kind"] == "image_sequence") & (names != n), "name_count"),
        (~F.coalesce(d["storage_kind"].isin("tar_shard", "image_sequence"), F.lit(False)), "unsupported_storage"),
    ]
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), n_) for c, n_ in rules])


def with_frame_names(d: Column) -> Column:
    """Names of a descriptor's frames; those of a light tar are inferred from start, width and extension."""
    num = lambda k, v: F.coalesce(F.try_element_at(d["extra"], F.lit(k)).try_cast("int"), F.lit(v))
    n = frame_count(d)
    made = F.transform(F.sequence(F.lit(0), n - 1), lambda i: tar_frame_name(d["clip_id"], num("frame_start_idx", 0), num("frame_index_width", 6), F.coalesce(F.try_element_at(d["extra"], F.lit("frame_ext")), F.lit("jpg")), i))
    return F.when(F.size(d["frame_names"]) > 0, d["frame_names"]).when(n > 0, made).otherwise(F.array().cast("array<string>"))


def clip_index(members: DataFrame) -> DataFrame:
    """One row per clip of ``shard, name, offset, size``: shard, count, start, width, extension, offsets in frame order, ``error``.

    Clips in several shards are left out; mixed extensions and missing or repeated frame numbers are errors.
    """
    p = frame_name_parts(F.col("name"))
    width = F.length(F.regexp_extract("name", r"_[fF](\d+)\.[A-Za-z]+$", 1))
    m = members.select("shard", "offset", "size", p.alias("p"), width.alias("w")).where("p is not null")
    g = m.groupBy(F.col("p.clip").alias("clip_id")).agg(
        F.countDistinct("shard").alias("shards"), F.min("shard").alias("shard"), F.count("*").alias("frame_count"), F.min("p.frame").alias("frame_start_idx"), F.max("p.frame").alias("last"),
        F.max("w").alias("frame_index_width"), F.collect_set("p.ext").alias("exts"), F.array_sort(F.collect_list(F.struct("p.frame", "offset", "size"))).alias("fs"),
    )
    err = F.when(F.size("exts") > 1, "mixed_extensions").when(F.col("last") - F.col("frame_start_idx") + 1 != F.col("frame_count"), "not_contiguous")
    err = F.coalesce(err, F.when(F.size(F.array_distinct(F.transform("fs", lambda x: x["frame"]))) != F.col("frame_count"), "repeated_frame"))
    return g.where("shards = 1").select("clip_id", "shard", "frame_count", "frame_start_idx", "frame_index_width", F.concat(F.lit("."), F.array_min("exts")).alias("frame_ext"), F.transform("fs", lambda x: F.array(x["offset"], x["size"])).alias("frame_offsets"), err.alias("error"))


def index_is_stale(index: DataFrame, shards: DataFrame) -> DataFrame:
    """Shards listed but not indexed (``added``), or indexed but gone (``removed``); empty if the index holds."""
    a, b = shards.select("shard").distinct(), index.select("shard").distinct()
    return a.join(b, "shard", "left_anti").withColumn("change", F.lit("added")).unionByName(b.join(a, "shard", "left_anti").withColumn("change", F.lit("removed")))


def load_or_build_index(spark: SparkSession, path: str, members: Callable[[], DataFrame], shards: DataFrame) -> DataFrame:
    """The index stored at ``path`` if it was made of just these ``shards``; else it is built from ``members()`` and stored.

    The listing it was made of is stored beside it, since shards without a clip of their own leave no row in the index.
    """
    listing_path = f"{path.rstrip('/')}.shards"
    try:
        if index_is_stale(spark.read.parquet(listing_path), shards).isEmpty():
            return spark.read.parquet(path)
    except AnalysisException:  # nothing stored yet
        pass
    clip_index(members()).write.mode("overwrite").parquet(path)
    shards.select("shard").distinct().write.mode("overwrite").parquet(listing_path)  # last: an interrupted build stays stale
    return spark.read.parquet(path)


def offsets_of(index: DataFrame, clips: DataFrame) -> DataFrame:
    return clips.select("clip_id").distinct().join(index.select("clip_id", "frame_offsets"), "clip_id")


def descriptors(index: DataFrame, root: Column, fps: float | None = None) -> DataFrame:
    """Descriptors of indexed clips without error, as light tars with offsets kept apart."""
    ex = F.map_from_arrays(F.array(F.lit("frame_ext"), F.lit("frame_start_idx"), F.lit("frame_index_width")), F.array("frame_ext", F.col("frame_start_idx").cast("string"), F.col("frame_index_width").cast("string")))
    none = lambda t: F.lit(None).cast(t)
    f = [
        F.col("clip_id"), F.col("clip_id").alias("clip_name"), F.lit("tar_shard").alias("storage_kind"), root.alias("root_dir"), none("string").alias("seq_folder"), F.array().cast("array<string>").alias("frame_names"),
        none("array<array<bigint>>").alias("frame_offsets"), F.concat_ws("/", root, "shard").alias("shard_path"), none("string").alias("frame_dir"), none("string").alias("media_path"), F.lit(fps).cast("double").alias("fps"),
        none("int").alias("width"), none("int").alias("height"), F.col("frame_count").cast("int").alias("frame_count_override"), ex.alias("extra"),
    ]
    return index.where("error is null").select("clip_id", F.struct(*f).alias("descriptor"))


def records(desc: DataFrame, source_id: str, split: str) -> DataFrame:
    """Manifest records of descriptors; the group is the last part of the root folder."""
    group = F.regexp_extract(F.regexp_replace("descriptor.root_dir", "/+$", ""), r"([^/]+)$", 1)
    return desc.select(F.col("descriptor.clip_id").alias("clip_id"), F.lit(source_id).alias("source_id"), F.lit(split).alias("split"), group.alias("group_id"), "descriptor", F.create_map().cast("map<string,string>").alias("metadata"))


def remapped(desc: DataFrame, root: str, existing: DataFrame) -> DataFrame:
    """Result folders moved under ``root``: the first candidate that exists (by clip, by group and clip, by name), else the first."""
    d, r = F.col("descriptor"), F.lit(root.rstrip("/"))
    group = F.regexp_extract(F.regexp_replace("descriptor.root_dir", "/+$", ""), r"([^/]+)$", 1)
    c = F.array(F.concat_ws("/", r, d["clip_id"]), F.concat_ws("/", r, group, d["clip_id"]), F.concat_ws("/", r, d["clip_name"]))
    k = desc.select("clip_id", F.posexplode(c).alias("rank", "path"))
    best = k.join(existing.select("path").distinct(), "path", "left_semi").groupBy("clip_id").agg(F.min_by("path", "rank").alias("p"))
    return desc.join(best, "clip_id", "left").withColumn("descriptor", d.withField("seq_folder", F.coalesce("p", c[0]))).drop("p")


def factory_range(df: DataFrame, folder: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Rows whose folder names a factory number in [start, end]; folders without number drop out if a bound is given."""
    n = F.regexp_extract(F.col(folder), r"factory_?(\d+)", 1).try_cast("int")
    d = df.withColumn("factory", n)
    d = d if start is None else d.where(F.col("factory") >= start)
    return d if end is None else d.where(F.col("factory") <= end)


def missing_groups(found: DataFrame, group: str, start: int, end: int) -> DataFrame:
    """Numbers in [start, end] of which there is no group."""
    want = found.sparkSession.range(start, end + 1).select(F.col("id").cast(dict(found.dtypes)[group]).alias(group))
    return want.join(found.select(group).distinct(), group, "left_anti")


def episode_segments(members: DataFrame, required: tuple = (".image.jpg", ".lowdim.npy"), split: bool = True) -> DataFrame:
    """Segments of successive frames of ``<prefix>ep<episode>_f<frame>`` samples, with ``error`` per episode.

    A sample that lacks a required suffix or a frame that comes twice is an error of its episode; so is a gap unless ``split``.
    Parts are numbered per episode: ``part_idx, part_count, clip_id``.
    """
    base = F.regexp_extract("name", r"([^/]*)$", 1)
    suf = F.coalesce(*[F.when(base.endswith(s), F.lit(s)) for s in required])
    m = members.select("shard", "offset", "size", base.alias("b"), suf.alias("suffix")).where("suffix is not null")
    m = m.withColumn("key", F.expr("substring(b, 1, length(b) - length(suffix))"))
    s = m.groupBy("shard", "key").agg(F.collect_set("suffix").alias("have"), F.count_if(F.col("suffix") == required[0]).alias("images"), F.min_by(F.array("offset", "size"), F.when(F.col("suffix") == required[0], F.col("offset"))).alias("at"))
    ep, fr = F.regexp_extract("key", r"_?ep(\d+)_f(\d+)$", 1).try_cast("int"), F.regexp_extract("key", r"_?ep(\d+)_f(\d+)$", 2).try_cast("bigint")
    s = s.select("shard", ep.alias("episode"), fr.alias("frame"), "at", "images", F.size(F.array_except(F.array(*[F.lit(x) for x in required]), "have")).alias("missing")).where("episode is not null and images > 0")
    w = Window.partitionBy("shard", "episode")
    s = s.withColumn("__r", F.row_number().over(w.orderBy("frame"))).withColumn("__g", F.col("frame") - F.col("__r")).withColumn("dup", (F.count("*").over(Window.partitionBy("shard", "episode", "frame")) > 1) | (F.col("images") > 1))
    s = s.withColumn("part_idx", F.dense_rank().over(w.orderBy("__g")) - 1)
    s = s.withColumn("part_count", F.max("part_idx").over(w) + 1)
    err = F.when(F.max("missing").over(w) > 0, "missing_payload").when(F.max("dup").over(w), "duplicate_frame")
    err = err if split else F.coalesce(err, F.when(F.col("part_count") > 1, "not_contiguous"))
    s = s.withColumn("error", err)
    name = F.when(F.col("part_count") > 1, F.format_string("ep%06d_part%03d", "episode", "part_idx")).otherwise(F.format_string("ep%06d", "episode"))
    return s.groupBy("shard", "episode", "part_idx", "part_count", "error").agg(F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"), F.count("*").alias("frames"), F.transform(F.array_sort(F.collect_list(F.struct("frame", "at"))), lambda x: x["at"]).alias("frame_offsets")).withColumn("clip_id", name)


def sequence_tars(members: DataFrame) -> DataFrame:
    """One clip per tar named ``[FPHA_]Subject_<n>_<action>_<trial>.tar``, with ``error``: bad name, no or missing frames, depth that doesn't match."""
    pat = r"(?:^|/)((?:FPHA_)?Subject_(\d+)_(.+)_(\d+))\.tar$"
    img, dep = F.regexp_extract("name", r"_f?(\d+)\.image\.jpg$", 1).try_cast("bigint"), F.regexp_extract("name", r"_f?(\d+)\.depth\.png$", 1).try_cast("bigint")
    g = members.groupBy("shard").agg(F.array_sort(F.collect_list(img)).alias("i"), F.array_sort(F.collect_set(dep)).alias("d"))
    ident = F.regexp_extract("shard", pat, 1)
    clip = F.when(ident.startswith("FPHA_"), ident).otherwise(F.concat(F.lit("FPHA_"), ident))
    n = F.size("i")
    whole = F.col("i") == F.sequence(F.get("i", F.lit(0)), F.get("i", F.lit(0)) + n - 1)
    err = F.when(ident == "", "bad_name").when(n == 0, "no_frames").when(~whole, "not_contiguous").when((F.size("d") > 0) & (F.col("d") != F.col("i")), "depth_mismatch")
    part = lambda k: F.regexp_extract("shard", pat, k)
    return g.select("shard", F.when(ident != "", clip).alias("clip_id"), part(2).alias("subject"), part(3).alias("action"), part(4).try_cast("int").alias("trial"), n.alias("frame_count"), F.size("d").alias("depth_frames"), err.alias("error"))


def listing(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``path, length, modified`` of files below a folder, without reading them."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    r = r.option("pathGlobFilter", pattern) if pattern else r
    return r.load(path).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", F.col("modificationTime").alias("modified"))


def image_sequences(files: DataFrame, include: list[str] | None = None) -> DataFrame:
    """One clip per folder of images: frame names sorted, ``clip_id`` the folder's name; ``include`` restricts the clips."""
    d = files.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("frame_dir"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name")).where(F.col("name").rlike(r"(?i)\.(jpe?g|png)$"))
    g = d.groupBy("frame_dir").agg(F.array_sort(F.collect_set("name")).alias("frame_names")).withColumn("clip_id", F.regexp_extract("frame_dir", r"([^/]+)$", 1))
    g = g.withColumn("frame_count", F.size("frame_names"))
    return g if include is None else g.where(F.col("clip_id").isin(include))


def video_folder(files: DataFrame, root: str) -> DataFrame:
    """One clip per video file below ``root``; its id joins the parts of the relative path."""
    rel = F.substring(F.col("path"), len(root.rstrip("/")) + 2, 1 << 20)
    return files.where(F.col("path").rlike(r"(?i)\.(mp4|mov|avi|mkv|webm)$")).select(clip_id_of_path(rel).alias("clip_id"), F.col("path").alias("media_path"))


def walked_tars(files: DataFrame) -> DataFrame:
    """Tar files by factory and worker folders of a directory walk."""
    pat = r"factory_?(\d+)/(?:worker_?(\d+)/)?([^/]+)\.tar$"
    return files.where(F.col("path").rlike(pat)).select("path", F.regexp_extract("path", pat, 1).try_cast("int").alias("factory"), F.regexp_extract("path", pat, 2).try_cast("int").alias("worker"), F.regexp_extract("path", pat, 3).alias("stem"))


def decoded_videos(videos: DataFrame, decode: Callable[[str], Iterator[tuple[int, bytes]]], path: str = "media_path", batch: int = 64) -> DataFrame:
    """Frames ``clip_id, frame_idx, data`` by an injected decoder (path -> frames), several videos a task, ``batch`` frames at a time."""
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = lambda rows: pd.DataFrame(rows, columns=["clip_id", "frame_idx", "data"])
        held: list[tuple] = []
        for p in batches:
            for c, m in zip(p["clip_id"], p[path]):
                for i, b in decode(m):
                    held.append((c, i, b))
                    if len(held) == batch:
                        yield table(held)
                        held = []
        if held:
            yield table(held)

    return videos.select("clip_id", path).mapInPandas(run, "clip_id string, frame_idx bigint, data binary")


def first_valid(candidates: DataFrame, key: str, rank: str, valid: Column) -> DataFrame:
    """Per key the valid candidate of the least rank."""
    cols = [c for c in candidates.columns if c != key]
    return candidates.where(valid).groupBy(key).agg(F.min_by(F.struct(*cols), rank).alias("r")).select(key, "r.*")


def dense_frames(df: DataFrame, clip: str, frame: str) -> DataFrame:
    """Per clip ``n`` and whether its frames are exactly 0 .. n-1."""
    g = df.groupBy(clip).agg(F.count("*").alias("n"), F.countDistinct(frame).alias("d"), F.min(frame).alias("lo"), F.max(frame).alias("hi"))
    return g.select(clip, "n", ((F.col("d") == F.col("n")) & (F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)).alias("dense"))


def completed_members(wanted: DataFrame, present: DataFrame, key: list[str]) -> DataFrame:
    """Wanted members that aren't present; must be empty before features are read."""
    return wanted.join(present.select(*key).distinct(), key, "left_anti")


def cached(cache: DataFrame, wanted: DataFrame, key: str, version: int, params: dict) -> DataFrame:
    """Wanted rows with their cached features, of this version and these parameters only; others get nulls."""
    ok = F.col("version") == version
    for k, v in params.items():
        ok = ok & F.col(k).eqNullSafe(F.lit(v))
    return wanted.join(cache.where(ok).drop("version", *params), key, "left")


def write_cache(features: DataFrame, path: str, version: int, params: dict) -> None:
    """Append features to a cache with the version and parameters they were made under, as ``cached`` reads them."""
    features.withColumns({"version": F.lit(version), **{k: F.lit(v) for k, v in params.items()}}).write.mode("append").parquet(path)


def camera_of_clip(poses: DataFrame, clips: DataFrame, default: tuple = (500.0, 500.0, 320.0, 240.0)) -> DataFrame:
    """``clip_id, mode, k``: ``direct`` if a clip has a pose per frame, ``interpolate`` if fewer, ``identity`` without any; default intrinsics then.

    ``clips`` has ``n_frames`` and intrinsics ``k`` (null if unknown), ``poses`` a row per pose.
    """
    n = poses.groupBy("clip_id").agg(F.count("*").alias("n"))
    d = clips.join(n, "clip_id", "left")
    mode = F.when(F.coalesce("n", F.lit(0)) == 0, "identity").when(F.col("n") == F.col("n_frames"), "direct").otherwise("interpolate")
    return d.select("clip_id", mode.alias("mode"), F.coalesce(F.when(mode != "identity", F.col("k")), F.array(*[F.lit(x) for x in default])).alias("k"))


#: Places in a skeleton line of the 21 joints in the order wrist, then each finger from its base to its tip.
SKELETON_ORDER = (0, 1, 6, 7, 8, 2, 9, 10, 11, 3, 12, 13, 14, 4, 15, 16, 17, 5, 18, 19, 20)


def skeleton_lines(lines: DataFrame, order: tuple[int, ...] = SKELETON_ORDER) -> DataFrame:
    """``frame_id, joints`` (array of 21 points, finger by finger) of text lines of 64 numbers; other lines are dropped."""
    n = F.transform(F.split(F.trim("value"), r"\s+"), lambda x: x.try_cast("double"))
    d = lines.select(*[c for c in lines.columns if c != "value"], n.alias("x")).where((F.size("x") == 64) & ~F.exists("x", lambda v: v.isNull()))
    return d.select(*[c for c in lines.columns if c != "value"], F.get("x", F.lit(0)).cast("bigint").alias("frame_id"), F.array(*[F.slice("x", 2 + 3 * j, 3) for j in order]).alias("joints"))


def aligned_rows(skeleton: DataFrame, clips: DataFrame, clip: str = "clip_id") -> DataFrame:
    """Skeleton rows on the frames 0 .. n-1 of each clip: by numbers from 1, from 0, or else by order; frames without row get nulls."""
    g = skeleton.groupBy(clip).agg(F.min("frame_id").alias("lo"), F.max("frame_id").alias("hi"), F.countDistinct("frame_id").alias("d"), F.count("*").alias("c"))
    j = skeleton.join(g, clip).join(clips.select(clip, "n_frames"), clip)
    r = F.row_number().over(Window.partitionBy(clip).orderBy("frame_id")) - 1
    one = (F.col("d") == F.col("c")) & (F.col("lo") >= 1) & (F.col("hi") <= F.col("n_frames"))
    zero = (F.col("d") == F.col("c")) & (F.col("lo") >= 0) & (F.col("hi") < F.col("n_frames"))
    j = j.withColumn("frame_idx", F.when(one, F.col("frame_id") - 1).when(zero, F.col("frame_id")).otherwise(r))
    spine = clips.where("n_frames > 0").select(clip, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_frames").cast("bigint") - 1)).alias("frame_idx"))
    return spine.join(j.select(clip, "frame_idx", "joints"), [clip, "frame_idx"], "left")


def batch_input(spark: SparkSession, manifest: str | None = None, names: list[str] | None = None, folder: str | None = None, start: int = 0, end: int | None = None) -> DataFrame:
    """``pos, clip_id`` from exactly one of a manifest, a list of names or a folder of videos, positions [start, end)."""
    if sum(x is not None for x in (manifest, names, folder)) != 1:
        raise ValueError("give one of manifest, names and folder")
    if manifest is not None:
        d = read_manifest(spark, manifest).select(F.col("manifest_pos").alias("pos"), "clip_id")
    elif names is not None:
        d = spark.createDataFrame(list(enumerate(names)), "pos bigint, clip_id string")
    else:
        d = video_folder(listing(spark, folder), folder).select((F.row_number().over(Window.orderBy("clip_id")) - 1).cast("bigint").alias("pos"), "clip_id")
    d = d.where(F.col("pos") >= start)
    return d if end is None else d.where(F.col("pos") < end)


def retained(files: DataFrame, level: str, path: str = "path") -> DataFrame:
    """Files with ``delete``: what a cleanup at ``level`` would remove (a dry run; nothing is deleted).

    ``all`` keeps everything, ``slam`` keeps results and camera files, ``none`` keeps the final result alone.
    """
    base = F.regexp_extract(path, r"([^/]+)$", 1)
    final, slam = base == "result.npz", F.col(path).rlike(r"/SLAM/") | base.rlike(r"(?i)slam|est_focal")
    keep = {"all": F.lit(True), "slam": final | slam, "none": final}
    if level not in keep:
        raise ValueError(f"unknown retention level {level}")
    return files.withColumn("delete", ~keep[level])
