"""Curation runs as DataFrame plans: stages, adapters, hooks for models, and the filter and build paths end to end."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions import geometry as G
from framewright.operators import annotation, quality, shards
from framewright.session import checkpointed, guarded_join

#: Stages in their order, and names that stand for several.
STAGES = ("clip", "preflight", "prepare", "annotate", "detect_track", "motion", "slam", "infiller", "filter", "build", "validate")
GROUPS = {"all": STAGES, "infer": ("detect_track", "motion", "slam", "infiller"), "quality": ("filter", "build", "validate")}
NEURAL = GROUPS["infer"]


@dataclass
class RunConfig:
    """Settings of a run; ``from_mapping`` fills in defaults and refuses unknown names."""

    source_fps: float = 5.0
    target_fps: float = 30.0
    frames_per_shard: int = 10_000
    annotation_suffix: str = ".annotation.json"
    require_annotation: bool = False
    resume: bool = True
    criteria: dict = field(default_factory=dict)

    @classmethod
    def from_mapping(cls, *layers: dict) -> RunConfig:
        merged: dict = {}
        for layer in layers:
            merged = deep_merge(merged, layer)
        unknown = set(merged) - set(cls.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return cls(**merged)


def deep_merge(base: dict, over: dict) -> dict:
    """``over`` wins; dictionaries under the same key are merged likewise."""
    out = dict(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def selected_stages(text: str, native_features: bool = False) -> list[str]:
    """Stages of a comma-separated list, group names expanded, in order and once; clips with native features need no model stage."""
    want: set[str] = set()
    for name in (x.strip().lower() for x in text.split(",")):
        if name in GROUPS:
            want |= set(GROUPS[name])
        elif name in STAGES:
            want.add(name)
        elif name:
            raise ValueError(f"unknown stage {name}")
    return [s for s in STAGES if s in want and not (native_features and s in NEURAL)]


def preflight(tables: dict[str, DataFrame], required: dict[str, list[str]]) -> list[str]:
    """What is missing before a run: tables, and columns of tables."""
    out = [f"missing table {t}" for t in required if t not in tables]
    return out + [f"missing column {t}.{c}" for t, cols in required.items() if t in tables for c in cols if c not in tables[t].columns]


class Adapters:
    """Registry of sources: a name and a function (session, settings) -> descriptors (``clip_id, descriptor``)."""

    def __init__(self) -> None:
        self._by: dict[str, Callable[[SparkSession, dict], DataFrame]] = {}

    def register(self, name: str):
        def add(f):
            self._by[name] = f
            return f

        return add

    def descriptors(self, name: str, spark: SparkSession, settings: dict) -> DataFrame:
        if name not in self._by:
            raise KeyError(f"no adapter {name}; there are {sorted(self._by)}")
        return self._by[name](spark, settings)


def with_model(df: DataFrame, schema: str, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], by: list[str] | None = None) -> DataFrame:
    """Rows through an injected model: ``load`` runs once per task, its result once per batch, or once per group with ``by``."""
    if by:

        def group(p: pd.DataFrame) -> pd.DataFrame:
            return load()(p)

        return df.groupBy(*by).applyInPandas(group, schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for p in batches:
            yield model(p)

    return df.mapInPandas(run, schema)


def with_answers(df: DataFrame, prompt: str, call: Callable[[str], str], tries: int = 3, wait: float = 1.0) -> DataFrame:
    """``answer, error`` of a remote model per row; a failed call is tried again after growing pauses, then kept as an error."""
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for p in batches:
            got, err = [], []
            for x in p[prompt]:
                for k in range(tries):
                    try:
                        a, e = call(x), None
                        break
                    except Exception as problem:
                        a, e = None, str(problem)
                        if k + 1 < tries:
                            time.sleep(wait * 2**k)
                got.append(a)
                err.append(e)
            yield p.assign(answer=got, error=err)

    return df.mapInPandas(run, ", ".join(f"`{c}` {k}" for c, k in kinds.items()) + ", answer string, error string")


def filter_clips(manifest: DataFrame, frames: DataFrame, criteria: dict | None = None, past: int | None = 180, future: int = 30, build_issues: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(manifest with ``build_reasons, quality_reasons, reasons, drop_category`` and ``keep``, report) of the quality filter.

    Metrics are computed once and written; thresholds are one aggregate over them, then each clip is judged. ``build_issues`` (``clip_id, reason``) are
    what keeps clips from being built (a stage's output that is missing or invalid, no track range); a clip without frames has ``empty_frames``. A clip
    that can't be built is ``build_invalid`` and not judged further, one with quality reasons only is ``quality``.
    """
    metrics = checkpointed(quality.clip_metrics(frames, past, future))
    judged = quality.decide(metrics, criteria or {}).select("clip_id", F.col("reasons").alias("quality_reasons"))
    d = manifest.join(judged, "clip_id", "left")
    none = F.array().cast("array<string>")
    bad = F.when(F.col("quality_reasons").isNull(), F.array(F.lit("empty_frames"))).otherwise(none)
    if build_issues is not None:
        d = d.join(build_issues.groupBy("clip_id").agg(F.array_sort(F.collect_set("reason")).alias("__issues")), "clip_id", "left")
        bad = F.concat(F.coalesce("__issues", none), bad)
    d = d.withColumn("build_reasons", bad).drop("__issues")
    d = d.withColumn("quality_reasons", F.when(F.size("build_reasons") > 0, none).otherwise(F.coalesce("quality_reasons", none)))
    d = d.withColumn("reasons", F.concat("build_reasons", "quality_reasons")).withColumn("keep", F.size("reasons") == 0)
    d = d.withColumn("drop_category", F.when(F.size("build_reasons") > 0, "build_invalid").when(F.size("quality_reasons") > 0, "quality"))
    return d, quality.drop_report(d)


def category_report(filtered: DataFrame) -> DataFrame:
    """``category, reason, clips``: clips per reason within ``build_invalid`` and ``quality``; of null reason the clips of each category and ``kept``."""
    c = F.coalesce("drop_category", F.lit("kept"))
    d = filtered.select(c.alias("category"), F.explode(F.concat(F.array(F.lit(None).cast("string")), F.array_distinct("reasons"))).alias("reason"))
    return d.groupBy("category", "reason").agg(F.count("*").alias("clips"))


def prepared_episodes(manifest: DataFrame, sidecars: DataFrame, frames_col: str, config: RunConfig, limit: int | None = None) -> DataFrame:
    """Episodes with annotations, frames that have an action, their numbers in manifest order, and their shards."""
    m = annotation.with_annotations(shards.head(manifest, "manifest_pos", limit), sidecars, suffix=config.annotation_suffix)
    e = annotation.annotated(m, config.require_annotation).withColumn("export_frames", F.greatest(F.col(frames_col) - 1, F.lit(0)))
    return shards.shard_plan(shards.numbered(e, "manifest_pos"), "episode_index", "export_frames", config.frames_per_shard)


def prepare_stats(prepared: DataFrame) -> DataFrame:
    """``code, clips``: clips by annotation error, ``kept`` for those without."""
    return prepared.groupBy(F.coalesce("annotation_error", F.lit("kept")).alias("code")).agg(F.count("*").alias("clips"))


# --- gates and encodings that need no model


def detection_gate(boxes: DataFrame, key: list[str], width: float, height: float, roi: tuple = (0.0, 0.0, 1.0, 1.0), least_conf: float = 0.3, area: tuple = (0.02, 0.5), hands: int = 2) -> DataFrame:
    """``key, valid, score``: enough boxes of confidence and size that touch the region; the score is their mean confidence."""
    part = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) / (width * height)
    touch = (F.col("x1") < roi[2] * width) & (F.col("x2") > roi[0] * width) & (F.col("y1") < roi[3] * height) & (F.col("y2") > roi[1] * height)
    ok = (F.col("conf") >= least_conf) & part.between(*area) & touch
    return boxes.groupBy(*key).agg((F.count_if(ok) >= hands).alias("valid"), F.coalesce(F.avg(F.when(ok, F.col("conf"))), F.lit(0.0)).alias("score"))


def motion_gate(motion: Column, inliers: Column, width: Column, height: Column, most: float = 0.05, least_inliers: float = 0.3) -> Column:
    """The camera moved little for the image's size and the motion was fitted well; a first frame, without signals, fails."""
    return F.coalesce((motion <= most * F.greatest(width, height)) & (inliers >= least_inliers), F.lit(False))


def to_components(pose: Column, mean: list[float], basis: list[list[float]]) -> Column:
    """Pose minus mean in the components whose rows are ``basis``, by its pseudo-inverse."""
    inv = np.linalg.pinv(np.asarray(basis, float))  # pose length x components
    d = G.subtract(pose, F.array(*[F.lit(float(x)) for x in mean]))
    return G.let(d, lambda v: F.array(*[G.dot(v, F.array(*[F.lit(float(x)) for x in col])) for col in inv.T]))


def from_components(coef: Column, mean: list[float], basis: list[list[float]]) -> Column:
    b = np.asarray(basis, float)
    return G.let(coef, lambda c: F.array(*[F.lit(float(m)) + G.dot(c, F.array(*[F.lit(float(x)) for x in col])) for m, col in zip(mean, b.T)]))


def hand_parameters(flat: Column) -> Column:
    """Struct ``pose`` (45) and ``shape`` (10) of each hand of a flat 2 x 55 array."""
    one = lambda k: F.struct(F.slice(flat, k * 55 + 1, 45).alias("pose"), F.slice(flat, k * 55 + 46, 10).alias("shape"))
    return F.when(F.size(flat) == 110, F.struct(one(0).alias("left"), one(1).alias("right")))


def rigid(p: Column, m: Column, unit: float = 1.0) -> Column:
    """A point, scaled by ``unit`` (0.001 for millimetres), through a flat 4x4 matrix: sensor to camera, or camera to world."""
    return G.to_camera(G.scale(p, F.lit(float(unit))), m)


def native_depth_inputs(lowdim: Column) -> Column:
    """Struct ``k, cam2world`` of a frame vector for a depth model; null unless both camera parts are sane."""
    w2c, k = G.part(lowdim, "w2c"), G.part(lowdim, "intrinsic")

    def inverse(m: Column) -> Column:
        return G.let(G.camera_centre(m), lambda c: F.array(*[x for r in range(3) for x in (*[G.at(m, i * 4 + r) for i in range(3)], G.at(c, r))], *[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)]))

    return F.when(G.extrinsic_is_sane(w2c) & G.intrinsic_is_sane(k), F.struct(k.alias("k"), inverse(w2c).alias("cam2world")))


def keyframe_depths(keyframes: DataFrame, depths: DataFrame, key: list[str]) -> DataFrame:
    """Depth rows of key frames; a key frame without depth is an error."""
    d = keyframes.join(depths.withColumn("__have", F.lit(True)), key, "left")
    bad = F.raise_error(F.concat(F.lit("no depth for key frame "), F.to_json(F.struct(*key))))
    return d.where(F.when(F.col("__have"), True).otherwise(bad.cast("boolean"))).drop("__have")


def aligned_depths(depths: DataFrame, clip: str, index: str, expected: DataFrame) -> DataFrame:
    """Clips whose depth rows hold each of the first ``n_frames`` frames once: ``clip, ok``. Frames beyond those are ignored."""
    d = guarded_join(depths, expected.select(clip, "n_frames"), [clip], "inner").where(F.col(index) < F.col("n_frames"))
    g = d.groupBy(clip).agg(F.count("*").alias("n"), F.countDistinct(index).alias("d"), F.min(index).alias("lo"))
    return expected.join(g, clip, "left").select(clip, F.coalesce((F.col("n") == F.col("n_frames")) & (F.col("d") == F.col("n")) & (F.col("lo") == 0), F.lit(False)).alias("ok"))


def pose_arrays(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """World predictions of npz files as rows ``path, hand, frame, trans, rot, hand_pose, betas, valid``; unreadable files give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        for p in batches:
            for name, b in zip(p[path], p[content]):
                try:
                    z = np.load(io.BytesIO(bytes(b)), allow_pickle=False)
                    t, r, h, s, v = (np.asarray(z[f"pred_{k}"], float) for k in ("trans", "rot", "hand_pose", "betas", "valid"))
                except Exception:
                    continue
                yield pd.DataFrame([(name, k, i, t[k, i], r[k, i], h[k, i], s[k, i], float(v[k, i])) for k in range(t.shape[0]) for i in range(t.shape[1])], columns=["path", "hand", "frame", "trans", "rot", "hand_pose", "betas", "valid"])

    return files.select(path, content).mapInPandas(run, "path string, hand int, frame int, trans array<double>, rot array<double>, hand_pose array<double>, betas array<double>, valid double")


def merged_world(spine: DataFrame, left: DataFrame, right: DataFrame, clip: str, frame: str, cols: list[str]) -> DataFrame:
    """Hands 0 and 1 on every frame of ``spine``: the left one kept if it covers each frame of its clip, else zeros; zeros where the right is missing."""
    n = spine.groupBy(clip).agg(F.count("*").alias("__n"))
    whole = left.groupBy(clip).agg(F.countDistinct(frame).alias("__m")).join(n, clip).where("__m = __n").select(clip)
    out = None
    for hand, d in ((0, left.join(whole, clip, "left_semi")), (1, right)):
        x = spine.select(clip, frame).join(d.select(clip, frame, *cols), [clip, frame], "left").na.fill(0.0, cols).withColumn("hand", F.lit(hand))
        out = x if out is None else out.unionByName(x)
    return out


def depth_aligned_hands(joints: DataFrame, pixels: DataFrame, clip: str, frame: str, lam: float = 50.0, sigma: float = 0.1) -> DataFrame:
    """``clip, frame, alpha``: how far along the camera ray to move a hand so that its depth meets the depth map (1 where nothing could be fitted)."""
    from framewright.operators import solvers

    t = solvers.depth_targets(joints, pixels, clip, frame)
    s = solvers.smooth_scale(t, [clip], frame, "z", "d", "valid", lam, sigma)
    return s.select(clip, frame, F.when(F.col("applied"), F.col("alpha")).otherwise(1.0).alias("alpha"))
