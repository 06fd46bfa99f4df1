"""Reports over samples: per-dimension statistics, data-set sanity by episode, comparisons of two exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions import geometry as G
from framewright.functions.text import dimension_names, instruction_flags
from framewright.operators.quality import exact_percentiles
from framewright.operators.windows import episode_runs, first_examples

#: Issues that drop a sample; an image that can't be decoded is an issue only.
HARD = ("missing_image", "missing_lowdim", "missing_mano", "missing_meta", "invalid_meta", "invalid_lowdim", "nonfinite_lowdim", "invalid_rot6d", "invalid_extrinsic", "invalid_intrinsic", "missing_instruction", "empty_instruction", "instruction_num_mismatch")


def dimension_stats(df: DataFrame, vector: str, names: bool = False) -> DataFrame:
    """Per place of a vector: ``dim, n, min, max, mean, q01, q99`` (exact); with ``names`` the 116 names."""
    d = df.select(F.posexplode(vector).alias("dim", "x")).withColumn("x", F.col("x").cast("double"))
    q = exact_percentiles(d, ["x"], [0.01, 0.99], ["dim"]).select("dim", F.col("p")[0].alias("q01"), F.col("p")[1].alias("q99"))
    g = d.groupBy("dim").agg(F.count("x").alias("n"), F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"))
    g = g.join(q, "dim", "left").select("dim", "n", "min", "max", "mean", "q01", "q99")
    if not names:
        return g
    return g.withColumn("name", F.try_element_at(F.array(*[F.lit(n) for n in dimension_names()]), F.col("dim") + 1))


def largest_differences(a: DataFrame, b: DataFrame, pos: str, vector: str, top: int = 10) -> DataFrame:
    """Per place of two exports' vectors over their common positions: largest and mean absolute difference, the ``top`` largest."""
    x = a.select(pos, F.posexplode(vector).alias("dim", "x"))
    y = b.select(pos, F.posexplode(vector).alias("dim", "y"))
    d = x.join(y, [pos, "dim"]).withColumn("d", F.abs(F.col("x").cast("double") - F.col("y").cast("double")))
    return d.groupBy("dim").agg(F.max("d").alias("max_diff"), F.avg("d").alias("mean_diff")).orderBy(F.col("max_diff").desc(), F.col("dim").desc()).limit(top)


def sample_issues(samples: DataFrame) -> DataFrame:
    """Samples with ``issues``: missing fields, bad meta, instruction flags and numeric checks.

    ``samples`` has ``shard, pos, key, image, lowdim (array<double>), mano, meta`` (struct, null if missing or unreadable) and
    ``has_meta``. Numeric checks stop at the first kind that fails: size, finite, intrinsic, then rotation and extrinsic.
    """
    m, a = F.col("meta"), F.col("lowdim")
    f = instruction_flags(F.col("meta.instruction"), F.col("meta.instruction_num"))
    sized, fin = F.size(a) == G.LOWDIM_SIZE, G.is_finite(a)
    has_a = a.isNotNull()
    kk = G.intrinsic_is_sane(G.part(a, "intrinsic"))
    num = G.lowdim_issues(a)
    checks = [
        *[(F.col(c).isNull(), f"missing_{c}") for c in ("image", "lowdim", "mano")],
        (~F.col("has_meta"), "missing_meta"), (m.isNull(), "invalid_meta"),
        (m.isNotNull() & f["missing"], "missing_instruction"), (m.isNotNull() & f["empty"], "empty_instruction"), (m.isNotNull() & f["mismatch"], "instruction_num_mismatch"),
        (has_a & ~sized, "invalid_lowdim"), (has_a & sized & ~fin, "nonfinite_lowdim"), (has_a & sized & fin & ~kk, "invalid_intrinsic"),
        *[(has_a & sized & fin & kk & F.array_contains(num, k), k) for k in ("invalid_rot6d", "invalid_extrinsic")],
    ]
    return samples.withColumn("issues", F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), n) for c, n in checks])))


def sample_clip(key: Column, meta_clip: Column) -> Column:
    """Clip of a sample: its meta's, else the key before its last ``_f``."""
    return F.coalesce(F.when(meta_clip != "", meta_clip), F.regexp_replace(key, r"_f((?!_f).)*$", ""))


def sanity_by_episode(samples: DataFrame) -> DataFrame:
    """Episodes in scan order (``shard, run_id, clip_id``): samples, issues, and whether they would be dropped.

    An episode is a run of one clip within a shard; a clip that comes back later is another one.
    """
    s = samples if "issues" in samples.columns else sample_issues(samples)
    s = s.withColumn("clip_id", sample_clip(F.col("key"), F.col("meta.clip_id")))
    r = episode_runs(s, ["shard"], ["pos"], "clip_id")
    g = r.groupBy("shard", "run_id", "clip_id").agg(F.count("*").alias("samples"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("issues")))).alias("issues"), F.min("pos").alias("first_pos"))
    hard = F.array_intersect("issues", F.array(*[F.lit(h) for h in HARD]))
    return g.withColumn("problematic", F.size("issues") > 0).withColumn("dropped", F.size(hard) > 0)


def sanity_report(samples: DataFrame) -> DataFrame:
    """``counter, value``: samples and samples per issue, episodes, problematic and dropped ones, and episodes per issue."""
    s = sample_issues(samples)
    e = sanity_by_episode(s)
    a = s.select(F.explode(F.concat(F.array(F.lit("samples")), "issues")).alias("counter")).groupBy("counter").agg(F.count("*").alias("value"))
    tags = F.array_compact(F.array(F.lit("episodes"), F.when(F.col("problematic"), F.lit("problematic_episodes")), F.when(F.col("dropped"), F.lit("dropped_episodes"))))
    b = e.select(F.explode(F.concat(tags, F.transform("issues", lambda x: F.concat(F.lit("episodes_with_"), x)))).alias("counter")).groupBy("counter").agg(F.count("*").alias("value"))
    return a.unionByName(b)


def issue_examples(samples: DataFrame, k: int = 32) -> DataFrame:
    """First ``k`` samples per issue in scan order."""
    d = sample_issues(samples).select("shard", "pos", "key", F.explode("issues").alias("issue"))
    return first_examples(d, ["issue"], ["shard", "pos"], k)


def episode_candidates(samples: DataFrame, episode: str, shard: str, pos: str, text: str) -> DataFrame:
    """Episodes with their samples, shards, first non-empty preview and place of first sight."""
    t = F.substring(F.col(text), 1, 160)
    has = F.trim(F.coalesce(F.col(text), F.lit(""))) != ""
    return samples.groupBy(episode).agg(F.count("*").alias("samples"), F.array_sort(F.collect_set(shard)).alias("shards"), F.min_by(t, F.when(has, F.col(pos))).alias("preview"), F.min(pos).alias("first_pos"))


def depth_action_errors(samples: DataFrame, key: str = "key") -> DataFrame:
    """Absolute errors, in metres, between stored depth and the depth of the projected hand points: ``key, point, err``.

    ``samples`` has ``lowdim``, ``depth_mm`` (flat array), ``h`` and ``w``. Points behind the camera, off the image or without depth drop out.
    """
    a = F.col("lowdim")
    pts = F.concat(F.array(G.part(a, "left_wrist"), G.part(a, "right_wrist")), G.points(G.part(a, "left_fingertips")), G.points(G.part(a, "right_fingertips")))
    w2c, k = G.part(a, "w2c"), G.part(a, "intrinsic")
    d = samples.where("lowdim is not null and depth_mm is not null").select(key, "depth_mm", "h", "w", F.posexplode(F.transform(pts, lambda p: F.struct(G.project_to_pixel(p, w2c, k, F.col("w"), F.col("h")).alias("px"), G.at(G.to_camera(p, w2c), 2).alias("z")))).alias("point", "q"))
    mm = F.get("depth_mm", F.col("q.px.y") * F.col("w") + F.col("q.px.x"))
    return d.where("q.px is not null").withColumn("__d", mm / 1000.0).where(F.col("__d") > 0).select(key, "point", F.abs(F.col("__d") - F.col("q.z")).alias("err"))


def error_summary(errors: DataFrame, err: str = "err") -> DataFrame:
    p = F.percentile(err, F.array(F.lit(0.5), F.lit(0.9), F.lit(0.95)))
    return errors.agg(F.count("*").alias("points"), F.avg(err).alias("mean"), p.alias("p"), F.max(err).alias("max")).select("points", "mean", F.col("p")[0].alias("median"), F.col("p")[1].alias("p90"), F.col("p")[2].alias("p95"), "max")


def rotation_summary(df: DataFrame, matrix: str, by: list[str]) -> DataFrame:
    """Ranges of determinant and orthogonality error of flat 3x3 matrices, and how many aren't finite."""
    m = F.col(matrix)
    mm = G.matmul3(G.transpose3(m), m)
    err = G.let(mm, lambda q: F.sqrt(G.total([F.pow(G.at(q, i) - (1.0 if i % 4 == 0 else 0.0), F.lit(2.0)) for i in range(9)])))
    d = df.withColumn("__f", G.is_finite(m))
    ok = F.col("__f")
    return d.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(~ok).alias("nonfinite"), *[f(F.when(ok, x)).alias(n) for x, n0 in ((G.det3(m), "det"), (err, "ortho_err")) for f, n in ((F.min, f"min_{n0}"), (F.max, f"max_{n0}"))])


def action_gap(frames: DataFrame, clip: str = "clip_id", frame: str = "frame_idx") -> DataFrame:
    """Per clip the largest absolute difference between an action and the next frame's state."""
    nxt = F.lead(G.part(F.col("lowdim"), "state")).over(Window.partitionBy(clip).orderBy(frame))
    d = frames.select(clip, F.array_max(F.transform(G.subtract(G.part(F.col("lowdim"), "action"), nxt), lambda x: F.abs(x))).alias("d"))
    return d.groupBy(clip).agg(F.max("d").alias("max_abs_diff"))


def validation_counts(checks: DataFrame, by: str = "check", failed: str = "failed") -> DataFrame:
    """Checks with their failures, and the sum of them all as ``total``."""
    d = checks.groupBy(by).agg(F.coalesce(F.sum(F.col(failed).cast("bigint")), F.lit(0)).alias("failures"))
    return d.unionByName(d.agg(F.lit("total").alias(by), F.coalesce(F.sum("failures"), F.lit(0)).alias("failures")))
