"""Clips joined with their annotations: candidate paths, error codes, issue summaries and segment choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.text import annotation_candidates, instructions, stripped

#: Error codes of annotation loading.
CODES = ("missing_annotation", "invalid_json", "invalid_status", "empty_instruction")


def with_annotations(clips: DataFrame, sidecars: DataFrame, clip: str = "clip_id", suffix: str = ".annotation.json") -> DataFrame:
    """Clips with ``path, annotation_error, instruction, instruction_num, language`` from the first candidate path that exists.

    ``sidecars`` has ``path`` (relative) and ``body`` (JSON text). One equi join on the exploded candidates; the best rank wins. A clip without
    any sidecar keeps its first candidate as path and gets ``missing_annotation``.
    """
    keys = clips.select(clip).where(F.col(clip).isNotNull()).distinct()
    cand = keys.select(clip, F.posexplode(annotation_candidates(F.col(clip), suffix)).alias("rank", "path"))
    one = sidecars.groupBy("path").agg(F.min("body").alias("body"))
    best = cand.join(one, "path").groupBy(clip).agg(F.min_by(F.struct("path", "body"), "rank").alias("hit"))
    d = clips.join(best, clip, "left")
    v = F.try_parse_json(F.col("hit.body"))
    levels = F.coalesce(F.try_variant_get(v, "$.hierarchy", "map<string,string>"), F.try_variant_get(v, "$.global_analysis", "map<string,string>"))
    ins = instructions(F.try_variant_get(v, "$.instruction", "array<string>"), levels)
    status = F.coalesce(stripped(F.try_variant_get(v, "$.status", "string")), F.lit("Valid"))
    err = F.when(F.col("hit").isNull(), CODES[0]).when(v.isNull() | ~F.schema_of_variant(v).startswith("OBJECT"), CODES[1]).when(status != "Valid", CODES[2]).when(F.size(ins) == 0, CODES[3])
    lang = stripped(F.try_variant_get(v, "$.language", "string"))
    none = F.array().cast("array<string>")
    d = d.select(*clips.columns, F.coalesce("hit.path", F.try_element_at(annotation_candidates(F.col(clip), suffix), F.lit(1))).alias("path"), err.alias("annotation_error"), F.when(err.isNull(), ins).otherwise(none).alias("instruction"), F.when(err.isNull() & (lang != ""), lang).alias("language"))
    return d.withColumn("instruction_num", F.size("instruction"))


def annotated(clips: DataFrame, required: bool) -> DataFrame:
    """Result of ``with_annotations``: only clips without error if annotations are required, else all of them, with empty instructions."""
    return clips.where("annotation_error is null") if required else clips


def issue_summary(errors: DataFrame, code: str = "annotation_error") -> DataFrame:
    """One row: counts of the four known codes, of others, and of all (rows without code don't count)."""
    e = F.col(code)
    return errors.where(e.isNotNull()).agg(*[F.count_if(e == c).alias(c) for c in CODES], F.count_if(~e.isin(*CODES)).alias("other"), F.count("*").alias("total"))


def write_issues(clips: DataFrame, folder: str, pos: str = "manifest_pos", code: str = "annotation_error") -> None:
    """JSON lines of the clips with an error in manifest order (``issues``) and the one-row summary (``summary``) under ``folder``."""
    bad = clips.where(F.col(code).isNotNull())
    bad.select(pos, "clip_id", "path", code).repartitionByRange(F.col(pos)).sortWithinPartitions(pos).write.mode("overwrite").json(f"{folder}/issues")
    issue_summary(clips, code).write.mode("overwrite").json(f"{folder}/summary")


def status_counts(results: DataFrame, status: str, known: list[str]) -> DataFrame:
    """One row of counts per known status (0 if it doesn't occur) and ``total``."""
    return results.agg(*[F.count_if(F.col(status) == s).alias(s) for s in known], F.count("*").alias("total"))


def segment_choice(start: Column, end: Column, valid: Column, good: Column, has_language: Column, least_sec: float = 2.0) -> Column:
    """First reason to skip a segment, or null: bad bounds, too short, invalid, poor quality, no language."""
    return F.when(~F.coalesce(end > start, F.lit(False)), "invalid_bounds").when(end - start < least_sec, "too_short").when(~F.coalesce(valid, F.lit(False)), "invalid_status").when(~F.coalesce(good, F.lit(False)), "low_quality").when(~F.coalesce(has_language, F.lit(False)), "missing_language")


def with_new_instruction(meta: DataFrame, instruction: Column, language: Column | None = None, column: str = "meta") -> DataFrame:
    """The meta struct with other instructions, their number, and a language if given; its other fields stay."""
    m = F.col(column).withField("instruction", instruction).withField("instruction_num", F.size(instruction))
    return meta.withColumn(column, m.withField("language", language) if language is not None else m)


def search(samples: DataFrame, texts: list[Column], needle: str | None = None, presence: Column | None = None, wanted: int | None = None, pos: str | None = None, limit: int | None = None) -> DataFrame:
    """Samples whose texts hold ``needle`` in any case, of a presence value, and before position ``limit``."""
    d = samples
    if needle:
        d = d.where(F.contains(F.lower(F.concat_ws(" ", *texts)), F.lit(needle.lower())))
    if presence is not None and wanted is not None:
        d = d.where(presence == wanted)
    return d.where(F.col(pos) < limit) if pos and limit is not None else d
