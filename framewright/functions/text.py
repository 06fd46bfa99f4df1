"""Keys, names, times and annotation text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewright.functions.geometry import let

LEVELS = ("level1", "level2", "level3", "level4", "level5")
#: Fields of a frame sample and the file suffixes they are stored under.
SAMPLE_FIELDS = {"image": "image.jpg", "lowdim": "lowdim.npy", "mano": "mano.npy", "depth": "depth.png", "meta": "meta.json"}


def stripped(c: Column) -> Column:
    """White space of any kind removed from both ends."""
    return F.regexp_replace(c, r"^[\s  - 　]+|[\s  - 　]+$", "")


def _found(c: Column, pattern: str, i: int = 1) -> Column:
    m = F.regexp_extract(c, pattern, i)
    return F.when(m != "", m)


def frame_index(key: Column) -> Column:
    """Number after the last ``_f`` of a sample key; null if the key has none."""
    return _found(key, r"_f(\d+)$").try_cast("bigint")


def episode_index(key: Column) -> Column:
    return _found(key, r"_ep(\d+)_f\d+$").try_cast("bigint")


def member_parts(name: Column) -> Column:
    """Struct ``key, suffix, field`` of a sample's member name; null for a member of no known field."""
    alt = "|".join(s.replace(".", r"\.") for s in SAMPLE_FIELDS.values())
    key, suffix = _found(name, rf"^(.*)\.({alt})$"), _found(name, rf"^(.*)\.({alt})$", 2)
    field = F.lit(None).cast("string")
    for f, s in SAMPLE_FIELDS.items():
        field = F.when(suffix == s, f).otherwise(field)
    return F.when(key.isNotNull(), F.struct(key.alias("key"), suffix.alias("suffix"), field.alias("field")))


def frame_name_parts(name: Column) -> Column:
    """Struct ``clip, frame, ext`` of a frame file's name, folders and case apart; null if it is no frame."""
    base = F.regexp_extract(name, r"([^/]*)$", 1)
    pat = r"(?i)^(.+)_f(\d+)\.(jpe?g|png)$"
    clip = _found(base, pat)
    return F.when(clip.isNotNull(), F.struct(clip.alias("clip"), F.regexp_extract(base, pat, 2).try_cast("bigint").alias("frame"), F.lower(F.regexp_extract(base, pat, 3)).alias("ext")))


def frame_ext(ext: Column) -> Column:
    """Extension in lower case with one dot in front; ``.jpg`` if empty."""
    e = F.lower(F.regexp_replace(stripped(ext), r"^\.+", ""))
    return F.concat(F.lit("."), F.when(F.coalesce(e, F.lit("")) == "", "jpg").otherwise(e))


def padded(n: Column, width: Column) -> Column:
    """Number with leading zeros up to ``width``, never cut short."""
    s = n.cast("string")
    return F.concat(F.repeat(F.lit("0"), F.greatest(width - F.length(s), F.lit(0))), s)


def tar_frame_name(clip: Column, start: Column, width: Column, ext: Column, i: Column) -> Column:
    """Member name of a clip's frame ``i`` (from 0) in a tar whose names are inferred."""
    return F.concat(clip, F.lit("_f"), padded(start + i, width), frame_ext(ext))


def long_clip_name(clip: Column) -> Column:
    """The longer name under which factory clips are annotated; null for other clips."""
    pat = r"^f(\d+)_w(\d+)_v(\d+)_i(\d+)$"
    g = [F.regexp_extract(clip, pat, i).try_cast("int") for i in range(1, 5)]
    return F.when(clip.rlike(pat), F.format_string("factory_%03d_worker_%03d_%04d_cut%03d", *g))


def annotation_candidates(clip: Column, suffix: str = ".annotation.json") -> Column:
    """Relative paths under which a clip's annotation may lie, best first, each once."""
    fac = F.regexp_extract(clip, r"^f(\d+)_", 1).try_cast("int")
    folder = F.when(fac.isNotNull(), F.format_string("factory%03d/", fac))
    name = long_clip_name(clip)
    return F.array_distinct(F.array_compact(F.array(F.concat(clip, F.lit(suffix)), F.concat(folder, clip, F.lit(suffix)), F.concat(folder, name, F.lit(suffix)), F.concat(name, F.lit(suffix)))))


def without_numbering(c: Column) -> Column:
    """Text without a list number at its head."""
    return stripped(F.regexp_replace(c, r"^\s*\d+\.\s+", ""))


def instructions(listed: Column, levels: Column) -> Column:
    """Instructions listed, without numbering and empty ones; else the hierarchy's levels (a map) in order."""
    clean = lambda a: F.filter(F.transform(a, lambda x: without_numbering(x)), lambda x: F.coalesce(x != "", F.lit(False)))
    own = F.coalesce(clean(listed), F.array().cast("array<string>"))
    return F.when(F.size(own) > 0, own).otherwise(F.coalesce(clean(F.array(*[F.try_element_at(levels, F.lit(k)) for k in LEVELS])), F.array().cast("array<string>")))


def instruction_flags(slots: Column, num: Column) -> Column:
    """Struct ``n, missing, empty, mismatch`` of instruction slots and their stated number (text or number; bad text counts 0)."""
    n = F.greatest(F.coalesce(num.cast("string").try_cast("int"), F.lit(0)), F.lit(0))
    s = F.coalesce(slots, F.array().cast("array<string>"))
    used = F.slice(s, F.lit(1), F.greatest(n, F.lit(1)))
    used = F.when(n > 0, used).otherwise(F.array().cast("array<string>"))
    filled = F.size(F.filter(used, lambda x: F.coalesce(stripped(x) != "", F.lit(False))))
    return F.struct(n.alias("n"), (n <= 0).alias("missing"), ((n > 0) & (filled == 0)).alias("empty"), ((n > 0) & ((F.size(s) < n) | (filled != F.least(n, F.size(used))))).alias("mismatch"))


def json_text(raw: Column) -> Column:
    """A model's answer without code fences."""
    t = stripped(F.coalesce(raw, F.lit("")))
    return stripped(F.regexp_replace(F.regexp_replace(t, r"(?i)^```(json)?\s*", ""), r"\s*```$", ""))


def model_json(raw: Column) -> Column:
    """The answer as a VARIANT: all of it, else from its first brace to its last; null if neither is JSON."""
    return let(json_text(raw), lambda t: F.coalesce(F.try_parse_json(t), F.try_parse_json(_found(t, r"(?s)(\{.*\})"))))


def _text_at(v: Column, *paths: str) -> Column:
    return F.coalesce(*[F.try_variant_get(v, p, "string") for p in paths])


def answer_levels(v: Column) -> Column:
    """Map level -> text of the first block of a model's answer that names any level."""
    blocks = [f"$.{a}{b}" for a in ("", "segments.") for b in ("language_instructions", "hierarchy", "global_analysis")]
    out = None
    for b in blocks:
        entries = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), stripped(F.try_variant_get(v, f"{b}.{k}", "string")).alias("value")) for k in LEVELS]), lambda e: F.coalesce(e["value"] != "", F.lit(False)))
        here = F.when(F.size(entries) > 0, F.map_from_entries(entries))
        out = here if out is None else F.coalesce(out, here)
    return out


def annotation_payload(raw: Column) -> Column:
    """Struct ``status, is_good_quality, instruction, instruction_num, language, levels`` of a model's answer.

    Only "invalid", in any case, is invalid; then quality and levels are dropped. The language line is level 5, else 2, else the last.
    """
    none = F.create_map().cast("map<string,string>")

    def parsed(v: Column) -> Column:
        bad = F.lower(stripped(_text_at(v, "$.status", "$.segments.status"))) == "invalid"
        good = F.coalesce(F.try_variant_get(v, "$.is_good_quality", "boolean"), F.try_variant_get(v, "$.segments.is_good_quality", "boolean"), F.lit(False))
        return F.struct((~F.coalesce(bad, F.lit(False))).alias("ok"), good.alias("good"), answer_levels(v).alias("levels"))

    def with_levels(p: Column) -> Column:
        return let(F.when(p["ok"], F.coalesce(p["levels"], none)).otherwise(none), lambda m: with_text(p, m))

    def with_text(p: Column, m: Column) -> Column:
        at = lambda k: F.try_element_at(m, F.lit(k))
        ins = F.filter(F.array(*[at(k) for k in LEVELS]), lambda x: x.isNotNull())
        return let(ins, lambda i: F.struct(F.when(p["ok"], "Valid").otherwise("Invalid").alias("status"), (p["ok"] & p["good"]).alias("is_good_quality"), i.alias("instruction"), F.size(i).alias("instruction_num"), F.coalesce(at("level5"), at("level2"), F.try_element_at(i, F.lit(-1))).alias("language"), m.alias("levels")))

    return let(let(model_json(raw), parsed), with_levels)


def segments(raw: Column) -> Column:
    """array<variant> of the objects in a model's answer: a list, an object's ``segments`` list, or the object itself."""
    v = F.try_parse_json(json_text(raw))
    arr = F.coalesce(F.try_variant_get(v, "$.segments", "array<variant>"), F.try_variant_get(v, "$", "array<variant>"), F.array(v))
    return F.filter(arr, lambda s: F.schema_of_variant(s).startswith("OBJECT"))


def segment_bounds(seg: Column) -> Column:
    """Struct ``start, end`` in seconds of a segment under any of its names, 0 if missing."""
    num = lambda *ks: F.coalesce(*[F.try_variant_get(seg, f"$.{k}", "double") for k in ks], F.lit(0.0))
    return F.struct(num("start", "start_sec", "begin").alias("start"), num("end", "end_sec", "finish").alias("end"))


def safe_stem(path: Column, default: str = "clip") -> Column:
    """File name without folders and last suffix; anything but letters, digits, ``-_.`` becomes ``_``."""
    base = F.regexp_extract(F.regexp_replace(path, r"/+$", ""), r"([^/]*)$", 1)
    stem = F.regexp_replace(base, r"(?<=.)\.[^.]+$", "")
    s = F.regexp_replace(F.regexp_replace(stem, r"[^\p{L}\p{N}\-_.]", "_"), r"^[._]+|[._]+$", "")
    return F.when(s == "", default).otherwise(s)


def slug(c: Column, default: str = "video") -> Column:
    """Runs of other than ASCII letters, digits and ``_.-`` become one ``_``."""
    s = F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9_.\-]+", "_"), r"^[._\-]+|[._\-]+$", "")
    return F.when(s == "", default).otherwise(s)


def host_slug(c: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(stripped(c)), r"[^\p{L}\p{N}\-_]", "-"), r"^[\-_]+|[\-_]+$", "")
    return F.when(s == "", "host").otherwise(s)


def clip_id_of_path(relative: Column) -> Column:
    """Relative path without suffix, parts joined by ``__``."""
    return F.replace(F.regexp_replace(relative, r"(?<=[^/])\.[^./]+$", ""), F.lit("/"), F.lit("__"))


def run_tag(template: Column, host: Column, at: Column) -> Column:
    """Template with {hostname} and {timestamp} (YYYYmmdd_HHMMSS) filled in."""
    return F.replace(F.replace(template, F.lit("{hostname}"), host_slug(host)), F.lit("{timestamp}"), F.date_format(at, "yyyyMMdd_HHmmss"))


def iso_time(raw: Column) -> Column:
    """ISO-8601 text as a timestamp; without offset it is UTC (the session's zone); bad or empty text gives null."""
    t = F.regexp_replace(stripped(raw), "Z$", "+00:00")
    return F.when(t != "", F.try_to_timestamp(F.replace(t, F.lit("T"), F.lit(" "))))


def age(seconds: Column) -> Column:
    """``-`` for null, else whole s, m, h or d; the future counts as now."""
    s = F.greatest(F.floor(seconds), F.lit(0)).cast("bigint")
    part = lambda k, u: F.concat(F.floor(s / k).cast("string"), F.lit(u))
    return F.when(seconds.isNull(), "-").when(s < 60, part(1, "s")).when(s < 3600, part(60, "m")).when(s < 86400, part(3600, "h")).otherwise(part(86400, "d"))


def cache_key(path: Column) -> Column:
    return F.md5(path)


def scratch_key(path: Column) -> Column:
    return F.substring(F.sha1(path), 1, 12)


def seq_folder(explicit: Column, output_root: Column, root_dir: Column, clip: Column) -> Column:
    """Result folder: the one named, else under the output root, else beside the data."""
    under = lambda r: F.when(F.coalesce(r, F.lit("")) != "", F.concat_ws("/", F.regexp_replace(r, "/+$", ""), clip))
    return F.coalesce(F.when(F.coalesce(explicit, F.lit("")) != "", explicit), under(output_root), under(root_dir))


def preview(texts: Column, n: int = 160) -> Column:
    """First non-empty text, cut to ``n`` characters."""
    return F.substring(F.try_element_at(F.filter(texts, lambda x: F.coalesce(stripped(x) != "", F.lit(False))), F.lit(1)), 1, n)


def dimension_names() -> list[str]:
    """Names of the 116 numbers of a frame vector (fixed values, spelled by rule)."""
    wrist = [f"{h}_wrist.{a}" for h in ("left", "right") for a in "xyz"] + [f"{h}_root_rot6d.{i}" for h in ("left", "right") for i in range(6)]
    tips = [f"{h}_fingertip{t}.{a}" for h in ("left", "right") for t in range(5) for a in "xyz"]
    return [f"{k}.{n}" for k in ("state", "action") for n in wrist + tips] + [f"camera_w2c.r{r}c{c}" for r in range(4) for c in range(4)] + [f"camera_intrinsic.{k}" for k in ("fx", "fy", "cx", "cy")]
