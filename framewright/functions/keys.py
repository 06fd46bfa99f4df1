"""Spellings of clip ids, split names and group names brought to one form (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_key(c: Column) -> Column:
    """Clip id apart from spelling: case, blanks, separators, a file suffix, leading zeros and the long form.

    Null, and an id without a letter or digit, give null.
    """
    s = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    s = F.regexp_replace(s, r"\.(mp4|mov|avi|mkv|webm|tar|zip|json|jpe?g|png)$", "")
    s = F.regexp_replace(F.regexp_replace(s, r"[^\p{L}\p{N}]+", "_"), r"^_+|_+$", "")
    s = F.regexp_replace(s, r"^factory_(\d+)_worker_(\d+)_(\d+)_cut(\d+)$", "f$1_w$2_v$3_i$4")
    s = F.regexp_replace(s, r"(?<![0-9])0+(?=[0-9])", "")
    return F.when(s != "", s)


def split_name(c: Column) -> Column:
    """``train``, ``validation`` or ``test``; null for a name of no split."""
    s = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return (
        F.when(s.rlike("^train(ing)?$"), "train").when(s.rlike("^val(id(ation)?)?$"), "validation").when(s.rlike("^test(ing)?$"), "test")
    )


def _group_form(c: Column) -> Column:
    s = F.regexp_replace(F.lower(c), r"[\s/]+", "")
    s = F.regexp_replace(s, r"[-_.]+", "_")
    return F.when(s != "", s)


def group_key(group_id: Column, root_dir: Column) -> Column:
    """The group's name in lower case with underscores; the last part of ``root_dir`` where it is empty."""
    last = F.regexp_extract(F.regexp_replace(root_dir, r"[/\s]+$", ""), r"([^/]+)$", 1)
    return F.coalesce(_group_form(group_id), _group_form(last))


def frame_clip(name: Column) -> Column:
    """Clip id in a frame's member name ``[folders/]<clip>_f<number>.<ext>``; null if it is no such name."""
    s = F.regexp_extract(name, r"([^/]+)_[fF]\d+\.[A-Za-z0-9]+\s*$", 1)
    return F.when(s != "", s)


def frame_number(name: Column) -> Column:
    """Number in a frame's member name, whatever its width; null if it has none."""
    return F.regexp_extract(name, r"_[fF](\d+)\.[A-Za-z0-9]+\s*$", 1).try_cast("bigint")
