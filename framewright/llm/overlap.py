"""The same or nearly the same footage across splits, by a suffix array over the records' frame sizes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions.keys import clip_key, split_name
from framewright.session import checkpointed, fits_broadcast, salted_join, written

#: Symbols of the suffix array: a frame size, or a hash of it if it is this or more. The final check compares whole sizes.
SYMBOLS = (1 << 31) - 1
#: Common prefixes are told apart up to this length; longer spans are seen as several that overlap.
DEPTH = 16


def lcs_length(x: list, y: list) -> int:
    """Length of the longest common subsequence, bit-parallel: one big-integer step per symbol of ``y``."""
    at: dict = {}
    for i, v in enumerate(x):
        at[v] = at.get(v, 0) | (1 << i)
    full = (1 << len(x)) - 1
    row = full
    for v in y:
        m = row & at.get(v, 0)
        row = ((row + m) | (row - m)) & full
    return len(x) - row.bit_count()


def manifest_lines(clips: DataFrame) -> DataFrame:
    """``manifest_pos, source_id, split, key, cls, sizes``: stored sizes in order, and a name for the exact sequence.

    Lines whose split names no split are dropped: they are on neither side of a pair. ``sizes`` is null without offsets; a
    frame without size has size -1.
    """
    sizes = F.transform(F.col("descriptor.frame_offsets"), lambda o: F.coalesce(F.get(o, F.lit(1)), F.lit(-1).cast("bigint")))
    d = clips.select("manifest_pos", "source_id", split_name(F.col("split")).alias("split"), clip_key(F.col("clip_id")).alias("key"), F.when(F.size(sizes) > 0, sizes).alias("sizes"))
    return d.where("split is not null").withColumn("cls", F.unhex(F.md5(F.array_join("sizes", ","))))


def texts_of(lines: DataFrame) -> DataFrame:
    """``id, cls, n, tr, ev, sizes``: one text per exact sequence, numbered, with the sides it is listed on.

    A group of copies is one text, however many lines it has.
    """
    one = lines.where("sizes is not null").groupBy("cls").agg(F.any_value("sizes").alias("sizes"), F.bool_or(F.col("split") == "train").alias("tr"), F.bool_or(F.col("split") != "train").alias("ev"))
    return written(one.select(F.monotonically_increasing_id().alias("id"), "cls", F.size("sizes").alias("n"), "tr", "ev", "sizes"))


def symbols(sizes: Column) -> Column:
    return F.transform(sizes, lambda x: F.when((x >= 0) & (x < SYMBOLS), x).otherwise(F.pmod(F.xxhash64(x), F.lit(SYMBOLS))).cast("int"))


def least_spans(n: Column, share: float) -> Column:
    """Frames of a text of ``n`` that lie in spans of two or more shared with any text it matches.

    If m frames of two texts with na and nb match in order, na + nb - 2m are left over, and each break between two runs of matches takes one
    of those. So at most na + nb - 2m + 1 runs are single frames, and 3m - na - nb frames lie in longer ones: with m at least ``share`` of the longer,
    at least (3 share - 2) n for each of the two. (Up to 1 / (3 share - 2) frames, none need be.)
    """
    return F.greatest(F.ceil(n * (3 * share - 2) - 1e-9), F.lit(1))


def shared_suffixes(texts: DataFrame, share: float, span: int) -> DataFrame:
    """``id, n, tr, ev, sym, at``: where suffixes begin whose first ``span`` symbols both sides have, the rarest first.

    Prefixes are counted by side, map-side combined, before any suffix is made: of a text only the suffixes that meet the other
    side go on, and only if they cover ``least_spans`` of it. ``at`` holds structs ``f`` (pairs such a prefix makes), ``k`` (the prefix) and ``i``.
    """
    sym = F.col("sym")
    word = lambda i: F.get(sym, i).cast("bigint") if span == 1 else F.shiftleft(F.get(sym, i).cast("bigint"), 31) + F.get(sym, i + 1)
    d = texts.select("id", "n", "tr", "ev", symbols(F.col("sizes")).alias("sym")).where(F.col("n") >= span)
    rows = d.select("id", "n", "tr", "ev", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("n") - span), word)).alias("i", "k"))
    sides = rows.groupBy("k").agg(F.sum(F.col("tr").cast("int")).alias("nt"), F.sum(F.col("ev").cast("int")).alias("ne")).where("nt > 0 and ne > 0")
    sides = checkpointed(sides.select("k", (F.col("nt") * F.col("ne")).alias("f")))
    met = rows.select("id", "n", "i", "k").join(F.broadcast(sides) if fits_broadcast(sides) else sides, "k")
    at = F.array_sort(F.collect_list(F.struct("f", "k", "i")))
    of = met.groupBy("id", "n").agg(at.alias("at"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda x: F.sequence(x["i"], x["i"] + span - 1)))))
    of = checkpointed(of.where(covered >= least_spans(F.col("n"), share)).select("id", "at"))
    return d.join(F.broadcast(of) if fits_broadcast(of) else of, "id")


def suffix_array(shared: DataFrame, share: float, span: int, depth: int = DEPTH) -> DataFrame:
    """The sorted suffixes with their common-prefix intervals: ``id, n, tr, ev, i, meet, iv, ids``.

    Suffixes are ordered by range partitions and sorted in each; ``lcp`` is the common prefix with the suffix before, over partition borders
    too. A run of neighbours with ``lcp`` of d or more is an interval of depth d: ``ids`` numbers a suffix's intervals of the depths 1 to
    ``depth``, so two suffixes have a common prefix as long as their ids agree. ``iv`` is the interval of depth ``span``.

    A matching pair has T = least_spans - 1 or more such places in common (a span of l frames has l - 1). If each text leaves out its
    T - 1 commonest places, the rarest place in common still meets: those left have ``meet``. So a prefix that a third of all texts have
    makes no pairs, unless it is most of what they have.
    """
    spare = F.greatest(least_spans(F.col("n"), share) - 1, F.lit(1)) - 1
    rows = shared.select("id", "n", "tr", "ev", "sym", (F.size("at") - spare).alias("most"), F.posexplode("at").alias("p", "x"))
    rows = rows.select("id", "n", "tr", "ev", F.col("x.i").alias("i"), (F.col("p") < F.col("most")).alias("meet"), F.slice("sym", F.col("x.i") + 1, depth).alias("suf"))
    order = ["suf", "id", "i"]
    ranged = checkpointed(rows.repartitionByRange(*order).withColumn("pid", F.spark_partition_id()))
    # the last suffix of the partition before, one row a partition
    ends = ranged.groupBy("pid").agg(F.max("suf").alias("last"))
    ends = checkpointed(ends.select("pid", F.lag("last").over(Window.orderBy("pid")).alias("before")))
    w = Window.partitionBy("pid").orderBy(*order)
    above = F.coalesce(F.lag("suf").over(w), F.col("before"))
    d = ranged.join(F.broadcast(ends), "pid").withColumn("above", above)
    step = lambda s, z: F.when(s["go"] & F.coalesce(z["suf"] == z["above"], F.lit(False)), F.struct((s["n"] + 1).alias("n"), F.lit(True).alias("go"))).otherwise(F.struct(s["n"].alias("n"), F.lit(False).alias("go")))
    d = d.withColumn("lcp", F.when(F.col("above").isNull(), 0).otherwise(F.aggregate(F.arrays_zip("suf", "above"), F.struct(F.lit(0).alias("n"), F.lit(True).alias("go")), step)["n"]))
    breaks = [F.sum(F.when(F.col("lcp") < k, 1).otherwise(0)).over(w).cast("bigint").alias(f"b{k}") for k in range(1, depth + 1)]
    d = checkpointed(d.select("pid", "id", "n", "tr", "ev", "i", "meet", *breaks).select("pid", "id", "n", "tr", "ev", "i", "meet", F.array(*[f"b{k}" for k in range(1, depth + 1)]).alias("ids")))
    sums = d.groupBy("pid").agg(*[F.max(F.get("ids", F.lit(k))).alias(f"m{k}") for k in range(depth)])
    up = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    base = checkpointed(sums.select("pid", F.array(*[F.coalesce(F.sum(f"m{k}").over(up), F.lit(0)) for k in range(depth)]).alias("base")))
    d = d.join(F.broadcast(base), "pid").withColumn("ids", F.zip_with("ids", "base", lambda x, y: x + y))
    return written(d.select("id", "n", "tr", "ev", "i", "meet", F.get("ids", F.lit(span - 1)).alias("iv"), "ids"))


def shared_spans(a_at: np.ndarray, a_ids: np.ndarray, b_at: np.ndarray, b_ids: np.ndarray, na: int, nb: int, span: int) -> tuple[int, int]:
    """Frames of two texts that lie in spans they share: places and interval ids of their suffixes merged into coverage."""
    lcp = (a_ids[:, None, :] == b_ids[None, :, :]).sum(2)
    ca, cb = np.zeros(na, bool), np.zeros(nb, bool)
    for i, j in zip(*np.nonzero(lcp >= span)):
        n = lcp[i, j]
        ca[a_at[i] : a_at[i] + n] = True
        cb[b_at[j] : b_at[j] + n] = True
    return int(ca.sum()), int(cb.sum())


def matches_of(texts: DataFrame, share: float, span: int, depth: int = DEPTH) -> DataFrame:
    """``a, b, same, cover_a, cover_b`` of the matching texts that share a span of ``span`` frames, ``a`` in train and ``b`` not, a <> b.

    Pairs meet in an interval of the suffix array; the spans they share are merged into coverage, and a pair whose coverage
    falls short of what a match must have is given up. The others' frames are compared in full.
    """
    sa = suffix_array(shared_suffixes(texts, share, span), share, span, depth)
    side = lambda flag, c: sa.where(f"meet and {flag}").select("iv", F.col("id").alias(c), F.col("n").alias(f"n{c}"))
    fits = F.least("na", "nb") >= share * F.greatest("na", "nb") - 1e-9
    cand = written(salted_join(side("tr", "a"), side("ev", "b"), ["iv"]).where((F.col("a") != F.col("b")) & fits).select("a", "b").distinct())
    whole = sa.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("i", "ids"))).alias("s")).select("id", F.col("s.i").alias("at"), F.flatten("s.ids").alias("ids")).join(texts.select("id", "sizes"), "id")
    whole = written(whole)
    named = lambda c: whole.select(F.col("id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("at", "ids", "sizes")])
    full = salted_join(salted_join(cand, named("a"), ["a"]), named("b"), ["b"])

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            for a, b, pa, ia, x, pb, ib, y in zip(p["a"], p["b"], p["at_a"], p["ids_a"], p["sizes_a"], p["at_b"], p["ids_b"], p["sizes_b"]):
                na, nb = len(x), len(y)
                m = math.ceil(share * max(na, nb) - 1e-9)
                ca, cb = shared_spans(pa, ia.reshape(-1, depth), pb, ib.reshape(-1, depth), na, nb, span)
                if span > 1 and min(ca, cb) < 3 * m - na - nb:
                    continue
                same = lcs_length(x.tolist(), y.tolist())
                if same >= m:
                    out.append((a, b, same, ca / na, cb / nb))
            yield pd.DataFrame(out, columns=["a", "b", "same", "cover_a", "cover_b"])

    return full.mapInPandas(check, "a bigint, b bigint, same int, cover_a double, cover_b double")


@dataclass
class Overlap:
    """``lines`` (``manifest_pos, source_id, split, key, cls``), ``texts`` and ``matches`` (``cls_a, cls_b, same, cover_a, cover_b``), all written."""

    lines: DataFrame
    texts: DataFrame
    matches: DataFrame


def overlap(clips: DataFrame, share: float = 0.75, depth: int = DEPTH) -> Overlap:
    """Texts of train and of evaluation records that show the same footage, with the coverage of each by the spans they share.

    Two texts match if ``share`` (over two thirds) of the longer one's frames are the same, in order. Texts longer than 1 / (3 share - 2) frames
    (four, at 0.75) then have a common span of two; pairs of shorter ones are found by single frames. Equal texts match whole.
    """
    if not 2 / 3 < share <= 1:
        raise ValueError("share must be over two thirds")
    all_ = manifest_lines(clips)
    lines, texts = written(all_.drop("sizes")), texts_of(all_)
    near = matches_of(texts, share, 2, depth)
    short = texts.where(F.col("n") <= math.floor(1 / (3 * share - 2) + 1e-9))
    if not short.limit(1).isEmpty():
        near = near.unionByName(matches_of(written(short), share, 1, depth)).dropDuplicates(["a", "b"])
    near = written(near)
    name = lambda c: texts.select(F.col("id").alias(c), F.col("cls").alias(f"cls_{c}"))
    near = salted_join(salted_join(near, name("a"), ["a"]), name("b"), ["b"]).drop("a", "b")
    one = F.lit(1.0)
    same = texts.where("tr and ev").select(F.col("cls").alias("cls_a"), F.col("cls").alias("cls_b"), F.col("n").alias("same"), one.alias("cover_a"), one.alias("cover_b"))
    return Overlap(lines, texts, written(near.unionByName(same)))


def pairs_of(o: Overlap) -> DataFrame:
    """``train_pos, eval_pos`` of matching records; hot clip ids and hot texts are split over tasks."""
    tr = lambda *c: o.lines.where("split = 'train'").select(F.col("manifest_pos").alias("train_pos"), *c)
    ev = lambda *c: o.lines.where("split <> 'train'").select(F.col("manifest_pos").alias("eval_pos"), *c)
    by_key = salted_join(tr("key").where("key is not null"), ev("key"), ["key"]).select("train_pos", "eval_pos")
    texts = salted_join(tr(F.col("cls").alias("cls_a")).where("cls_a is not null"), o.matches.select("cls_a", "cls_b"), ["cls_a"]).select("train_pos", "cls_b")
    by_text = salted_join(texts, ev(F.col("cls").alias("cls_b")), ["cls_b"]).select("train_pos", "eval_pos")
    return by_key.unionByName(by_text).distinct()


def cross_split_pairs(clips: DataFrame, **options) -> DataFrame:
    """Pairs of one train record and one validation or test record of the same footage, ``train_pos, eval_pos``.

    The same: equal clip id apart from spelling, or at least three quarters of the longer clip's frames the same, in order, by
    stored size. Every listed line counts. A record without clip id or without offsets can match by the other alone; a record of no split,
    or with neither, is in no pair. An empty table gives an empty result.
    """
    return pairs_of(overlap(clips, **options))


def coverage_of(o: Overlap) -> DataFrame:
    """One row per evaluation record with frames: ``manifest_pos, split, source_id, frames, matching_texts, same, coverage``.

    ``coverage`` is the largest part of the record that one train text covers by shared spans, ``same`` the most frames in order that a
    matching train text has in common with it (both 0 without such a text).
    """
    best = o.matches.groupBy(F.col("cls_b").alias("cls")).agg(F.count("*").alias("k"), F.max("same").alias("s"), F.max("cover_b").alias("c"))
    ev = o.lines.where("split <> 'train' and cls is not null")
    d = salted_join(salted_join(ev, o.texts.select("cls", "n"), ["cls"]), best, ["cls"], "left")
    return d.select("manifest_pos", "split", "source_id", F.col("n").alias("frames"), F.coalesce("k", F.lit(0)).alias("matching_texts"), F.coalesce("s", F.lit(0)).alias("same"), F.round(F.coalesce("c", F.lit(0.0)), 6).alias("coverage"))


def record_coverage(clips: DataFrame, **options) -> DataFrame:
    return coverage_of(overlap(clips, **options))


def overlap_report(clips: DataFrame, **options) -> DataFrame:
    """Per evaluation split and source: records, records with a train copy, pairs, and the mean coverage of its records with frames."""
    o = overlap(clips, **options)
    per = pairs_of(o).groupBy(F.col("eval_pos").alias("manifest_pos")).agg(F.count("*").alias("n"))
    lines = o.lines.where("split <> 'train'").select("manifest_pos", "split", "source_id").join(per, "manifest_pos", "left").join(coverage_of(o).select("manifest_pos", "coverage"), "manifest_pos", "left")
    return lines.groupBy("split", "source_id").agg(
        F.count("*").alias("records"), F.count("n").alias("overlapping_records"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"), F.round(F.count("n") / F.count("*"), 6).alias("overlapping_share"), F.round(F.avg("coverage"), 6).alias("mean_coverage")
    )
