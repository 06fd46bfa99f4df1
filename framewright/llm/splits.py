"""Splits that keep related records together, by largest differencing over whole groups."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.functions.keys import clip_key, group_key, split_name
from framewright.session import checkpointed, guarded_join, salted_join, written


def grouped(clips: DataFrame, sources: DataFrame) -> DataFrame:
    """``manifest_pos, root_source, group_key, split`` and ``component``, the related records' common key.

    The root source is the parent of a re-release. A record that names no group, neither in ``group_id`` nor by its root
    folder, is related to records of the same clip only. This is the key before ``components`` joins keys that share a clip.
    """
    roots = sources.select("source_id", F.coalesce("parent_source_id", "source_id").alias("root_source")).where("source_id is not null").dropDuplicates(["source_id"])
    c = clips.select("manifest_pos", "source_id", group_key(F.col("group_id"), F.col("descriptor.root_dir")).alias("group_key"), split_name(F.col("split")).alias("split"), clip_key(F.col("clip_id")).alias("key"))
    c = guarded_join(c, roots, ["source_id"]).withColumn("root_source", F.coalesce("root_source", "source_id"))
    alone = F.concat(F.lit("clip:"), F.coalesce("key", F.concat(F.lit("line "), F.col("manifest_pos").cast("string"))))
    return c.withColumn("component", F.concat_ws("\x1f", F.coalesce("root_source", F.lit("")), F.coalesce(F.concat(F.lit("group:"), F.col("group_key")), alone)))


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``a, b``, strings): the least node of its component.

    Alternating stars: each node's greater neighbours, then its lesser ones, are tied to the least node it knows. Minima are combined before
    the shuffle and hot nodes are split, so no neighbourhood is gathered; the rounds grow with the logarithm of a component's length.
    """
    e = checkpointed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = salted_join(both, low, ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = checkpointed(large.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = salted_join(large, least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        new = checkpointed(small.where("u <> v").distinct())
        if new.count() == e.count() and new.join(e, ["u", "v"], "left_anti").isEmpty():
            return new.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(new.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        e = new


def components(records: DataFrame) -> DataFrame:
    """``component, whole``: keys of ``grouped`` records and the component they lie in; only keys that share a clip with another have a row.

    Records of one clip of one root source belong together even if its lines name several groups, or a group and none.
    """
    r = records.where("key is not null").select(F.concat_ws("\x1f", F.coalesce("root_source", F.lit("")), "key").alias("clip"), "component").distinct()
    least = r.groupBy("clip").agg(F.min("component").alias("a"), F.max("component").alias("z")).where("a <> z").select("clip", "a")
    edges = guarded_join(r, least, ["clip"], "inner").select("a", F.col("component").alias("b"))
    return connected(edges).toDF("component", "whole")


def group_table(clips: DataFrame, sources: DataFrame) -> DataFrame:
    """``component, root_source, group_key, weight, splits``: the groups that are laid out, with the splits their records name now."""
    g = grouped(clips, sources)
    return g.groupBy("component", "root_source", "group_key").agg(F.count("*").cast("double").alias("weight"), F.collect_set("split").alias("splits"))


def split_groups(clips: DataFrame, sources: DataFrame) -> DataFrame:
    """Groups whose records now name more than one of train, validation and test: ``root_source, group_key``.

    Records that name no split or no group don't count.
    """
    return group_table(clips, sources).where("group_key is not null and root_source is not null and size(splits) > 1").select("root_source", "group_key")


def largest_difference(parts: list[list[tuple[float, list]]], bins: int) -> list[tuple[float, list]]:
    """Karmarkar and Karp's differencing for ``bins`` bins.

    Each part is a list of (weight, members) of at most ``bins`` bins. The two parts of the largest difference between their
    heaviest and lightest bin are combined, heaviest onto lightest, until one is left.
    """
    heap = []
    for i, p in enumerate(parts):
        p = sorted(p, key=lambda t: -t[0]) + [(0.0, [])] * (bins - len(p))
        heap.append((p[-1][0] - p[0][0], i, p))
    heapq.heapify(heap)
    n = len(heap)
    while len(heap) > 1:
        _, _, p = heapq.heappop(heap)
        _, _, q = heapq.heappop(heap)
        r = sorted([(a + b, x + y) for (a, x), (b, y) in zip(p, reversed(q))], key=lambda t: -t[0])
        n += 1
        heapq.heappush(heap, (r[-1][0] - r[0][0], n, r))
    return heap[0][2] if heap else []


def balanced_bins(components: DataFrame, bins: int = 200, per_task: int = 20_000, fan_in: int = 64) -> DataFrame:
    """``component, bin``: components (``component, weight``) in ``bins`` bins of nearly equal weight.

    Differencing runs over hashed portions of about ``per_task`` components side by side; a portion's bins are then combined by the
    same rule, ``fan_in`` portions at a time. What passes upward is ``bins`` weights a portion, never a component.
    """
    n = components.count()
    portions = max(1, -(-n // per_task))
    c = components.withColumn("portion", F.pmod(F.xxhash64("component"), F.lit(portions)).cast("int"))

    def first(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["weight", "component"], ascending=[False, True])
        ids, w = p["component"].tolist(), p["weight"].tolist()
        # the heaviest start bins of their own; the rest go in by rounds of extremes: each round's heaviest onto the lightest bin
        rows = [[(x, [i]) for i, x in enumerate(w[s : s + bins], s)] for s in range(0, len(w), bins)]
        out = [(ids[m], k, x) for k, (x, ms) in enumerate(largest_difference(rows, bins)) for m in ms]
        weight = dict((k, x) for _, k, x in out)
        return pd.DataFrame({"component": [o[0] for o in out], "portion": int(key[0]), "lbin": [o[1] for o in out], "lweight": [weight[o[1]] for o in out]})

    local = checkpointed(c.groupBy("portion").applyInPandas(first, "component string, portion int, lbin int, lweight double"))
    level = local.groupBy("portion", "lbin").agg(F.first("lweight").alias("w")).withColumn("node", F.col("portion"))
    names = local.select("component", F.col("portion").alias("node"), F.col("lbin").alias("bin"))
    level = level.select("node", F.col("lbin").alias("bin"), "w")
    while portions > 1:
        portions = -(-portions // fan_in)

        def merge(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
            parts = [[(x, [(nd, b)]) for b, x in zip(g["bin"], g["w"])] for nd, g in p.groupby("node", sort=True)]
            out = [(nd, b, k, x) for k, (x, ms) in enumerate(largest_difference(parts, bins)) for nd, b in ms]
            return pd.DataFrame(out, columns=["node", "bin", "nbin", "nw"]).assign(up=int(key[0]))[["node", "bin", "up", "nbin", "nw"]]

        up = checkpointed(level.groupBy((F.col("node") % portions).alias("up0")).applyInPandas(merge, "node int, bin int, up int, nbin int, nw double"))
        names = names.join(up.select("node", "bin", "up", "nbin"), ["node", "bin"]).select("component", F.col("up").alias("node"), F.col("nbin").alias("bin"))
        level = up.groupBy("up", "nbin").agg(F.first("nw").alias("w")).toDF("node", "bin", "w")
    return names.select("component", "bin")


def allocate(weights: list[tuple[int, float]], shares: list[tuple[str, float]]) -> dict[int, str]:
    """Whole bins to splits: the heaviest bin goes to the split that is furthest below its part of the total."""
    total = sum(w for _, w in weights)
    have = {s: 0.0 for s, _ in shares}
    out = {}
    for b, w in sorted(weights, key=lambda t: (-t[1], t[0])):
        s = max(shares, key=lambda t: (t[1] * total - have[t[0]], t[1], t[0]))[0]
        have[s] += w
        out[b] = s
    return out


def assign_splits(clips: DataFrame, sources: DataFrame, targets: DataFrame, bins: int = 200, per_task: int = 20_000) -> DataFrame:
    """One split per record, ``manifest_pos, root_source, group_key, split``; related records (``components``) share theirs.

    Shares are of records. Weights are summed per component before any shuffle of single records, so a component that holds a third of
    all rows is one weight. Null or non-positive target shares take no part; shares are scaled to sum to one. Equal bins are as fine as the
    heaviest component allows: a component heavier than a split's share overfills that split and no other.
    An empty table gives an empty result; repeated lines are records of their own.
    """
    rec = written(grouped(clips, sources))
    whole_of = checkpointed(components(rec))
    weights_of = rec.groupBy("component").agg(F.count("*").cast("double").alias("weight"))
    of = written(guarded_join(weights_of, whole_of, ["component"]).select("component", F.coalesce("whole", "component").alias("whole"), "weight"))
    comp = checkpointed(of.groupBy(F.col("whole").alias("component")).agg(F.sum("weight").alias("weight")))
    placed = checkpointed(balanced_bins(comp, bins, per_task).join(comp, "component"))
    shares = [(r[0], float(r[1])) for r in targets.where("target_share > 0 and split_name is not null").select("split_name", "target_share").collect()]
    whole = sum(s for _, s in shares) or 1.0
    weights = [(r[0], r[1]) for r in placed.groupBy("bin").agg(F.sum("weight")).collect()]  # at most `bins` rows
    where = allocate(weights, [(n, s / whole) for n, s in shares])
    names = clips.sparkSession.createDataFrame(list(where.items()) or [(-1, "")], "bin int, split string")
    bound = placed.join(F.broadcast(names), "bin").select(F.col("component").alias("whole"), "split").join(of.select("component", "whole"), "whole").select("component", "split")
    return salted_join(rec.drop("split", "source_id", "key"), bound, ["component"]).select("manifest_pos", "root_source", "group_key", "split")


def split_report(assigned: DataFrame, targets: DataFrame) -> DataFrame:
    """Records, groups and share per split beside the target."""
    got = assigned.groupBy("split").agg(F.count("*").alias("records"), F.countDistinct("root_source", "group_key").alias("groups"))
    total = assigned.agg(F.count("*").alias("total"))
    return targets.select(F.col("split_name").alias("split"), "target_share").join(got, "split", "left").crossJoin(F.broadcast(total)).select("split", "target_share", F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("groups", F.lit(0)).alias("groups"), F.round(F.coalesce("records", F.lit(0)) / F.greatest("total", F.lit(1)), 6).alias("share"))
