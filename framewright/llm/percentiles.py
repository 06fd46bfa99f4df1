"""Percentiles with a deterministic error bound, by buffer collapsing; sketches of days combine into longer spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.operators.control_charts import one_per_clip
from framewright.session import checkpointed

METRICS = ("max_camera_space_wrist_abs", "max_camera_space_hand_abs", "max_wrist_rotation_step")
PERCENTS = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
#: A sketch is a set of rows: level 0 holds values of weight 1, level l buffers of SIZE values of weight FAN ** l each.
SIZE, FAN = 400, 10
NODES = 64
SKETCH = "level int, vals array<double>, err double"


def collapse(values: np.ndarray, size: int, fan: int, turn: int = 0) -> np.ndarray:
    """``size`` values at evenly spaced, centred positions of ``size * fan`` values (buffers of equal weight, merged).

    An even ``fan`` has two middles; ``turn`` tells which is taken, so that alternating collapses lean neither up nor down.
    """
    return np.sort(values)[np.arange(size) * fan + (fan - 1 + turn % 2) // 2]


def compact_sketch(raw: np.ndarray, levels: dict[int, list[np.ndarray]], err: float, size: int = SIZE, fan: int = FAN) -> tuple[np.ndarray, dict[int, list[np.ndarray]], float]:
    """Collapse until every level holds fewer than ``fan`` buffers.

    A collapse whose result has weight W moves any rank by at most W / 2; ``err`` sums that. The tree has log(n / size) levels to the
    base ``fan`` with n / (2 size) each, so the error is at most n * log_fan(n / size) / (2 size): under 1 % of n up to n = 4e10.
    """
    levels = {k: list(v) for k, v in levels.items()}
    full = len(raw) // (size * fan)
    if full:
        raw = np.sort(raw)
        for c in range(full):  # every full-th value: each buffer spans the whole range
            levels.setdefault(1, []).append(collapse(raw[c : full * size * fan : full], size, fan, len(levels.get(1, []))))
            err += fan / 2
        raw = raw[full * size * fan :]
    at = 1
    while at <= max(levels, default=0):
        while len(levels.get(at, [])) >= fan:
            take, levels[at] = levels[at][:fan], levels[at][fan:]
            levels.setdefault(at + 1, []).append(collapse(np.concatenate(take), size, fan, len(levels.get(at + 1, []))))
            err += fan ** (at + 1) / 2
        at += 1
    return raw, {k: v for k, v in levels.items() if v}, err


def sketch_percentiles(raw: np.ndarray, levels: dict[int, list[np.ndarray]], percents: tuple, fan: int = FAN) -> tuple[int, np.ndarray]:
    """Number of values, and per percent the smallest value whose summed weight reaches that part of them."""
    v = np.concatenate([raw, *[b for x in levels.values() for b in x]])
    w = np.concatenate([np.ones(len(raw)), *[np.full(len(b), float(fan**k)) for k, x in levels.items() for b in x]])
    o = np.argsort(v, kind="stable")
    c = np.cumsum(w[o])
    return int(round(c[-1])), v[o][np.minimum(np.searchsorted(c, np.ceil(np.array(percents) * c[-1] - 1e-9) - 0.5), len(v) - 1)]


def _whole_keys(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole keys (the first ``keys`` columns, equal ones adjacent) and where each key begins."""
    rest: pa.Table | None = None

    def starts(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[:1] = True
        for i in range(keys):
            col = t.column(i).combine_chunks().dictionary_encode(null_encoding="encode")
            code = (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col).indices.to_numpy(zero_copy_only=False)
            new[1:] |= code[1:] != code[:-1]
        return np.flatnonzero(new)

    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        if not t.num_rows:
            continue
        s = starts(t)
        rest = t.slice(s[-1])
        if len(s) > 1:
            yield t.slice(0, s[-1]), s[:-1]
    if rest is not None and rest.num_rows:
        yield rest, np.zeros(1, int)


def _gather(t: pa.Table, starts: np.ndarray, keys: int):
    """Of a table of key columns, level, vals, err: flat values by row, row bounds, levels and errors."""
    v = t.column(keys + 1).combine_chunks()
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    off = v.offsets.to_numpy()
    return v.values.to_numpy(zero_copy_only=False), off, t.column(keys).to_numpy(), t.column(keys + 2).to_numpy(), np.r_[starts, t.num_rows]


def _of_key(flat, off, level, err, a: int, z: int) -> tuple[np.ndarray, dict[int, list[np.ndarray]], float]:
    raw, levels = [np.empty(0)], {}
    for r in range(a, z):
        x = flat[off[r] : off[r + 1]]
        raw.append(x) if level[r] == 0 else levels.setdefault(int(level[r]), []).append(x)
    return compact_sketch(np.concatenate(raw), levels, float(err[a:z].sum()))


def partial_sketches(df: DataFrame, keys: list[str], metrics: list[str], rows: int = 1 << 18) -> DataFrame:
    """``keys, metric`` and sketch rows: one sketch per chunk of at most ``rows`` rows before any shuffle (map-side combine), at most NODES per key."""
    kinds = dict(df.dtypes)
    nk = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield from cut(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield from cut(pa.Table.from_batches(held))

    def cut(t: pa.Table) -> Iterator[pa.RecordBatch]:
        codes = np.zeros(t.num_rows, np.int64)
        for i in range(nk):
            d = t.column(i).combine_chunks().dictionary_encode(null_encoding="encode")
            d = d.combine_chunks() if isinstance(d, pa.ChunkedArray) else d
            codes = codes * (len(d.dictionary) + 1) + d.indices.to_numpy(zero_copy_only=False)
        for j, m in enumerate(metrics):
            x = t.column(nk + j).to_numpy()
            ok = np.flatnonzero(np.isfinite(np.asarray(x, float)))
            if not len(ok):
                continue
            o = ok[np.lexsort((np.asarray(x, float)[ok], codes[ok]))]
            c, v = codes[o], np.asarray(x, float)[o]
            s = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            e = np.r_[s[1:], len(c)]
            first, level, vals, err = [], [], [], []
            big = e - s >= SIZE * FAN
            small_s, small_e = s[~big], e[~big]
            for a, z in zip(s[big], e[big]):
                raw, levels, er = compact_sketch(v[a:z], {}, 0.0)
                for k, y in [(0, raw), *[(k, y) for k, ys in levels.items() for y in ys]]:
                    first.append(o[a]), level.append(k), vals.append(y), err.append(er)
                    er = 0.0
            flat = np.concatenate([*[v[a:z] for a, z in zip(small_s, small_e)], *vals, np.empty(0)])
            length = np.r_[small_e - small_s, [len(y) for y in vals]].astype(np.int64)
            idx = pa.array(np.r_[o[small_s], np.array(first, np.int64)].astype(np.int64))
            cols = [t.column(i).take(idx).combine_chunks() for i in range(nk)]
            cols = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in cols]
            ns = len(small_s)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)].astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array([m] * len(length), pa.string()), pa.array(np.r_[np.zeros(ns, np.int32), np.array(level, np.int32)].astype(np.int32)), lists, pa.array(np.r_[np.zeros(ns), np.array(err, float)])],
                names=[*keys, "metric", "level", "vals", "err"],
            )

    out = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    made = df.select(*keys, *metrics).mapInArrow(run, f"{out}, metric string, {SKETCH}")
    # first level of the merge tree: a key's sketches meet in NODES tasks, so that its last task gets NODES of them, however many chunks there were
    made = made.withColumn("node", F.pmod(F.spark_partition_id(), F.lit(NODES)))
    return merged_sketches(made, [*keys, "metric", "node"]).drop("node")


def merged_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketch rows by ``keys`` (the metric among them): rows of one key become one sketch again."""
    kinds, nk = dict(sketches.dtypes), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in _whole_keys(batches, nk):
            flat, off, level, err, bound = _gather(t, starts, nk)
            rows, levels_, vals, errs = [], [], [], []
            for a, z in zip(bound[:-1], bound[1:]):
                raw, lv, er = _of_key(flat, off, level, err, a, z)
                for k, y in [(0, raw), *[(k, y) for k, ys in lv.items() for y in ys]]:
                    rows.append(a), levels_.append(k), vals.append(y), errs.append(er)
                    er = 0.0
            idx = pa.array(np.array(rows, np.int64))
            cols = [t.column(i).take(idx).combine_chunks() for i in range(nk)]
            cols = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in cols]
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(y) for y in vals])].astype(np.int32)), pa.array(np.concatenate([*vals, np.empty(0)])))
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.array(levels_, np.int32)), lists, pa.array(np.array(errs, float))], names=[*keys, "level", "vals", "err"])

    near = sketches.select(*keys, "level", "vals", "err").repartition(*keys).sortWithinPartitions(*keys)
    return near.mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", {SKETCH}")


def percentile_table(sketches: DataFrame, keys: list[str], percents: tuple = PERCENTS, clustered: bool = False) -> DataFrame:
    """``keys, n, p10 .., rank_error``: percentiles of each key's sketches and the largest possible error in ranks.

    A percentile p is the smallest value that at least p of the values don't exceed; its true rank lies within
    ``rank_error`` of that (0: exact).
    """
    kinds, nk = dict(sketches.dtypes), len(keys)
    names = [f"p{round(p * 100)}" for p in percents]
    ps = np.array(percents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in _whole_keys(batches, nk):
            flat, off, level, err, bound = _gather(t, starts, nk)
            code = np.repeat(np.arange(len(starts)), np.diff(bound))
            plain = ~np.isin(np.arange(len(starts)), np.unique(code[level > 0]))
            # keys of raw values only: all at once
            vc = np.repeat(code, np.diff(off))
            base = flat[off[0] : off[-1]]
            o = np.lexsort((base, vc))
            sv, n = base[o], np.bincount(vc, minlength=len(starts))
            at = np.r_[0, np.cumsum(n)][:-1]
            pick = at[:, None] + np.clip(np.ceil(ps[None, :] * n[:, None] - 1e-9).astype(int) - 1, 0, None)
            got = sv[np.minimum(pick, max(len(sv) - 1, 0))] if len(sv) else np.full((len(starts), len(ps)), np.nan)
            e = np.zeros(len(starts))
            plain &= n < SIZE * FAN  # more values than a sketch holds are collapsed, wherever they came from
            for i in np.flatnonzero(~plain):
                raw, lv, e[i] = _of_key(flat, off, level, err, bound[i], bound[i + 1])
                n[i], got[i] = sketch_percentiles(raw, lv, percents)
            idx = pa.array(starts.astype(np.int64))
            cols = [t.column(i).take(idx).combine_chunks() for i in range(nk)]
            cols = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in cols]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n.astype(np.int64)), *[pa.array(got[:, j]) for j in range(len(ps))], pa.array(e)], names=[*keys, "n", *names, "rank_error"])

    near = sketches.select(*keys, "level", "vals", "err")
    near = near if clustered else near.repartition(*keys).sortWithinPartitions(*keys)
    return near.mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n bigint, " + ", ".join(f"{x} double" for x in names) + ", rank_error double")


def daily_sketches(stats: DataFrame, source: str = "source_id", at: str = "eval_time", metrics: tuple = METRICS, merged: bool = True) -> DataFrame:
    """Sketches ``source, day, metric, level, vals, err`` of the finite readings, each clip counted once.

    Null, NaN and infinite readings don't count; a null source or time makes a group of its own. A day that holds a third of all rows
    sends one sketch per chunk to its task, not its rows. An empty table gives an empty result.
    """
    one = one_per_clip(stats, [source, at, *metrics]).select(F.col(source).alias("source_id"), F.to_date(at).alias("day"), *metrics)
    part = partial_sketches(one, ["source_id", "day"], list(metrics))
    return merged_sketches(part, ["source_id", "day", "metric"]) if merged else part


def daily_percentiles(stats: DataFrame, percents: tuple = PERCENTS, **columns) -> DataFrame:
    """Percentiles per source, day and metric."""
    return percentile_table(daily_sketches(stats, merged=False, **columns), ["source_id", "day", "metric"], percents)


def span_percentiles(daily: DataFrame, span: Column, percents: tuple = PERCENTS) -> DataFrame:
    """Percentiles per source, metric and span of days (say ``trunc(day, 'month')``) from daily sketches."""
    return percentile_table(daily.withColumn("span", span), ["source_id", "span", "metric"], percents)


def overall_percentiles(daily: DataFrame, percents: tuple = PERCENTS) -> DataFrame:
    """Percentiles per metric over all sources and days, from daily sketches."""
    return percentile_table(daily, ["metric"], percents)


def bound_check(stats: DataFrame, percents: tuple = PERCENTS, metrics: tuple = METRICS) -> DataFrame:
    """``metric, n, collapsed, within``: whether every overall percentile lies within its ``rank_error`` of the exact rank.

    The exact ranks of the estimates are counted over all readings; ``collapsed`` tells that buffers were collapsed, so that the bound is not 0.
    """
    got = checkpointed(overall_percentiles(daily_sketches(stats), percents))  # a row a metric
    one = one_per_clip(stats, ["clip_id", *metrics])
    x = one.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("x")) for m in metrics])).alias("r")).select("r.*").where("x is not null and not isnan(x) and abs(x) < double('inf')")
    names = [f"p{round(p * 100)}" for p in percents]
    j = x.join(F.broadcast(got), "metric")
    g = j.groupBy("metric", "n", "rank_error").agg(*[y for c in names for y in (F.count_if(F.col("x") < F.col(c)).alias(f"l_{c}"), F.count_if(F.col("x") <= F.col(c)).alias(f"u_{c}"))])
    ok = F.lit(True)
    for p, c in zip(percents, names):
        t = F.ceil(F.col("n") * p - 1e-9)
        ok = ok & (F.col(f"l_{c}") + 1 - F.col("rank_error") <= t) & (t <= F.col(f"u_{c}") + F.col("rank_error"))
    return g.select("metric", "n", (F.col("rank_error") > 0).alias("collapsed"), ok.alias("within"))
