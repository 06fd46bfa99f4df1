"""Queries of the problems in this subpackage; ``__spark_entry__`` adds them if it can be imported."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.llm import containers, mixing, overlap, percentiles, reading, splits
from framewright.session import checkpointed, load


def _assigned(s, d):
    return splits.assign_splits(load(s, d, "clips"), load(s, d, "sources"), load(s, d, "split_targets"))


def _levels(s, d):
    return reading.text_levels(load(s, d, "documents"), load(s, d, "doc_labels"))


def _drawn(s, d):
    return mixing.mix(load(s, d, "documents"), load(s, d, "mix_targets"))


def _filled(s, d):
    return containers.fill_containers(load(s, d, "documents"), load(s, d, "container_specs"))


QUERIES = {
    "p1_found": lambda s, d: overlap.cross_split_pairs(load(s, d, "clips")).selectExpr("least(train_pos, eval_pos) as pos_a", "greatest(train_pos, eval_pos) as pos_b"),
    "p1_overlap_report": lambda s, d: overlap.overlap_report(load(s, d, "clips")),
    "p1_coverage": lambda s, d: overlap.record_coverage(load(s, d, "clips")),
    "p3_daily_percentiles": lambda s, d: percentiles.daily_percentiles(load(s, d, "clip_quality_stats")),
    "p3_monthly_percentiles": lambda s, d: percentiles.span_percentiles(percentiles.daily_sketches(load(s, d, "clip_quality_stats")), F.trunc("day", "month")),
    "p3_overall_percentiles": lambda s, d: percentiles.overall_percentiles(percentiles.daily_sketches(load(s, d, "clip_quality_stats"))),
    "p3_bound_check": lambda s, d: percentiles.bound_check(load(s, d, "clip_quality_stats")),
    "p4_found": lambda s, d: splits.split_groups(load(s, d, "clips"), load(s, d, "sources")),
    "p4_groups": lambda s, d: splits.grouped(load(s, d, "clips"), load(s, d, "sources")).where("group_key is not null").groupBy("root_source", "group_key").agg(F.count("*").alias("records")),
    "p4_assignment": _assigned,
    "p4_split_report": lambda s, d: splits.split_report(_assigned(s, d), load(s, d, "split_targets")),
    "p7_containers": lambda s, d: _filled(s, d),
    "p7_fill_report": lambda s, d: containers.fill_report(_filled(s, d)),
    "p7_fill_check": lambda s, d: containers.fill_check(checkpointed(_filled(s, d))),
    "p8_draw": _drawn,
    "p8_shares": lambda s, d: mixing.shares(checkpointed(_drawn(s, d)), load(s, d, "mix_targets")),
    "p9_found": lambda s, d: reading.demanding(_levels(s, d).where("is_english_prose")),
    "p9_levels": _levels,
    "p9_accuracy": lambda s, d: reading.held_out_accuracy(load(s, d, "documents"), load(s, d, "doc_labels")),
    "p9_profile": lambda s, d: reading.profile(load(s, d, "documents"), checkpointed(_levels(s, d))),
}

def _percentile_sql(span: str, name: str) -> str:
    """Exact percentiles, which the sketches give as long as a group holds fewer values than a sketch does."""
    ps = ", ".join(f"quantile_disc(x, {p}) as p{round(p * 100)}" for p in percentiles.PERCENTS)
    one = "select clip_id, arg_min(struct_pack(source_id, eval_time, " + ", ".join(percentiles.METRICS) + "), stat_id) as r from clip_quality_stats group by clip_id"
    long = " union all ".join(f"select r.source_id as source_id, {span} as {name}, '{m}' as metric, r.{m} as x from one" for m in percentiles.METRICS)
    return f"with one as ({one}), l as ({long}) select source_id, {name}, metric, count(*) as n, {ps}, 0.0::double as rank_error from l where isfinite(x) group by source_id, {name}, metric"


def _bound_sql() -> str:
    """Readings per metric; from one sketch's worth of raw values on, buffers must have been collapsed."""
    one = "select clip_id, arg_min(struct_pack(" + ", ".join(percentiles.METRICS) + "), stat_id) as r from clip_quality_stats group by clip_id"
    long = " union all ".join(f"select '{m}' as metric, r.{m} as x from one" for m in percentiles.METRICS)
    return f"with one as ({one}), l as ({long}) select metric, count(*) as n, count(*) >= {percentiles.SIZE * percentiles.FAN} as collapsed, true as within from l where isfinite(x) group by metric"


_GROUPS = r"""with c as (select coalesce(parent_source_id, s.source_id, clips.source_id) as root_source, group_id, descriptor.root_dir as rd, lower(trim(split)) as sp from clips left join sources s on s.source_id = clips.source_id),
g as (select root_source, nullif(regexp_replace(regexp_replace(lower(case when coalesce(regexp_replace(group_id, '[\s/]+', '', 'g'), '') <> '' then group_id else regexp_extract(rtrim(rd, '/ '), '([^/]+)$', 1) end), '[\s/]+', '', 'g'), '[-_.]+', '_', 'g'), '') as group_key,
case when sp in ('train', 'training') then 'train' when sp in ('val', 'valid', 'validation') then 'validation' when sp in ('test', 'testing') then 'test' end as sp from c)"""

ORACLES: dict[str, str] = {
    "p3_daily_percentiles": _percentile_sql("cast(r.eval_time as date)", "day"),
    "p3_monthly_percentiles": _percentile_sql("cast(date_trunc('month', r.eval_time) as date)", "span"),
    "p3_bound_check": _bound_sql(),
    "p7_fill_check": "select spec_id, count(*) as texts, cast(0 as bigint) as bad_containers, cast(0 as bigint) as cut_texts, true as near_bound from documents, container_specs where text <> '' and capacity_tokens > 0 group by spec_id",
    "p4_found": f"{_GROUPS} select root_source, group_key from g where sp is not null and group_key is not null and root_source is not null group by all having count(distinct sp) > 1",
    "p4_groups": f"{_GROUPS} select root_source, group_key, count(*) as records from g where group_key is not null group by all",
}
