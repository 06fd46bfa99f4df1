"""Run state from event logs: replay, health, stage statistics, pending work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.text import iso_time
from framewright.session import guarded_join

EVENT = "time string, event string, video string, stage string, gpu string, wall_sec double, metrics string, error string, total bigint, attempt int, success bigint, failed bigint"
#: Events that set a stage's state.
STATES = {"stage_success": "completed", "stage_failure": "failed"}


def parsed_events(lines: DataFrame, pos: str = "pos", text: str = "value") -> DataFrame:
    """Event lines (``pos, value``) as columns with ``malformed``; blank lines are dropped, bad ones are kept and marked."""
    t = F.col(text)
    v = F.from_json(t, EVENT, {"mode": "PERMISSIVE"})
    ok = F.coalesce(F.schema_of_variant(F.try_parse_json(t)).startswith("OBJECT"), F.lit(False))
    return lines.where(F.trim(t) != "").select(pos, v.alias("e"), (~ok).alias("malformed")).select(pos, "malformed", "e.*").withColumn("at", iso_time(F.col("time")))


def replayed(events: DataFrame, videos: DataFrame, stages: list[str] | None = None, pos: str = "pos") -> DataFrame:
    """``video, stage, status, failures, error``: the last result per video and stage; ``pending`` where there is none.

    Stages of the log that aren't listed are added. Malformed lines and other events set no state.
    """
    e = events.where(~F.col("malformed") & F.col("event").isin(*STATES) & F.col("video").isNotNull() & F.col("stage").isNotNull())
    state = F.when(F.col("event") == "stage_success", "completed").otherwise("failed")
    last = e.groupBy("video", "stage").agg(F.max_by(F.struct(state.alias("status"), "error"), pos).alias("l"), F.count_if(state == "failed").alias("failures")).select("video", "stage", "l.status", "failures", "l.error")
    names = last.select("stage").distinct()
    if stages:
        names = names.unionByName(videos.sparkSession.createDataFrame([(s,) for s in stages], "stage string")).distinct()
    allv = videos.select("video").unionByName(last.select("video")).distinct()
    grid = allv.crossJoin(F.broadcast(names))  # stages are a handful
    return grid.join(last, ["video", "stage"], "left").na.fill("pending", ["status"]).na.fill(0, ["failures"])


def status_with_fallback(stored: list[DataFrame | None], replay: DataFrame) -> DataFrame:
    """State of a run from the first of ``stored`` (the status file, then its backup: ``video, stage, status, failures, error``) that has rows
    and no malformed one (null video, stage or status); else by replay of the event log.
    """
    for s in stored:
        if s is None:
            continue
        r = s.agg(F.count("*").alias("n"), F.count_if(F.col("video").isNull() | F.col("stage").isNull() | F.col("status").isNull()).alias("bad")).first()
        if r["n"] and not r["bad"]:
            return s.select(*replay.columns)
    return replay


def video_states(status: DataFrame) -> DataFrame:
    """Per video: completed if all stages are, failed if any is, partial if some are completed, else pending."""
    g = status.groupBy("video").agg(F.bool_and(F.col("status") == "completed").alias("a"), F.bool_or(F.col("status") == "failed").alias("f"), F.bool_or(F.col("status") == "completed").alias("s"))
    return g.select("video", F.when(F.col("a"), "completed").when(F.col("f"), "failed").when(F.col("s"), "partial").otherwise("pending").alias("state"))


def health(total: Column, completed: Column, failed: Column, partial: Column, running: Column, age_sec: Column, stall: int = 1800) -> Column:
    """State of a run; a run with open work and no event for ``stall`` seconds is stalled."""
    open_ = completed + failed < total
    return F.when(total == 0, "empty").when(completed == total, "done").when(~open_ & (failed > 0), "failed").when(open_ & (age_sec > stall), "stalled").when(running > 0, "running").when((completed > 0) | (partial > 0), "partial").otherwise("running")


def run_summary(status: DataFrame, events: DataFrame, now: Column, stall: int = 1800, pos: str = "pos") -> DataFrame:
    """One row: videos by state, malformed lines, time of the last valid event, its age and the run's health."""
    s = video_states(status).agg(F.count("*").alias("total"), *[F.count_if(F.col("state") == k).alias(k) for k in ("completed", "failed", "partial", "pending")])
    e = events.agg(F.count_if("malformed").alias("malformed"), F.max_by("at", F.when(F.col("at").isNotNull(), F.col(pos))).alias("last_event"))
    d = s.crossJoin(e).withColumn("age_sec", F.unix_seconds(now) - F.unix_seconds("last_event"))
    c = F.col
    return d.withColumn("health", health(c("total"), c("completed"), c("failed"), c("partial"), F.lit(0), F.coalesce(c("age_sec"), F.lit(stall + 1)), stall))


def stage_stats(events: DataFrame) -> DataFrame:
    """Per stage: successes, failures, and least, mean and most wall seconds of results that state them."""
    e = events.where(F.col("event").isin(*STATES) & F.col("stage").isNotNull())
    return e.groupBy("stage").agg(F.count_if(F.col("event") == "stage_success").alias("success"), F.count_if(F.col("event") == "stage_failure").alias("failure"), F.min("wall_sec").alias("min_sec"), F.avg("wall_sec").alias("avg_sec"), F.max("wall_sec").alias("max_sec"))


def event_counts(events: DataFrame) -> DataFrame:
    return events.where(F.col("event").isNotNull()).groupBy("event").agg(F.count("*").alias("n"))


def pending_work(status: DataFrame, stage: str, before: str | None, markers: DataFrame | None = None) -> DataFrame:
    """Videos for which ``stage`` is pending or failed, the stage before it is completed, and no done marker exists."""
    mine = status.where((F.col("stage") == stage) & F.col("status").isin("pending", "failed")).select("video")
    if before:
        mine = mine.join(status.where((F.col("stage") == before) & (F.col("status") == "completed")).select("video"), "video", "left_semi")
    return mine.join(markers.where(F.col("stage") == stage).select("video"), "video", "left_anti") if markers is not None else mine


def resumed(status: DataFrame, markers: DataFrame) -> DataFrame:
    """States at resume: a done marker completes a stage, and what was still running is pending again."""
    m = markers.select("video", "stage", F.lit(True).alias("__m")).distinct()
    d = status.join(m, ["video", "stage"], "left")
    return d.withColumn("status", F.when(F.col("__m"), "completed").when(F.col("status") == "running", "pending").otherwise(F.col("status"))).drop("__m")


def completed_manifest(manifest: DataFrame, status: DataFrame, stage: str, markers: DataFrame | None = None) -> DataFrame:
    """Manifest records whose ``stage`` is completed, matched by ``video_key`` and, failing that, by ``clip_id``."""
    done = status.where(F.col("stage") == stage).groupBy("video").agg(F.bool_or(F.col("status") == "completed").alias("ok"))
    if markers is not None:
        done = done.unionByName(markers.where(F.col("stage") == stage).select("video", F.lit(True).alias("ok"))).groupBy("video").agg(F.bool_or("ok").alias("ok"))
    a, b = done.toDF("video_key", "__a"), done.toDF("clip_id", "__b")
    d = manifest.join(a, "video_key", "left").join(b, "clip_id", "left")
    return d.where(F.coalesce("__a", "__b", F.lit(False))).select(*manifest.columns)


def produced(manifest: DataFrame, outputs: DataFrame, key: str = "clip_id", missing: bool = False) -> DataFrame:
    """Manifest records that have (or with ``missing``, don't have) an output."""
    return manifest.join(outputs.select(key).distinct(), key, "left_anti" if missing else "left_semi")


def newest_range(ranges: DataFrame, clip: str = "clip_id") -> DataFrame:
    """Track range with the latest end, then start, per clip."""
    return ranges.groupBy(clip).agg(F.max_by(F.struct("start", "end"), F.struct("end", "start")).alias("r")).select(clip, "r.*")


def recent_runs(runs: DataFrame, at: str = "last_event", limit: int = 12) -> DataFrame:
    """Runs by their last event, newest first; runs without event last, then by name."""
    return runs.orderBy(F.col(at).desc_nulls_last(), "run").limit(limit)


def with_lookup(df: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    """Left join with a table expected to be small, its size checked."""
    return guarded_join(df, lookup, on)
