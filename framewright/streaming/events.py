"""Event logs as streams: parsing, running state, stalls and windowed statistics with late data."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from framewright.functions.text import iso_time
from framewright.operators.monitor import EVENT, STATES


def read_events(spark: SparkSession, path: str, per_trigger: int = 1) -> DataFrame:
    """Event lines appended as files to a folder, as a stream; malformed lines are dropped."""
    lines = spark.readStream.option("maxFilesPerTrigger", per_trigger).text(path)
    e = lines.where(F.try_parse_json("value").isNotNull()).select(F.from_json("value", EVENT).alias("e")).select("e.*")
    return e.withColumn("at", iso_time(F.col("time")))


def stage_windows(events: DataFrame, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Results and mean wall seconds per stage and event-time window; events later than ``late`` behind the newest are dropped."""
    e = events.where(F.col("event").isin(*STATES) & F.col("at").isNotNull()).withWatermark("at", late)
    g = e.groupBy(F.window("at", window).alias("w"), "stage").agg(F.count_if(F.col("event") == "stage_success").alias("success"), F.count_if(F.col("event") == "stage_failure").alias("failure"), F.avg("wall_sec").alias("avg_sec"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "stage", "success", "failure", "avg_sec")


def running_states(events: DataFrame, stall_seconds: int = 1800) -> DataFrame:
    """``video, stage, status, failures`` whenever a result arrives, and ``stalled`` once none came for ``stall_seconds`` of processing time."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        failures, status = state.get if state.exists else (0, "pending")
        if state.hasTimedOut:
            state.remove()
            if status != "completed":
                yield pd.DataFrame({"video": [key[0]], "stage": [key[1]], "status": ["stalled"], "failures": [failures]})
            return
        for p in batches:
            for ev in p.sort_values("at", na_position="first", kind="stable")["event"]:
                failures += ev == "stage_failure"
                status = STATES[ev]
        state.update((int(failures), status))
        state.setTimeoutDuration(stall_seconds * 1000)
        yield pd.DataFrame({"video": [key[0]], "stage": [key[1]], "status": [status], "failures": [int(failures)]})

    e = events.where(F.col("event").isin(*STATES)).select("video", "stage", "event", "at")
    return e.groupBy("video", "stage").applyInPandasWithState(step, "video string, stage string, status string, failures bigint", "failures bigint, status string", "update", GroupStateTimeout.ProcessingTimeTimeout)


def append_events(rows: DataFrame, path: str) -> None:
    """Append event rows as JSON lines."""
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("append").text(path)
