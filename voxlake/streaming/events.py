"""Structured Streaming over the events table: windowed counts with late data, sessions, and task run times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def windowed(events: DataFrame, *, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total) in tumbling windows; events later than `late` behind the newest are dropped in a stream."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    return events.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, *, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """(user_id, start, end, n): a user's events with no gap as long as `gap`."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    told = events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return told.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def task_times(events: DataFrame, task: str, start: str, end: str) -> DataFrame:
    """(task, start, end, micros): a task's last start and the first end after it; a new start makes earlier ends void."""
    began = events.where(F.col("event_type") == start).groupBy(task).agg(F.max("ts").alias("start"))
    ended = events.where(F.col("event_type") == end).select(task, F.col("ts").alias("end"))
    done = ended.join(began, task).where(F.col("end") > F.col("start")).groupBy(task, "start").agg(F.min("end").alias("end"))
    return done.select(task, "start", "end", F.timestamp_diff("MICROSECOND", F.col("start"), F.col("end")).alias("micros"))
