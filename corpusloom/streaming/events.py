"""Windows and sessions over event streams; the same code serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _on_time(events: DataFrame, late: str) -> DataFrame:
    """A stream with its watermark, which needs instants; a batch as it is."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def windowed(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """Events and mean value by window and type; a stream drops what is later than ``late``."""
    events = _on_time(events, late)
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    g = events.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "events", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of users: events no further apart than ``gap``."""
    events = _on_time(events, late)
    g = events.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("events"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")
