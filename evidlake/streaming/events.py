"""Structured Streaming over the event log (an extension: the batch pipeline has no unbounded source)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read(spark: SparkSession, path: str, pattern: str = "events*.parquet") -> DataFrame:
    df = spark.readStream.schema(SCHEMA).option("pathGlobFilter", pattern).parquet(path)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, every: str = "1 day", slide: str | None = None, late: str = "2 days") -> DataFrame:
    """Counts and sums per window and type, tumbling or sliding; rows later than the watermark are dropped."""
    w = F.window("ts", every, slide) if slide else F.window("ts", every)
    g = (events.withWatermark("ts", late) if events.isStreaming else events).groupBy(w, "event_type")
    return g.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str | Column = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions per user: events closer than the gap belong together."""
    src = events.withWatermark("ts", late) if events.isStreaming else events
    g = src.groupBy("user_id", F.session_window("ts", gap)).agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def first_of(events: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key within the watermark: content-hash deduplication of a stream."""
    return events.withWatermark("ts", "2 days").dropDuplicatesWithinWatermark(keys)
