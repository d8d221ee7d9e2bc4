"""Extension: event streams.  The reference has no streaming; these are its aggregates for late, growing data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def _watermarked(events: DataFrame, late: str) -> DataFrame:
    """Watermarks need an instant: timestamps without a zone are taken in the session's zone."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def windowed_counts(events: DataFrame, length: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events and cents by window and type; with a stream, windows close once the watermark has passed."""
    if events.isStreaming:
        events = _watermarked(events, late)
    got = events.groupBy(F.window("ts", length), "event_type").agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))
    return got.select(F.col("window.start").alias("start"), "event_type", "n", "cents")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "2 days") -> DataFrame:
    """Sessions of a user: runs of events with no gap longer than ``gap``."""
    if events.isStreaming:
        events = _watermarked(events, late)
    got = events.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return got.select("user_id", F.col("session_window.start").alias("start"), "n")


def once(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Each event id once; the state of ids older than the watermark is dropped."""
    return _watermarked(events, late).dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else events.dropDuplicates(["event_id"])
