"""Structured Streaming counterparts of the windowed rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", "events*.parquet").parquet(folder)


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """start, event_type, n, total per window: repeated event ids within the watermark count once; state older than it is dropped."""
    x = events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    g = x.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """user_id, start, end, n per session."""
    g = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
