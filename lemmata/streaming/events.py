"""Structured Streaming over stage events: the same shapes as the batch queries, with watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, schema: str, files: int = 100, fmt: str = "parquet") -> DataFrame:
    """A file source, read in micro-batches of at most ``files`` files."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files).load(path)


def timed(events: DataFrame, late: str) -> DataFrame:
    """A watermark needs an instant; local times are read in the session's zone."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def tumbling_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    t = timed(events, late).groupBy(F.window("ts", width).alias("w"), "event_type")
    return t.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding_counts(events: DataFrame, width: str = "1 hour", slide: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    return timed(events, late).groupBy(F.window("ts", width, slide).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "10 minutes") -> DataFrame:
    t = timed(events, late).groupBy("user_id", F.session_window("ts", gap).alias("w"))
    return t.agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def first_seen(events: DataFrame, key: str = "fingerprint") -> DataFrame:
    """The duplicate index as a stream: each key once, over all micro-batches."""
    return events.dropDuplicates([key])


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there, then stop; restarts go on from the checkpoint."""
    stream.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
