"""Streams: file ingestion with de-duplication, latest state, windowed counts of late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, folder: str, pattern: str, schema: str, time: str) -> DataFrame:
    """A file stream whose time column is a timestamp, as watermarks need one with a zone."""
    files = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return files.withColumn(time, F.col(time).cast("timestamp"))


def deduplicated(events: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, time: str, width: str, *group: str, late: str = "1 hour") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.window(time, width), *group).agg(F.count("*").alias("n"))


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there and stops; a second run goes on from the checkpoint."""
    query = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
