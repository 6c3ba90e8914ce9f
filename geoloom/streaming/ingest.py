"""Streaming ingestion that drains what is there and stops, and counts over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet folder as a stream of its new files."""
    return spark.readStream.schema(schema).parquet(path)


def drain_to(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all that is new since the checkpoint, then stop. A repeated call adds nothing."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def windowed_counts(events: DataFrame, *, at: str, size: str, late: str, keys: tuple[str, ...] = (), slide: str | None = None) -> DataFrame:
    """Events per window and key; rows later than the watermark are left out on a stream.

    With slide, windows of length size begin every slide and overlap: an event counts in each.
    """
    return events.withWatermark(at, late).groupBy(F.window(F.col(at), size, slide), *keys).count().select(F.col("window.start").alias("window_start"), *keys, "count")
