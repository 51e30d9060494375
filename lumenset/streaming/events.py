"""Windowed counts and first-seen ids; the same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed(events: DataFrame, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events and their value per window and type; as a stream, windows close `late` after the newest event."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    out = rows.groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
    return out.select(F.col("window.start").alias("window_start"), "event_type", "events", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Events per user and session."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("events")).select(F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "user_id", "events")


def distinct_items(items: DataFrame, keys: list[str], time: str = "ts", late: str = "1 day") -> DataFrame:
    """The first item of each key within the watermark: exact deduplication of a stream in bounded state."""
    if not items.isStreaming:
        return items.dropDuplicates(keys)
    return items.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def read(spark, path: str, schema) -> DataFrame:  # noqa: ANN001
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def write(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
