"""Extensions over event streams: watermarked windows, sessions, deduplication, and an incremental claim sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums a window and type; events later than the watermark are dropped by the engine."""
    return (
        events.withWatermark("ts", late).groupBy(F.window("ts", length), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("v"))
        .select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "v")
    )


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """A row per user's session: stretches without a pause of `gap`."""
    return (
        events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "user_id")
        .agg(F.count("*").alias("n")).select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")
    )


def once(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Each event_id once within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def append_claims(stream: DataFrame, path: str, checkpoint: str):
    """Claims of each micro-batch go to a folder of their own number, so a repeated batch overwrites itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
