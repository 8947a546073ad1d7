"""Structured Streaming: event windows and idempotent appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet") -> DataFrame:
    """Events as they arrive in a folder, with ts as a timestamp that watermarks take."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def daily_counts(events: DataFrame, late: str = "7 days") -> DataFrame:
    """Events and their total value by day and kind, closed once the watermark has passed."""
    day = F.window("ts", "1 day")
    return events.withWatermark("ts", late).groupBy(day.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(
        F.col("w.start").alias("day"), "event_type", "n", "total"
    )


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "7 days") -> DataFrame:
    """Sessions of each user: runs of events with pauses under ``gap``."""
    s = F.session_window("ts", gap)
    return events.withWatermark("ts", late).groupBy(s.alias("w"), "user_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user_id", "n")


def run_available(stream: DataFrame, target: str, checkpoint: str, key: list[str], mode: str = "complete") -> None:
    """Process what there is and stop.

    A batch writes a folder of its own number, so a batch that is run again after a failure replaces its own
    output: appends are idempotent.  In complete mode every batch replaces the whole table.
    """

    def write(batch: DataFrame, number: int) -> None:
        where = target if mode == "complete" else f"{target}/batch={number}"
        batch.dropDuplicates(key).write.mode("overwrite").parquet(where)

    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
