"""Cleaning and daily repository activity over hourly files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitals import schemas
from vitals.functions.aggregates import type_counts
from vitals.operators.cleaning import flatten_events

DELAY = "2 days"


def stream_raw_events(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Hourly JSON-lines files of a folder; each batch takes a bounded number of files."""
    return (
        spark.readStream.schema(schemas.CLEANING_EVENT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )


def stream_clean_events(raw: DataFrame, delay: str = DELAY) -> DataFrame:
    """Cleaned events without repeats; state is bounded by the watermark delay."""
    return (
        flatten_events(raw.filter(F.col("type").isin(*schemas.CORE_EVENT_TYPES)))
        .filter(F.col("event_ts").isNotNull() & F.col("repo_name").isNotNull())
        .withWatermark("event_ts", delay)
        .dropDuplicatesWithinWatermark(["event_id"])
    )


def stream_repo_days(events: DataFrame) -> DataFrame:
    """Activity per repository and day; distinct actors are approximate in a stream."""
    day = F.window("event_ts", "1 day")
    return (
        events.groupBy(day.alias("day"), "repo_name")
        .agg(
            *type_counts(),
            F.approx_count_distinct("actor_login", 0.01).alias("distinct_actors"),
            F.count("event_id").alias("total_events"),
        )
        .withColumn("event_date", F.to_date("day.start"))
        .drop("day")
    )


def write_stream(df: DataFrame, path: str, checkpoint: str, by: str | None = None) -> StreamingQuery:
    """Process everything available, exactly once, and stop.

    Append mode emits a day after the watermark has passed it, so the youngest
    days stay in the checkpoint until later events close them.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
    )
    return (writer.partitionBy(by) if by else writer).start()
