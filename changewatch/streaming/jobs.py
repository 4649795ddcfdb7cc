"""Incremental jobs. Watermarks ask for event times with a zone; they are read as UTC whatever the zone of
the session is, and days and delays are taken from them without it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from changewatch.functions.values import editor_name, epoch_seconds


def _timed(df: DataFrame, source: str, name: str) -> DataFrame:
    return df.withColumn(name, F.timestamp_seconds(epoch_seconds(F.col(source))))


def _utc_date(time: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86400).cast("int"))


def daily_activity(changes: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Streaming (date, series, n) by kind of editor, from columns ``time`` and ``actor_user``. A day
    is final once the watermark has passed its end."""
    day = F.window("event_time", "1 day")
    return (
        _timed(changes, "time", "event_time").withWatermark("event_time", lateness)
        .groupBy(day.alias("day"), editor_name(F.col("actor_user")).alias("series"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(_utc_date(F.col("day.start")).alias("date"), "series", "n")
    )


def review_delay(changes: DataFrame, log: DataFrame, within: str = "31 days",
                 lateness: str = "1 hour", before: str = "0 seconds") -> DataFrame:
    """Streaming join of changes (rc_id, rc_this_oldid, time) and patrol entries (rc_curid, log_time):
    the delay of each review, and null for a change that has none ``within`` the time limit. The
    limit bounds the state: a change is given up when the watermark has passed it. A review is taken
    up to ``before`` ahead of its change; the batch job takes it however early, with a negative delay."""
    edits = _timed(changes.select("rc_id", "rc_this_oldid", "time"), "time", "event_time") \
        .withWatermark("event_time", lateness)
    reviews = _timed(log.select("rc_curid", "log_time"), "log_time", "review_time") \
        .withWatermark("review_time", lateness)
    condition = (
        (F.nullif("rc_this_oldid", F.lit(0)) == F.col("rc_curid"))
        & (F.col("review_time") >= F.col("event_time") - F.expr(f"INTERVAL {before}"))
        & (F.col("review_time") <= F.col("event_time") + F.expr(f"INTERVAL {within}"))
    )
    return edits.join(reviews, condition, "left_outer").select(
        "rc_id", "rc_this_oldid", "time", "log_time",
        (F.unix_seconds("review_time") - F.unix_seconds("event_time")).alias("delay_seconds"))


def follow(spark: SparkSession, source: str, schema: StructType) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).parquet(source)


def start(result: DataFrame, sink: str, state: str, every: str | None = None) -> StreamingQuery:
    """Append the final rows of a job to a folder of Parquet files, each once. ``state`` is the folder of its progress,
    shared by all machines. Without ``every``, an interval, it works off what there is and ends."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return result.writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", state).trigger(**trigger).start(sink)
