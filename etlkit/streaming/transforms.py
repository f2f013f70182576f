"""Transforms that work on a stream and, without their watermark, on a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the analytics table holds beside the event time.
SERVED_DIMENSIONS = ["patient_id", "event_type", "provider_id"]


def with_event_time(df: DataFrame, column: str = "event_time") -> DataFrame:
    """The event time as TIMESTAMP, which watermarks need; text that is no ISO time becomes NULL."""
    kind = df.schema[column].dataType
    parsed = F.try_to_timestamp(F.col(column)) if isinstance(kind, T.StringType) else F.col(column).cast("timestamp")
    return df.withColumn(column, parsed)


def dedup_events(df: DataFrame, keys: list[str], event_time: str = "event_time", delay: str = "1 hour",
                 spread: int = 16) -> DataFrame:
    """First arrival per key; repeats within `delay` of event time are dropped and older keys are forgotten,
    so the state holds no more than the keys of that span.

    The copies of one event may be many. On a stream nothing combines them before they are shuffled, so they
    are first reduced in `spread` groups, by the task that read them, and only what is left of each group
    meets. `spread=1` leaves that step out, which saves a shuffle where copies are few.
    """
    timed = with_event_time(df, event_time)
    if not df.isStreaming:
        return timed.dropDuplicates(keys)
    timed = timed.withWatermark(event_time, delay)
    if spread > 1:
        grouped = timed.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(spread)))
        timed = grouped.dropDuplicatesWithinWatermark([*keys, "_group"]).drop("_group")
    return timed.dropDuplicatesWithinWatermark(keys)


def event_rollup(df: DataFrame, dimensions: list[str], every: str, event_time: str = "event_time",
                 slide: str | None = None, delay: str = "1 hour", values: list[str] = ()) -> DataFrame:
    """Events per time window and dimension: window_start, window_end, dimensions, events, sum_{v}.

    Tumbling windows of length `every`, or sliding by `slide`. Rows later than `delay` behind the newest event
    are dropped, which the query progress counts.
    """
    timed = with_event_time(df, event_time)
    if df.isStreaming:
        timed = timed.withWatermark(event_time, delay)
    window = F.window(event_time, every, slide) if slide else F.window(event_time, every)
    grouped = timed.groupBy(window.alias("w"), *dimensions).agg(
        F.count(F.lit(1)).alias("events"), *[F.sum(v).alias(f"sum_{v}") for v in values])
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *dimensions,
                          "events", *[f"sum_{v}" for v in values])


def served_columns(df: DataFrame, event_time: str = "event_time",
                   dimensions: list[str] = SERVED_DIMENSIONS) -> DataFrame:
    """Event time, dimensions, and the event's day to partition by. Events without a readable time are dropped
    here; route them to the dead-letter side first with a rule on the time."""
    timed = with_event_time(df, event_time).where(F.col(event_time).isNotNull())
    return timed.select(event_time, *dimensions, F.to_date(event_time).alias("event_day"))


def to_message(df: DataFrame, key: str | None = None) -> DataFrame:
    """One message per row: `key` and the whole row as JSON in `value`."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select((F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"), value)
