"""Stream sources: message topics and change events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.sources.schemas import MESSAGE_SCHEMA

CHANGE_OPS = ("c", "u", "d", "r")


def kafka_options(servers: str, topics: str, starting: str = "earliest", **options: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topics, "startingOffsets": starting, **options}


def read_events(spark: SparkSession, options: dict[str, str], fmt: str = "kafka",
                schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """A stream of messages with the columns key, value, topic, timestamp; key and value as text.

    `fmt="kafka"` takes `kafka_options(...)`; a file format takes `{"path": folder}` and gives the same columns.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(schema)
    messages = reader.load()
    return messages.withColumns({c: F.col(c).cast("string") for c in ("key", "value") if c in messages.columns})


def parse_cdc(messages: DataFrame, row_schema: T.StructType) -> DataFrame:
    """Decode change events `{op, before, after, ts_ms}` from `value`.

    Gives `op`, `ts_ms`, `change_time`, the fields of the row (its new state, or the old one for a delete),
    `parse_error` (NULL for a sound event, else what is wrong), and the message's own columns as `message_key`,
    `message_value` and so on, for the dead-letter side.
    """
    clash = {"op", "ts_ms", "change_time", "parse_error", *[f"message_{c}" for c in messages.columns]} & set(row_schema.names)
    if clash:
        raise ValueError(f"row fields clash with event columns: {', '.join(sorted(clash))}")
    envelope = T.StructType([
        T.StructField("op", T.StringType()), T.StructField("before", row_schema),
        T.StructField("after", row_schema), T.StructField("ts_ms", T.LongType()),
        T.StructField("_corrupt", T.StringType())])
    value = F.col("message_value")
    event = F.from_json(value, envelope, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # A generator, because a filter on its columns is not pushed below it: pushed below a projection, a filter
    # on `parse_error` would parse the message again for each field it looks at.
    decoded = messages.select(*[F.col(c).alias(f"message_{c}") for c in messages.columns]).select("*", F.inline(F.array(event)))
    state = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    error = (F.when(value.isNull(), "no value")
             .when(F.col("_corrupt").isNotNull() | (F.trim(value) == ""), "not readable as JSON")
             .when(F.col("op").isNull() | ~F.col("op").isin(*CHANGE_OPS), "unknown operation")
             .when(F.col("ts_ms").isNull(), "no change time")
             .when(state.isNull(), "no row"))
    return decoded.select(
        *[f"message_{c}" for c in messages.columns], "op", "ts_ms", F.timestamp_millis("ts_ms").alias("change_time"),
        *[state.getField(name).alias(name) for name in row_schema.names], error.alias("parse_error"))
