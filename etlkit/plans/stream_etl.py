"""Change stream to served events: drop repeats, decode, validate, write all sides, roll up, publish."""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.operators.rules import RowRule, Rule, expr_rule
from etlkit.operators.split import with_outcome
from etlkit.operators.suite import raise_on_failure, run_suite
from etlkit.plans.runlog import RunLog
from etlkit.sinks.files import Folders, stream_id
from etlkit.sinks.tables import LATE, VALID, read_outcome, write_outcomes
from etlkit.sources.schemas import CLINICAL_EVENT_SCHEMA
from etlkit.streaming.sinks import CADENCE, replace_batch, replace_part, write_batches  # noqa: F401
from etlkit.streaming.sources import parse_cdc
from etlkit.streaming.transforms import SERVED_DIMENSIONS, event_rollup, to_message, with_event_time


@dataclass(frozen=True)
class StreamRun:
    run_id: str
    batches: int
    read: int
    valid: int
    rejected: int
    late: int
    repeats: int


@dataclass(frozen=True)
class RollupTo:
    """Where the counts of valid events go: one set per batch, which `streaming.read_rollup_parts` adds up."""
    path: str
    dimensions: list[str]
    every: str = "1 hour"


@dataclass(frozen=True)
class Topic:
    """Where valid events are published: a connector's topic, or files under options["path"], one folder per batch."""
    fmt: str
    options: dict[str, str]
    key: str | None = None

    def publish(self, messages: DataFrame, stream: str, batch_id: int) -> None:
        options = dict(self.options)
        if "path" in options:
            options["path"] = f"{options['path'].rstrip('/')}/stream={stream}/batch_id={batch_id}"
        messages.write.format(self.fmt).options(**options).mode("overwrite" if "path" in options else "append").save()


def decoded_events(messages: DataFrame, row_schema: T.StructType = CLINICAL_EVENT_SCHEMA,
                   event_time: str = "event_time") -> DataFrame:
    """Change events with the event time as TIMESTAMP, and the day they belong to: that of the event, or of
    the message's arrival for events that cannot be read or have no time."""
    events = with_event_time(parse_cdc(messages, row_schema), event_time)
    return events.withColumn("event_day", F.to_date(F.coalesce(event_time, "message_timestamp")))


METRICS = "batch_id long, read long, valid long, rejected long, late long, repeats long, newest timestamp"


def _message_id(columns: list[str] | None) -> Column:
    """What makes two messages the same: the named columns, or key and value. NULL, so like no other, if the columns
    are all NULL or the value is."""
    named = columns or ["key", "value"]
    nothing = reduce(operator.and_, [F.col(c).isNull() for c in (columns or ["value"])])
    return F.when(~nothing, F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in named])), 256))


def run_stream_etl(spark: SparkSession, messages: DataFrame, rules: list[RowRule], path: str, checkpoint: str,
                   row_schema: T.StructType = CLINICAL_EVENT_SCHEMA, event_time: str = "event_time",
                   keys: list[str] | None = None, delay: str = "1 hour", as_of=None, every: str | None = None,
                   run_log_path: str | None = None, rollup: RollupTo | None = None, topic: Topic | None = None,
                   suite: list[Rule] = ()) -> StreamRun | None:
    """One streaming query. With `every=None` it works off what is there, as one scheduled run, and reports;
    with an interval such as CADENCE it keeps running and returns the query.

    No message vanishes: valid + rejected + late + repeats = read, per batch and in all. Messages of one id, by
    `keys` or else by key and value, count once while the first lies within `delay` of the newest message; messages
    without a value are never taken for repeats of one another. A message more than `delay` behind the newest of
    earlier batches can no longer be told from a repeat: it goes to the side `late`, undecided. What fails a
    rule, or is no sound change event, goes to the dead-letter side with the raw message.

    Valid events are also rolled up (`rollup`) and published (`topic`), and held to the table-wide rules of `suite`,
    whose failure stops the stream before the batch counts as done. Everything written is keyed by this checkpoint's
    stream and the batch, so a repeated batch replaces itself. Ids and metrics of the batches lie in the checkpoint.
    """
    sound = expr_rule("sound_event", F.col("parse_error").isNull())
    stream = stream_id(spark, checkpoint)
    seen_path, metrics_path = f"{checkpoint.rstrip('/')}/seen", f"{checkpoint.rstrip('/')}/metrics"
    files = Folders(spark, checkpoint)

    def earlier(batch_id: int) -> DataFrame | None:
        return spark.read.schema(METRICS).parquet(metrics_path).where(F.col("batch_id") < batch_id) if files.exists(metrics_path) else None

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumns({"_id": _message_id(keys), "_late": F.lit(False)}).persist()
        try:
            before = earlier(batch_id)  # a row per batch
            mark = before.agg((F.max("newest") - F.expr(f"INTERVAL {delay}")).alias("m")).first()["m"] if before is not None else None
            late, fresh = batch.where(F.lit(False)), batch
            if mark is not None:
                behind = F.coalesce(F.col("timestamp") < F.lit(mark), F.lit(False))
                late, fresh = batch.where(behind).withColumn("_late", F.lit(True)), batch.where(~behind)
            once = fresh.where("_id IS NULL").unionByName(fresh.where("_id IS NOT NULL").dropDuplicates(["_id"]))
            if mark is not None and files.exists(seen_path):
                # Batches whose newest message is older than the mark are not read.
                known = [r[0] for r in before.where(F.col("newest") >= F.lit(mark)).select("batch_id").collect()]
                if known:
                    seen = spark.read.parquet(seen_path).where(F.col("batch_id").isin(known)).select("_id")
                    once = once.join(seen, "_id", "left_anti").select(*once.columns)
            first = once.unionByName(late).persist()
            tagged = with_outcome(decoded_events(first.drop("_id"), row_schema, event_time), [sound, *rules], as_of)
            tagged = tagged.withColumn("outcome", F.when(F.col("message__late"), LATE).otherwise(F.col("outcome"))).drop("message__late")
            counts = Observation(f"stream-{batch_id}")
            write_outcomes(tagged, path, ["event_day"], batch_id, counts, stream)
            said = counts.get
            valid = spark.read.parquet(path).where((F.col("outcome") == VALID) & (F.col("stream") == stream) & (F.col("batch_id") == batch_id)) if said["valid"] else None
            if valid is not None:
                if suite:
                    raise_on_failure(run_suite(valid, list(suite)))
                if rollup:
                    replace_batch(event_rollup(valid, rollup.dimensions, rollup.every, event_time), batch_id, rollup.path, stream)
                if topic:
                    topic.publish(to_message(valid.select(*row_schema.names), topic.key), stream, batch_id)
            replace_part(first.where("_id IS NOT NULL AND NOT _late").select("_id"), batch_id, seen_path)
            read = batch.agg(F.count(F.lit(1)).alias("n"), F.max("timestamp").alias("t")).first()
            row = (batch_id, read["n"], said["valid"], said["rejected"], said["late"], read["n"] - said["loaded"], read["t"])
            replace_part(spark.createDataFrame([row], METRICS).drop("batch_id").coalesce(1), batch_id, metrics_path)
            first.unpersist()
        finally:
            batch.unpersist()

    begun = earlier(1 << 62)
    done = begun.agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0] if begun is not None else -1
    query = write_batches(messages, write, checkpoint, every=every)
    if every is not None:
        return query
    query.awaitTermination()
    log = RunLog(spark, run_log_path)
    names = ["read", "valid", "rejected", "late", "repeats"]
    metrics = earlier(1 << 62)
    total = metrics.where(F.col("batch_id") > done).agg(F.count(F.lit(1)).alias("batches"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first() if metrics is not None else None
    run = StreamRun(log.run_id, *([total[c] for c in ["batches", *names]] if total else [0] * 6))
    log.record("stream_etl", batches=run.batches, **{c: getattr(run, c) for c in names})
    log.save()
    return run


def served_events(spark: SparkSession, path: str, event_time: str = "event_time",
                  dimensions: list[str] = SERVED_DIMENSIONS) -> DataFrame:
    """What the analytics side reads: valid events, time and dimensions only."""
    return read_outcome(spark, path, VALID).select(event_time, *dimensions)
