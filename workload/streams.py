"""Streaming queries: each reads a given table as a stream, runs until it has seen all of it, and reads back
what was written."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit import operators as op
from etlkit import plans
from etlkit import streaming as st
from etlkit.operators.rules import expr_rule, not_null
from etlkit.session import scratch_path
from etlkit.sinks import REJECTED, VALID, read_outcome
from workload.inputs import load

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return keep


def _stream(spark, folder, name="events"):
    schema = load(spark, folder, name).schema
    # A pattern rather than a plain path, so that the table may be one file or a folder of files.
    return spark.readStream.schema(schema).parquet(f"{folder}/{{{name}}}.parquet")


def _finish(q):
    q.awaitTermination()


def _timed_events(df):
    return df.withColumn("event_time", F.col("ts").cast("timestamp"))


# ---- change events -----------------------------------------------------------------------------------------

ROW = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])


def change_messages(events):
    """Events as change messages: views create, clicks update, errors delete; signups carry broken JSON and
    purchases an unknown operation."""
    row = F.struct("user_id", "value")
    body = lambda op, after, before: F.to_json(F.struct(
        F.lit(op).alias("op"), after.alias("after"), before.alias("before"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms")))
    none = F.lit(None).cast("struct<user_id:bigint,value:double>")
    kind = F.col("event_type")
    value = (F.when(kind == "view", body("c", row, none)).when(kind == "click", body("u", row, none))
             .when(kind == "error", body("d", none, row)).when(kind == "signup", F.lit('{"op": "c", "after": {"user'))
             .otherwise(body("x", row, none)))
    return events.select(F.col("event_id").cast("string").alias("key"), value.alias("value"), F.lit("changes").alias("topic"),
                         F.col("ts").cast("timestamp").alias("timestamp"))


CDC_SQL = """SELECT event_id, CASE event_type WHEN 'view' THEN 'c' WHEN 'click' THEN 'u' WHEN 'error' THEN 'd' WHEN 'purchase' THEN 'x' END AS op,
  CASE WHEN event_type <> 'signup' THEN epoch_us(ts) // 1000 END AS ts_ms, CASE WHEN event_type <> 'signup' THEN user_id END AS user_id,
  CASE WHEN event_type <> 'signup' THEN value END AS value,
  CASE event_type WHEN 'signup' THEN 'not readable as JSON' WHEN 'purchase' THEN 'unknown operation' END AS parse_error FROM events"""


@query(CDC_SQL)
def parse_cdc(spark, folder):
    decoded = st.parse_cdc(change_messages(load(spark, folder, "events")), ROW)
    sound = F.col("parse_error").isNull() | (F.col("parse_error") == "unknown operation")
    return decoded.select(F.col("message_key").cast("bigint").alias("event_id"), F.when(sound, F.col("op")).alias("op"),
                          *[F.when(sound, F.col(c)).alias(c) for c in ("ts_ms", "user_id", "value")], "parse_error")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_properties(spark, folder):
    return load(spark, folder, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(f"""SELECT user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) AS rn
FROM ({CDC_SQL}) WHERE parse_error IS NULL) WHERE rn = 1 AND op <> 'd'""")
def change_stream_table(spark, folder):
    """A stream of changes applied to a table: last change per key, deleted keys gone."""
    decoded = st.parse_cdc(change_messages(_stream(spark, folder)), ROW).where("parse_error IS NULL")
    changes = decoded.select(F.col("message_key").cast("bigint").alias("event_id"), "op", "ts_ms", "user_id", "value")
    path = scratch_path(spark, "changes")
    _finish(st.write_changes_stream(changes, ["user_id"], "ts_ms", ["event_id"], path, scratch_path(spark, "checkpoint"), every=None))
    return st.current_rows(spark.read.parquet(path), ["user_id"], "ts_ms", ["event_id"]).select("user_id", "value")


@query(SQL["change_stream_table"])
def folded_changes(spark, folder):
    """The same changes folded into a base table, and the current rows read from base and log together."""
    decoded = st.parse_cdc(change_messages(load(spark, folder, "events")), ROW).where("parse_error IS NULL")
    changes = decoded.select(F.col("message_key").cast("bigint").alias("event_id"), "op", "ts_ms", "user_id", "value")
    noon, base = F.col("ts_ms") < F.unix_millis(F.lit("2024-01-15 12:00:00").cast("timestamp")), scratch_path(spark, "base")
    st.fold_changes(None, changes.where(noon), ["user_id"], "ts_ms", ["event_id"], base)
    return st.current_rows(changes.where(~noon), ["user_id"], "ts_ms", ["event_id"], base=spark.read.parquet(base)).select("user_id", "value")


# ---- events ------------------------------------------------------------------------------------------------

@query("""SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events,
  round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 2) AS sum_value FROM events GROUP BY 1, 2""")
def event_rollup(spark, folder):
    events = _timed_events(_stream(spark, folder)).withColumn("value", F.col("value").cast("decimal(18,2)"))
    rollup = st.event_rollup(events, ["event_type"], "1 hour", delay="60 days", values=["value"])
    path = scratch_path(spark, "rollup")
    _finish(st.write_rollup_stream(rollup, path, scratch_path(spark, "checkpoint"), every=None))
    return st.read_rollup(spark, path, ["event_type"]).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events",
        F.round(F.col("sum_value").cast("double"), 2).alias("sum_value"))


@query("""SELECT w AS window_start, event_type, count(*) AS events FROM (
 SELECT event_type, unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts - INTERVAL 6 HOUR)]) AS w FROM events) GROUP BY 1, 2""")
def event_rollup_sliding(spark, folder):
    events = _timed_events(_stream(spark, folder))
    rollup = st.event_rollup(events, ["event_type"], "12 hours", slide="6 hours", delay="60 days")
    path = scratch_path(spark, "rollup")
    _finish(st.write_rollup_stream(rollup, path, scratch_path(spark, "checkpoint"), every=None))
    return st.read_rollup(spark, path, ["event_type"]).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events")


@query("""SELECT event_type, count(DISTINCT event_id) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1""")
def dedup_events(spark, folder):
    """Every event delivered twice, kept once."""
    events = _timed_events(_stream(spark, folder)).unionByName(_timed_events(_stream(spark, folder)))
    path = scratch_path(spark, "events")
    _finish(st.write_table_stream(st.dedup_events(events, ["event_id"], delay="60 days"), path, scratch_path(spark, "checkpoint"), every=None))
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


@query("""SELECT event_id, CASE WHEN value >= 5 AND event_type <> 'error' THEN 'valid' ELSE 'rejected' END AS outcome,
  concat_ws(',', CASE WHEN value < 5 THEN 'value_floor' END, CASE WHEN event_type = 'error' THEN 'not_null:event_type' END) AS failed_rules FROM events""")
def split_stream(spark, folder):
    """Valid events and dead letters from one stream."""
    events = _stream(spark, folder).withColumn("event_type", F.nullif("event_type", F.lit("error")))
    path = scratch_path(spark, "split")
    rules = [expr_rule("value_floor", "value >= 5"), not_null("event_type")]
    _finish(st.write_split_stream(events, rules, path, scratch_path(spark, "checkpoint"), as_of="2024-01-31", every=None))
    valid, dead = read_outcome(spark, path, VALID), read_outcome(spark, path, REJECTED)
    return valid.select("event_id", F.lit("valid").alias("outcome"), F.lit("").alias("failed_rules")).unionByName(
        dead.select("event_id", F.lit("rejected").alias("outcome"), F.array_join("failed_rules", ",").alias("failed_rules")))


@query("""SELECT ts AS event_time, user_id AS patient_id, event_type, user_id AS provider_id, CAST(ts AS DATE) AS event_day FROM events""")
def serve_events(spark, folder):
    """Event time as ISO text and three dimensions, to a table partitioned by day."""
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    events = _stream(spark, folder).select(iso.alias("event_time"), F.col("user_id").alias("patient_id"), "event_type",
                                           F.col("user_id").alias("provider_id"))
    path = scratch_path(spark, "served")
    _finish(st.write_table_stream(st.served_columns(events), path, scratch_path(spark, "checkpoint"), ["event_day"], every=None))
    return spark.read.parquet(path).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query("""SELECT CAST(user_id AS VARCHAR) AS key, event_id, event_type, value FROM events""")
def publish_events(spark, folder):
    """Rows published as JSON messages, and what a reader of the topic gets from them."""
    events = _stream(spark, folder).select("user_id", "event_id", "event_type", "value")
    path = scratch_path(spark, "topic")
    _finish(st.write_events(events, scratch_path(spark, "checkpoint"), "json", {"path": path}, key="user_id", every=None))
    messages = spark.read.schema("key string, value string").json(path)
    row = F.from_json("value", "user_id bigint, event_id bigint, event_type string, value double")
    return messages.select("key", row.alias("r")).select("key", "r.event_id", "r.event_type", "r.value")


EVENT_ROW = T.StructType([T.StructField(c, T.StringType()) for c in ("event_time", "patient_id", "event_type", "provider_id")])


def clinical_messages(events):
    """Events as change messages of clinical events; signups carry broken JSON, errors have no provider."""
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    row = F.struct(iso.alias("event_time"), F.concat(F.lit("P"), F.col("user_id")).alias("patient_id"), "event_type",
                   F.when(F.col("event_type") != "error", F.concat(F.lit("DR"), F.col("user_id"))).alias("provider_id"))
    value = F.to_json(F.struct(F.lit("c").alias("op"), row.alias("after"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms")))
    return events.select(F.col("event_id").cast("string").alias("key"),
                         F.when(F.col("event_type") == "signup", F.concat(F.lit("{broken "), F.col("event_id"))).otherwise(value).alias("value"),
                         F.lit("changes").alias("topic"), F.col("ts").cast("timestamp").alias("timestamp"))


@query("""SELECT ts AS event_time, 'P' || user_id AS patient_id, event_type, 'DR' || user_id AS provider_id, 'valid' AS outcome
FROM events WHERE event_type NOT IN ('signup', 'error')
UNION ALL SELECT CASE WHEN event_type = 'error' THEN ts END, CASE WHEN event_type = 'error' THEN 'P' || user_id END,
  CASE WHEN event_type = 'error' THEN event_type END, NULL, 'rejected' FROM events WHERE event_type IN ('signup', 'error')""")
def stream_etl(spark, folder):
    """The whole stream flow, every message delivered twice: decode, drop repeats, validate, serve."""
    messages = clinical_messages(_stream(spark, folder)).unionByName(clinical_messages(_stream(spark, folder)))
    path = scratch_path(spark, "flow")
    plans.run_stream_etl(spark, messages, [not_null("patient_id"), not_null("provider_id")], path, scratch_path(spark, "checkpoint"),
                         keys=["key"], as_of="2024-01-31")
    columns = ["event_time", "patient_id", "event_type", "provider_id"]
    served = plans.served_events(spark, path).withColumn("outcome", F.lit(VALID))
    dead = read_outcome(spark, path, REJECTED).select(*columns).withColumn("outcome", F.lit(REJECTED))
    return served.unionByName(dead).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query("""SELECT count(*) AS read, count(*) FILTER (side = 'late') AS late, count(*) FILTER (side = 'rejected') AS rejected,
  count(*) FILTER (side = 'valid') AS valid, 0::BIGINT AS repeats
FROM (SELECT CASE WHEN ts < TIMESTAMP '2024-01-15' AND ts < (SELECT max(ts) FROM events) - INTERVAL 1 HOUR THEN 'late'
   WHEN event_type IN ('signup', 'error') THEN 'rejected' ELSE 'valid' END AS side FROM events)""")
def late_messages(spark, folder):
    """Messages of later days arrive in a first run, those of earlier days in a second: every one has its side."""
    messages = clinical_messages(load(spark, folder, "events"))
    source, path, check = (scratch_path(spark, n) for n in ("topic", "flow", "checkpoint"))
    runs = []
    for part in (F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp"), F.col("timestamp") < F.lit("2024-01-15").cast("timestamp")):
        messages.where(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(messages.schema).parquet(source)
        runs.append(plans.run_stream_etl(spark, stream, [not_null("patient_id"), not_null("provider_id")], path, check, keys=["key"], as_of="2024-01-31"))
    total = {c: sum(getattr(r, c) for r in runs) for c in ("read", "repeats")}
    sides = spark.read.parquet(path).groupBy().agg(*[F.count_if(F.col("outcome") == s).alias(s) for s in ("valid", "rejected", "late")])
    return sides.select(F.lit(total["read"]).cast("long").alias("read"), "late", "rejected", "valid", F.lit(total["repeats"]).cast("long").alias("repeats"))


@query("""SELECT event_id, 'valid' AS outcome FROM events WHERE value >= 5 UNION ALL SELECT event_id, 'rejected' FROM events WHERE value < 5""")
def two_checkpoints(spark, folder):
    """Two streams, each with a checkpoint of its own, write to one path; both begin with batch 0."""
    path, rules = scratch_path(spark, "shared"), [expr_rule("value_floor", "value >= 5")]
    for half in (0, 1):
        events = _stream(spark, folder).where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half)
        _finish(st.write_split_stream(events, rules, path, scratch_path(spark, "checkpoint"), as_of="2024-01-31", every=None))
    return read_outcome(spark, path, VALID).select("event_id", F.lit("valid").alias("outcome")).unionByName(
        read_outcome(spark, path, REJECTED).select("event_id", F.lit("rejected").alias("outcome")))


@query("""SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1""")
def restarted_stream(spark, folder):
    """A stream that stops after half of its files and goes on from its checkpoint: every row once."""
    events = load(spark, folder, "events").select("event_id", "event_type")
    source, path, check = (scratch_path(spark, n) for n in ("source", "events", "checkpoint"))
    for half in (0, 1):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half).write.mode("append").parquet(source)
        _finish(st.write_table_stream(spark.readStream.schema(events.schema).parquet(source), path, check, every=None))
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))
