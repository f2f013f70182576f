import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit import streaming as st
from etlkit.operators.rules import expr_rule, not_null, row_count
from etlkit.plans import RollupTo, Topic, run_stream_etl, served_events
from etlkit.sinks import LATE, REJECTED, VALID, read_outcome

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.DoubleType())])
AT = dt.datetime(2024, 1, 1)


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def feed(spark, folder, rows, schema):
    """One more file in a folder that a stream reads."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder, schema, **options):
    return spark.readStream.schema(schema).options(**options).parquet(folder)


def messages(*events):
    return [(str(i), e if e is None or isinstance(e, str) else json.dumps(e), "t", AT + dt.timedelta(minutes=i)) for i, e in enumerate(events)]


MESSAGE = "key string, value string, topic string, timestamp timestamp"


def test_change_events(spark):
    row = {"id": 1, "value": 2.5}
    cases = [({"op": "c", "after": row, "ts_ms": 1000}, ("c", 1, None)), ({"op": "u", "before": row, "after": {"id": 1, "value": 3.0}, "ts_ms": 1}, ("u", 1, None)),
             ({"op": "d", "before": row, "ts_ms": 1}, ("d", 1, None)), ({"op": "r", "after": row, "ts_ms": 1}, ("r", 1, None)),
             ({"op": "x", "after": row, "ts_ms": 1}, ("x", None, "unknown operation")), ({"after": row, "ts_ms": 1}, (None, None, "unknown operation")),
             ({"op": "d", "after": row, "ts_ms": 1}, ("d", None, "no row")), ({"op": "c", "after": row}, ("c", None, "no change time")),
             ("{broken", (None, None, "not readable as JSON")), (" ", (None, None, "not readable as JSON")), (None, (None, None, "no value")),
             ({"op": "c", "after": {"id": "text"}, "ts_ms": 1}, (None, None, "not readable as JSON"))]
    df = st.parse_cdc(spark.createDataFrame(messages(*[c for c, _ in cases]), MESSAGE), ROW)
    found = {int(r["message_key"]): r for r in df.collect()}
    for i, (event, (op, ident, error)) in enumerate(cases):
        assert found[i]["parse_error"] == error, event
        if error is None:
            assert (found[i]["op"], found[i]["id"]) == (op, ident)
    assert found[0]["change_time"] == dt.datetime(1970, 1, 1, 0, 0, 1)
    with pytest.raises(ValueError, match="op"):
        st.parse_cdc(df.selectExpr("message_value AS value"), T.StructType([T.StructField("op", T.StringType())]))


def test_a_message_is_parsed_once(spark, place):
    feed(spark, place("in"), messages("{}"), MESSAGE)
    sound = st.parse_cdc(spark.read.schema(MESSAGE).parquet(place("in")), ROW).where("parse_error IS NULL AND op = 'c' AND id > 3")
    assert sound._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_message_source_from_files(spark, place):
    feed(spark, place("in"), messages({"op": "c", "after": {"id": 1, "value": 1.0}, "ts_ms": 1}), MESSAGE)
    df = st.read_events(spark, {"path": place("in")}, fmt="parquet")
    assert df.isStreaming and df.columns == ["key", "value", "topic", "timestamp"]
    assert st.kafka_options("h:1", "a,b")["subscribe"] == "a,b"


def test_messages_round_trip(spark):
    df = st.to_message(spark.createDataFrame([(7, "x")], "id int, name string"), key="id")
    assert [tuple(r) for r in df.collect()] == [("7", '{"id":7,"name":"x"}')]


def test_restart_adds_nothing_and_new_files_only_once(spark, place):
    schema = "id bigint, t timestamp"
    feed(spark, place("in"), [(i, AT) for i in range(10)], schema)
    run = lambda: st.write_table_stream(stream(spark, place("in"), schema), place("out"), place("check"), every=None).awaitTermination()
    run(), run()
    assert spark.read.parquet(place("out")).count() == 10
    feed(spark, place("in"), [(i, AT) for i in range(10, 13)], schema)
    run()
    assert spark.read.parquet(place("out")).count() == 13


def test_repeats_across_runs_are_dropped(spark, place):
    schema = "id bigint, event_time string"
    times = ["2024-01-01T00:00:00Z"] * 3
    feed(spark, place("in"), [(1, times[0]), (1, times[0]), (2, times[0])], schema)
    run = lambda: st.write_table_stream(st.dedup_events(stream(spark, place("in"), schema), ["id"], delay="1 hour"), place("out"), place("check"), every=None).awaitTermination()
    run()
    feed(spark, place("in"), [(2, "2024-01-01T00:10:00Z"), (3, "2024-01-01T00:10:00Z")], schema)
    run()
    assert sorted(r["id"] for r in spark.read.parquet(place("out")).collect()) == [1, 2, 3]


@pytest.mark.parametrize("spread", [1, 16])
def test_many_copies_of_one_event(spark, place, spread):
    schema = "id bigint, event_time timestamp"
    spark.range(0, 6000, 1, 6).selectExpr("if(id % 3 = 0, 0, id % 40) AS id", "timestamp'2024-01-01' AS event_time").write.parquet(place("in"))
    for _ in range(2):
        events = st.dedup_events(stream(spark, place("in"), schema, maxFilesPerTrigger=4), ["id"], spread=spread)
        st.write_table_stream(events, place("out"), place("check"), every=None).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(place("out")).collect()) == list(range(40))


def test_split_stream_and_repeated_batch(spark, place):
    schema = "id bigint, value double"
    feed(spark, place("in"), [(i, float(i)) if i % 4 else (i, None) for i in range(20)], schema)
    rules = [expr_rule("floor", "value >= 5"), not_null("value")]
    st.write_split_stream(stream(spark, place("in"), schema), rules, place("out"), place("check"), as_of=AT, every=None).awaitTermination()
    counts = lambda: (read_outcome(spark, place("out"), VALID).count(), read_outcome(spark, place("out"), REJECTED).count())
    first = counts()
    assert sum(first) == 20 and first[1] == len([i for i in range(20) if i % 4 == 0 or i < 5])
    # Another checkpoint on the same path is another stream: its batch 0 is not this one's.
    feed(spark, place("more"), [(100, 9.0)], schema)
    st.write_split_stream(stream(spark, place("more"), schema), rules, place("out"), place("other-check"), as_of=AT, every=None).awaitTermination()
    assert counts() == (first[0] + 1, first[1])
    # Under a given name, a lost checkpoint replays batches in place.
    for check in ("lost", "new"):
        st.write_split_stream(stream(spark, place("in"), schema), rules, place("named"), place(check), as_of=AT, every=None, stream="s").awaitTermination()
        assert read_outcome(spark, place("named"), VALID).count() == first[0]


def test_rollup_stream_equals_batch(spark, place, rows):
    schema = "event_time timestamp, kind string, value double"
    data = [(AT + dt.timedelta(minutes=7 * i), "ab"[i % 2], float(i)) for i in range(200)]
    for part in range(4):
        feed(spark, place(f"in"), data[part * 50:part * 50 + 50], schema)
    source = stream(spark, place("in"), schema, maxFilesPerTrigger=1)
    for every, slide in (("1 hour", None), ("2 hours", "30 minutes")):
        rollup = st.event_rollup(source, ["kind"], every, slide=slide, delay="2 days", values=["value"])
        st.write_rollup_stream(rollup, place(f"out-{every}"), place(f"check-{every}"), every=None).awaitTermination()
        batch = st.event_rollup(spark.createDataFrame(data, schema), ["kind"], every, slide=slide, values=["value"])
        assert rows(st.read_rollup(spark, place(f"out-{every}"), ["kind"])) == rows(batch)


def test_late_rows_are_dropped_and_counted(spark, place):
    schema = "event_time timestamp, kind string"
    # Late rows are dropped from the batch after the one that moved the watermark is finished.
    times = [AT, AT + dt.timedelta(days=1), AT + dt.timedelta(days=1), AT]
    dropped = 0
    for t in times:
        feed(spark, place("in"), [(t, "a")], schema)
        rollup = st.event_rollup(stream(spark, place("in"), schema), ["kind"], "1 hour", delay="1 hour")
        q = st.write_rollup_stream(rollup, place("out"), place("check"), every=None)
        q.awaitTermination()
        dropped += sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators)
    assert dropped == 1
    assert sorted(r["events"] for r in st.read_rollup(spark, place("out"), ["kind"]).collect()) == [1, 2]


CHANGE = "id bigint, value double, op string, ts_ms bigint, seq bigint"
MERGE = (["id"], "ts_ms", ["seq"])


def test_changes_out_of_order_and_deletes(spark, place, rows):
    run = lambda: st.write_changes_stream(stream(spark, place("in"), CHANGE), *MERGE, place("log"), place("check"), every=None).awaitTermination()
    feed(spark, place("in"), [(1, 1.0, "c", 10, 1), (1, 2.0, "u", 20, 2), (2, 1.0, "c", 10, 3), (3, 1.0, "c", 10, 4)], CHANGE)
    run()
    feed(spark, place("in"), [(1, 0.5, "u", 15, 5), (2, 1.0, "d", 30, 6), (4, 9.0, "c", 5, 7)], CHANGE)
    run(), run()
    log = spark.read.parquet(place("log"))
    want = [(1, 2.0), (3, 1.0), (4, 9.0)]
    assert rows(st.current_rows(log, *MERGE), "id", "value") == want
    st.fold_changes(None, log, *MERGE, place("base"))
    base = spark.read.parquet(place("base"))
    assert base.count() == 4
    late = spark.createDataFrame([(2, 7.0, "u", 25, 8), (3, 8.0, "u", 40, 9)], CHANGE)
    assert rows(st.current_rows(late, *MERGE, base=base), "id", "value") == [(1, 2.0), (3, 8.0), (4, 9.0)]
    with pytest.raises(Exception):
        st.fold_changes(None, log, *MERGE, place("base"))


def test_served_columns(spark, rows):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z", "p", "t", "d", 1), ("junk", "p", "t", "d", 2), (None, "p", "t", "d", 3)],
                               "event_time string, patient_id string, event_type string, provider_id string, extra int")
    assert rows(st.served_columns(df)) == [(dt.datetime(2024, 1, 1, 10), "p", "t", "d", dt.date(2024, 1, 1))]


def test_whole_flow(spark, place, rows):
    event = lambda i, **kw: {"op": "c", "ts_ms": 1, "after": {"event_time": f"2024-01-01T00:{i:02d}:00Z", "patient_id": f"P{i}", "event_type": "visit", "provider_id": "DR", **kw}}
    events = [event(1), event(1), event(2), event(3, patient_id=None), event(4, event_time="junk"), "{broken", {"op": "zz", "ts_ms": 1}]
    feed(spark, place("in"), messages(*events), MESSAGE)

    def run():
        source = st.read_events(spark, {"path": place("in")}, fmt="parquet")
        rules = [not_null("patient_id"), not_null("event_time")]
        return run_stream_etl(spark, source, rules, place("out"), place("check"), as_of=AT, run_log_path=place("log"), keys=["value"])

    result = run()
    assert (result.read, result.repeats, result.late, result.valid, result.rejected) == (7, 1, 0, 2, 4)
    assert rows(served_events(spark, place("out")), "patient_id") == [("P1",), ("P2",)]
    dead = read_outcome(spark, place("out"), REJECTED)
    assert dead.count() == 4 and dead.where("message_value IS NULL").count() == 0
    assert sorted(sum((r["failed_rules"] for r in dead.collect()), [])) == sorted(
        ["not_null:patient_id", "not_null:event_time", "sound_event", "not_null:patient_id", "not_null:event_time", "sound_event", "not_null:patient_id", "not_null:event_time"])
    assert run().read == 0
    assert read_outcome(spark, place("out"), VALID).count() == 2
    assert spark.read.parquet(place("log")).where("metric = 'read'").agg(F.sum("value")).first()[0] == 7.0


def message_rows(*rows):
    return [(k, v, "t", t) for k, v, t in rows]


def test_no_message_vanishes(spark, place):
    """Tombstones, repeats, late messages and more batches than the query's progress list keeps."""
    sound = lambda i: '{"op": "c", "ts_ms": 1, "after": {"event_time": "2024-01-01T00:00:00Z", "patient_id": "P%d", "event_type": "v", "provider_id": "D"}}' % i
    late, hour = AT - dt.timedelta(hours=3), dt.timedelta(minutes=20)
    batches = [[(f"k{i}", None, AT) for i in range(6)] + [("a", sound(1), AT), ("a", sound(1), AT)], [("b", sound(2), late), ("a", sound(1), AT + hour)],
               [("c", sound(3), AT + hour)], [("c", sound(3), AT + 2 * hour), ("d", sound(4), None)], [("a", sound(1), AT + 6 * hour)], [("a", sound(1), AT + 12 * hour)]]
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        for part in batches:
            feed(spark, place("in"), message_rows(*part), MESSAGE)
            time.sleep(1.1)  # files of one second would have no order
        source = st.read_events(spark, {"path": place("in"), "maxFilesPerTrigger": "1"}, fmt="parquet")
        run = run_stream_etl(spark, source, [], place("out"), place("check"), as_of=AT)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert (run.batches, run.read, run.late) == (6, 15, 1)
    assert run.rejected == 6 and run.valid + run.rejected + run.late + run.repeats == run.read
    dead = read_outcome(spark, place("out"), REJECTED)
    assert sorted(r["message_key"] for r in dead.collect()) == [f"k{i}" for i in range(6)]
    assert [r["message_key"] for r in read_outcome(spark, place("out"), LATE).collect()] == ["b"]


def test_flow_rolls_up_publishes_and_checks(spark, place, rows):
    event = lambda i: {"op": "c", "ts_ms": 1, "after": {"event_time": f"2024-01-01T0{i % 3}:10:00Z", "patient_id": f"P{i}", "event_type": "visit", "provider_id": "D"}}
    source = lambda: st.read_events(spark, {"path": place("in")}, fmt="parquet")
    keep = dict(rollup=RollupTo(place("rollup"), ["event_type"]), topic=Topic("json", {"path": place("topic")}, "patient_id"))
    feed(spark, place("in"), messages(*[event(i) for i in range(4)]), MESSAGE)
    run_stream_etl(spark, source(), [], place("out"), place("check"), as_of=AT, suite=[row_count(1, 100)], **keep)
    feed(spark, place("in"), messages(*[event(i) for i in range(4, 9)]), MESSAGE)
    with pytest.raises(Exception, match="row_count"):
        run_stream_etl(spark, source(), [], place("out"), place("check"), as_of=AT, suite=[row_count(100, 200)], **keep)
    run_stream_etl(spark, source(), [], place("out"), place("check"), as_of=AT, suite=[row_count(1, 100)], **keep)
    assert rows(st.read_rollup_parts(spark, place("rollup"), ["event_type"]), "events") == [(3,), (3,), (3,)]
    assert sorted(r["key"] for r in spark.read.schema("key string, value string").json(place("topic") + "/*/*").collect()) == [f"P{i}" for i in range(9)]


def test_rollups_and_changes_fold_in_place(spark, place, rows):
    schema = "event_time timestamp, kind string"
    for k in range(3):
        feed(spark, place("in"), [(AT, "a")] * (k + 1), schema)
        st.write_rollup_stream(st.event_rollup(stream(spark, place("in"), schema), ["kind"], "1 hour"), place("r"), place("rc"), every=None).awaitTermination()
        if k < 2:
            st.fold_rollup(spark, place("r"), ["kind"])
            assert spark.read.parquet(place("r")).count() == 1
    assert rows(st.read_rollup(spark, place("r"), ["kind"]), "events") == [(6,)]
    for k in range(3):
        feed(spark, place("cin"), [(1, float(k), "u", 10 + k, k), (k + 2, 0.0, "c", 5, 9)], CHANGE)
        st.write_changes_stream(stream(spark, place("cin"), CHANGE), *MERGE, place("log"), place("cc"), every=None).awaitTermination()
        st.fold_new_changes(spark, place("log"), *MERGE, place("base"))
        st.fold_new_changes(spark, place("log"), *MERGE, place("base"))
    assert rows(spark.read.parquet(place("base")), "id", "value") == [(1, 2.0), (2, 0.0), (3, 0.0), (4, 0.0)]
