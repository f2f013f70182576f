import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from etlkit.operators import apply_changes, latest_per_key, merge_versions, upsert
from etlkit.sinks import append_table, upsert_table
from etlkit.sources import incremental_slice

T = lambda d: dt.datetime(2024, 1, d)
TARGET = "claim_id string, patient_id string, claim_amount double, processed_at timestamp"
CHANGE = "claim_id string, patient_id string, claim_amount double, updated_at timestamp, seq int"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("c1", "p1", 10.0, T(1))], TARGET)


@pytest.fixture
def changes(spark):
    return spark.createDataFrame([("c1", "p1", 11.0, T(2), 1), ("c1", "p1", 12.0, T(3), 2), ("c2", "p2", 5.0, T(1), 3), ("c2", "p2", 6.0, T(2), 4)], CHANGE)


def merged(target, changes, **kw):
    return upsert(target, changes, ["claim_id"], "updated_at", ["seq"], as_of="2024-02-01", **kw)


def test_only_the_latest_version_is_merged(target, changes, rows):
    assert rows(merged(target, changes), "claim_id", "claim_amount") == [("c1", 12.0), ("c2", 6.0)]


def test_upsert_is_idempotent_and_keys_stay_unique(target, changes, rows):
    once = merged(target, changes)
    assert rows(merged(once, changes)) == rows(once)
    assert once.groupBy("claim_id").count().where("count > 1").count() == 0


def test_untouched_rows_keep_their_stamp(target, changes, rows):
    out = merged(target.unionByName(target.withColumn("claim_id", F.lit("c9"))), changes)
    assert rows(out.where("claim_id = 'c9'"), "processed_at") == [(T(1),)]


def test_ties_are_settled_and_tie_break_is_required(spark, rows):
    df = spark.createDataFrame([("a", T(1), i) for i in range(50)], "k string, t timestamp, seq int")
    assert rows(latest_per_key(df, ["k"], "t", ["seq"]), "seq") == [(49,)]
    with pytest.raises(ValueError):
        latest_per_key(df, ["k"], "t", [])


def test_missing_columns(target, changes):
    with pytest.raises(ValueError, match="patient_id"):
        merged(target, changes.drop("patient_id"))


def test_rank_filter_works_before_the_shuffle(spark, tmp_path):
    spark.range(1000).selectExpr("id % 3 AS k", "id AS t").write.parquet(str(tmp_path / "v"))
    plan = latest_per_key(spark.read.parquet(str(tmp_path / "v")), ["k"], "t", ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_deletes(spark, rows):
    target = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k int, v double")
    changes = spark.createDataFrame([(1, 9.0, 1, "u"), (2, 2.0, 1, "u"), (2, 2.0, 2, "d"), (4, 4.0, 1, "c"), (5, 5.0, 1, "d")], "k int, v double, ts int, op string")
    assert rows(apply_changes(target, changes, ["k"], "ts", ["op"])) == [(1, 9.0), (3, 3.0), (4, 4.0)]


def test_late_change_does_not_replace_a_newer_one(spark, rows):
    a = spark.createDataFrame([(1, 5, "new")], "k int, ts int, v string")
    b = spark.createDataFrame([(1, 3, "old")], "k int, ts int, v string")
    assert rows(merge_versions(a, b, keys=["k"], newest="ts", tie_break=["v"]), "v") == [("new",)]


def test_first_load_takes_everything(spark, rows):
    source = spark.createDataFrame([("a", T(1)), ("b", T(2)), ("c", None)], "k string, updated_at timestamp")
    empty = spark.createDataFrame([], "processed_at timestamp")
    assert rows(incremental_slice(source, "updated_at", empty, "processed_at"), "k") == [("a",), ("b",)]
    held = spark.createDataFrame([(T(1),)], "processed_at timestamp")
    assert rows(incremental_slice(source, "updated_at", held, "processed_at"), "k") == [("b",)]
    assert rows(incremental_slice(source, "updated_at", mark=F.lit(T(1))), "k") == [("b",)]


@pytest.mark.parametrize("partitioned", [True, False])
def test_table_merge_against_brute_force(spark, tmp_path, partitioned):
    rng = random.Random(3)
    held = {k: (k % 6, float(k)) for k in range(200)}
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(k, d, v) for k, (d, v) in held.items()], "k int, day int, v double")
    append_table(frame, path, "day" if partitioned else None)
    # Day 5 is emptied: all its rows move to day 7. A third of the changes hit one key.
    changes = [(k, 7, 1000.0 + k, 10, i) for i, k in enumerate(k for k in held if held[k][0] == 5)]
    changes += [(0 if i % 3 == 0 else rng.randrange(300), rng.choice([0, 1]), float(i), rng.randrange(10), i + 1000) for i in range(90)]
    df = spark.createDataFrame(changes, "k int, day int, v double, ts int, seq int")
    for _ in range(2):
        upsert_table(spark, path, df, ["k"], "ts", ["seq"], partition_col="day" if partitioned else None)
    want = dict(held)
    for k, d, v, ts, seq in sorted(changes, key=lambda c: (c[3], c[4])):
        want[k] = (d, v)
    got = {r["k"]: (r["day"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert got == want
    assert spark.read.parquet(path).count() == len(want)


def test_merge_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(spark.createDataFrame([(1, "2024-01-01", 1.0), (2, "2024-01-02", 2.0)], "k int, day string, v double").selectExpr("k", "date(day) AS day", "v"), path, "day")
    other = lambda: [f for f in spark.read.parquet(path).inputFiles() if "day=2024-01-02" in f]
    before = other()
    changes = spark.createDataFrame([(1, "2024-01-03", 5.0, 1)], "k int, day string, v double, ts int").selectExpr("k", "date(day) AS day", "v", "ts")
    upsert_table(spark, path, changes, ["k"], "ts", ["ts"], partition_col="day")
    assert before and other() == before
    assert sorted((r["k"], str(r["day"])) for r in spark.read.parquet(path).collect()) == [(1, "2024-01-03"), (2, "2024-01-02")]


def test_null_keys_merge_once(spark, rows):
    target = spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int")
    changes = spark.createDataFrame([(None, 2, 1), ("b", 3, 1)], "k string, v int, t int")
    once = upsert(target, changes, ["k"], "t", ["v"])
    assert rows(once) == rows(upsert(once, changes, ["k"], "t", ["v"])) == sorted([(None, 2), ("a", 1), ("b", 3)], key=repr)
    deletes = changes.selectExpr("k", "v", "t", "'d' AS op")
    assert rows(apply_changes(once, deletes, ["k"], "t", ["v"])) == [("a", 1)]
