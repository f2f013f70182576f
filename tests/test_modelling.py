import datetime as dt

import pytest
from pyspark.sql import functions as F

from etlkit.operators import (as_of_join, assign_keys, build_dim_date, build_dim_provider, fixed_span, load_fact, number_new_rows, rows_without_key,
                              refresh_patients, scd2_merge)
from etlkit.sources import DIM_DATE_SCHEMA, FACT_CLAIMS_SCHEMA

D = dt.date


def test_date_dimension(spark):
    holidays = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 1),), (None,)], "d date")
    dim = build_dim_date(fixed_span(spark, "2023-12-30", "2024-03-01"), holidays)
    assert [f.name for f in dim.schema] == DIM_DATE_SCHEMA.names
    assert [f.dataType for f in dim.schema] == [f.dataType for f in DIM_DATE_SCHEMA]
    by_key = {r["date_key"]: r for r in dim.collect()}
    assert len(by_key) == dim.count() == 63
    new_year, sunday = by_key[20240101], by_key[20231231]
    assert (new_year["day_of_week"], new_year["day_name"], new_year["month_name"], new_year["quarter"]) == (2, "Monday", "January", 1)
    assert new_year["is_holiday"] and not new_year["is_weekend"]
    assert (sunday["day_of_week"], sunday["is_weekend"], sunday["is_holiday"]) == (1, True, False)
    assert 20240229 in by_key


DIM = "patient_key bigint, patient_id string, city string, plan string, effective_date date, expiration_date date"
SNAP = "patient_id string, city string, plan string"


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([(1, "a", "X", "p", D(2020, 1, 1), None), (2, "b", "X", None, D(2020, 1, 1), None),
                                  (3, "c", "X", "p", D(2019, 1, 1), D(2020, 1, 1)), (4, "c", "Y", "p", D(2020, 1, 1), None)], DIM)


@pytest.fixture
def snapshot(spark):
    return spark.createDataFrame([("a", "Z", "p"), ("b", "X", None), ("d", "X", "p")], SNAP)


def test_scd2(dim, snapshot, rows):
    out = scd2_merge(dim, snapshot, "patient_id", "2024-01-01", surrogate="patient_key")
    assert rows(out) == sorted([
        (1, "a", "X", "p", D(2020, 1, 1), D(2024, 1, 1)), (None, "a", "Z", "p", D(2024, 1, 1), None),
        (2, "b", "X", None, D(2020, 1, 1), None), (3, "c", "X", "p", D(2019, 1, 1), D(2020, 1, 1)),
        (4, "c", "Y", "p", D(2020, 1, 1), None), (None, "d", "X", "p", D(2024, 1, 1), None)], key=repr)
    assert [f.dataType for f in out.schema] == [f.dataType for f in dim.schema]


def test_scd2_properties(dim, snapshot, rows):
    keyed = number_new_rows(scd2_merge(dim, snapshot, "patient_id", "2024-01-01", surrogate="patient_key"), "patient_key", ["patient_id"])
    again = scd2_merge(keyed, snapshot, "patient_id", "2024-01-01", surrogate="patient_key")
    assert rows(again) == rows(keyed)
    assert keyed.where("expiration_date IS NULL").groupBy("patient_id").count().where("count > 1").count() == 0
    overlaps = keyed.alias("x").join(keyed.alias("y"), "patient_id").where(
        "x.patient_key < y.patient_key AND x.effective_date < coalesce(y.expiration_date, date'9999-01-01') "
        "AND y.effective_date < coalesce(x.expiration_date, date'9999-01-01')")
    assert overlaps.count() == 0
    assert sorted(r[0] for r in keyed.select("patient_key").collect()) == [1, 2, 3, 4, 5, 6]


def test_refresh_patients(dim, snapshot, rows):
    out = refresh_patients(dim, snapshot, "2024-01-01")
    assert sorted(r["patient_key"] for r in out.collect()) == [1, 2, 3, 4, 5, 6]
    assert {r["patient_id"] for r in out.where("patient_key > 4").collect()} == {"a", "d"}


def test_scd2_reduces_a_snapshot_with_several_rows_per_key(dim, spark, rows):
    snap = spark.createDataFrame([("a", f"Z{i}", "p", i) for i in range(200)], SNAP + ", seq int")
    out = scd2_merge(dim, snap, "patient_id", "2024-01-01", surrogate="patient_key", newest="seq", tie_break=["city"])
    assert rows(out.where("patient_id = 'a' AND expiration_date IS NULL"), "city") == [("Z199",)]


def test_scd2_missing_and_same_day(dim, snapshot, spark, rows):
    closed = scd2_merge(dim, snapshot, "patient_id", "2024-01-01", surrogate="patient_key", close_missing=True)
    assert rows(closed.where("patient_id = 'c' AND expiration_date = date'2024-01-01'"), "patient_key") == [(4,)]
    first = scd2_merge(dim, snapshot, "patient_id", "2024-01-01", surrogate="patient_key")
    moved = spark.createDataFrame([("a", "Q", "p")], SNAP)
    second = scd2_merge(first, moved, "patient_id", "2024-01-01", surrogate="patient_key")
    assert rows(second.where("patient_id = 'a'"), "city", "effective_date", "expiration_date") == [
        ("Q", D(2024, 1, 1), None), ("X", D(2020, 1, 1), D(2024, 1, 1))]


def test_scd2_first_load(spark, snapshot, dim):
    out = scd2_merge(dim.limit(0), snapshot, "patient_id", "2024-01-01", surrogate="patient_key")
    assert out.count() == 3 and out.where("expiration_date IS NULL").count() == 3


def test_tracked_columns(dim, spark):
    snap = spark.createDataFrame([("a", "Z", "p")], SNAP)
    assert scd2_merge(dim, snap, "patient_id", "2024-01-01", surrogate="patient_key", tracked=["plan"]).count() == 4


def test_keys_are_dense_and_repeatable(spark, rows):
    df = spark.range(5000).selectExpr("concat('k', id) AS id")
    held = spark.createDataFrame([(41, "x")], "key bigint, id string")
    keyed = assign_keys(df, "key", ["id"], existing=held, buckets=64)
    assert sorted(r["key"] for r in keyed.collect()) == list(range(42, 5042))
    assert rows(keyed) == rows(assign_keys(df.repartition(3), "key", ["id"], existing=held, buckets=64))
    assert rows(assign_keys(df.limit(0), "key", ["id"])) == []


def test_provider_dimension_grows(spark, rows):
    first = build_dim_provider(spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "provider_id string"))
    second = build_dim_provider(spark.createDataFrame([("b",), ("c",)], "provider_id string"), existing=first)
    assert dict(rows(second, "provider_id", "provider_key")) == {**dict(rows(first, "provider_id", "provider_key")), "c": 3}


def test_fact_rows_survive_missing_keys(spark, rows):
    claims = spark.createDataFrame([("c1", "a", "d1", D(2019, 6, 1), 1.0), ("c2", "a", "d9", D(2021, 6, 1), 2.0),
                                    ("c3", "?", None, D(2030, 1, 1), 3.0), ("c4", None, "d1", None, None)],
                                   "claim_id string, patient_id string, provider_id string, claim_date date, claim_amount double")
    patients = spark.createDataFrame([(1, "a", D(2019, 1, 1), D(2020, 1, 1)), (2, "a", D(2020, 1, 1), None)],
                                     "patient_key bigint, patient_id string, effective_date date, expiration_date date")
    providers = spark.createDataFrame([(7, "d1")], "provider_key bigint, provider_id string")
    dates = build_dim_date(fixed_span(spark, "2019-01-01", "2022-01-01"))
    fact = load_fact(claims, patients, dates, providers)
    assert rows(fact, "claim_id", "patient_key", "date_key", "provider_key") == [
        ("c1", 1, 20190601, 7), ("c2", 2, 20210601, -1), ("c3", -1, -1, -1), ("c4", -1, -1, 7)]
    assert fact.columns == FACT_CLAIMS_SCHEMA.names[1:]
    current = load_fact(claims, patients, dates, providers, point_in_time=False)
    assert rows(current, "claim_id", "patient_key")[0] == ("c1", 2)


def test_as_of_join_is_half_open(spark, rows):
    facts = spark.createDataFrame([("a", D(2019, 12, 31)), ("a", D(2020, 1, 1)), ("a", D(2018, 1, 1))], "id string, at date")
    dim = spark.createDataFrame([("a", 1, D(2019, 1, 1), D(2020, 1, 1)), ("a", 2, D(2020, 1, 1), None)],
                                "id string, k int, effective_date date, expiration_date date")
    assert rows(as_of_join(facts, dim, "id", "at", ["k"]), "at", "k") == [(D(2018, 1, 1), None), (D(2019, 12, 31), 1), (D(2020, 1, 1), 2)]


def test_snapshot_with_repeated_and_missing_keys(spark):
    dim = spark.createDataFrame([("a", "x", AS_OF[0], None)], "k string, city string, effective_date date, expiration_date date")
    snap = spark.createDataFrame([("a", "y"), ("a", "z"), ("b", "q"), ("b", "q"), (None, "w")], "k string, city string")
    once = scd2_merge(dim, snap, "k", AS_OF[1])
    again = scd2_merge(once, snap, "k", AS_OF[1])
    for out in (once, again):
        assert sorted((r["k"], r["city"], r["expiration_date"]) for r in out.collect() if r["expiration_date"] is None) == [("a", "z", None), ("b", "q", None)]
        assert out.count() == 3
    assert rows_without_key(snap, "k").count() == 1


AS_OF = [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
