import pytest
from pyspark.sql import functions as F

from etlkit.operators import (accuracy_rate, completeness, find_duplicates, freshness, monthly_rollup, lag_percentiles, null_profile, profile_numeric, recompute_months,
                              reconcile, reconcile_literal, refresh_monthly, require_columns, row_count_match, row_diff, volume_anomalies)

SCHEMA = "claim_id int, claim_amount double"


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(1, 10.0), (2, None), (3, 5.0)], SCHEMA)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, 10.5), (2, 4.0), (4, 5.0)], SCHEMA)


def test_literal_form(source, target, rows):
    assert rows(reconcile_literal(source, target, "claim_id", "claim_amount")) == [
        (1, 10.0, 10.5, 0.5), (3, 5.0, None, None), (None, None, 5.0, None)]


def test_null_safe_form(source, target, rows):
    report = reconcile(source, target, ["claim_id"], ["claim_amount"])
    assert rows(report, "claim_id", "status", "difference_claim_amount") == [
        (1, "mismatch", 0.5), (2, "mismatch", None), (3, "missing_in_target", None), (4, "missing_in_source", None)]
    loose = reconcile(source, target, ["claim_id"], ["claim_amount"], null_safe=False, tolerance=1.0)
    assert rows(loose, "claim_id") == [(3,), (4,)]


def test_a_table_agrees_with_itself(source):
    assert reconcile(source, source, ["claim_id"], ["claim_amount"]).count() == 0
    assert row_diff(source, source).count() == 0
    assert accuracy_rate(source, source, ["claim_id"], ["claim_amount"]).first()["accuracy"] == 1.0


def test_repeated_and_null_keys_give_one_row_each(spark, rows):
    a = spark.createDataFrame([(1, 1.0)] * 500 + [(None, 1.0), (None, 2.0), (2, 2.0)], SCHEMA)
    b = spark.createDataFrame([(1, 1.0)] * 400 + [(None, 1.0), (2, 2.0)], SCHEMA)
    assert rows(reconcile(a, b, ["claim_id"], ["claim_amount"]), "claim_id", "status", "source_rows", "target_rows") == [
        (1, "duplicate_key", 500, 400), (None, "null_key", 2, 1)]


def test_sample_takes_the_same_keys_on_both_sides(spark):
    a = spark.range(5000).selectExpr("int(id) AS claim_id", "double(id) AS claim_amount")
    report = reconcile(a, a, ["claim_id"], ["claim_amount"], sample=10, keep_matches=True)
    n = report.count()
    assert 350 < n < 650 and report.where("status = 'match'").count() == n


def test_row_diff_counts_copies(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (3, "z")], "k int, v string")
    assert rows(row_diff(a, b)) == [(1, "x", "source", 2), (2, None, "source", 1), (3, "z", "target", 1)]


def test_counts(spark, source, rows):
    row = row_count_match(source, spark.createDataFrame([], SCHEMA)).first()
    assert (row["source_rows"], row["target_rows"], row["difference"], row["matched"]) == (3, 0, -3, False)
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(find_duplicates(df, ["k"])) == [("a", 2), (None, 2)]


def test_required_columns(spark):
    df = spark.createDataFrame([], "Customer_ID int, EMAIL string, created_at date")
    assert require_columns(df, ["customer_id", "email", "created_at"]) is df
    with pytest.raises(ValueError, match="created_at, email"):
        require_columns(df.select("Customer_ID"), ["customer_id", "email", "created_at"])


def test_null_profile(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(null_profile(df, ["a", "b"])) == [("a", 1, 33.33), ("b", 2, 66.67)]
    assert rows(null_profile(df.limit(0), ["a", "b"])) == [("a", 0, None), ("b", 0, None)]
    plan = null_profile(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_empty_profiles(spark):
    df = spark.createDataFrame([], "a int, t timestamp")
    assert completeness(df, ["a"]).first()["completeness"] is None
    row = freshness(df, "t", "2024-01-01", 10).first()
    assert row["latest"] is None and row["is_fresh"] is False
    assert volume_anomalies(df, "t").count() == 0


def test_a_day_without_rows_is_an_anomaly(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-20')) AS d").where("d <> date'2024-01-15'")
    df = days.withColumn("n", F.explode(F.sequence(F.lit(1), 100 + F.dayofmonth("d") % 3)))
    found = [str(r["day"]) for r in volume_anomalies(df, "d").where("is_anomaly").collect()]
    assert found == ["2024-01-15"]


def test_rollups_add_up(spark, rows):
    df = spark.range(1000).selectExpr("date_add(date'2024-01-01', int(id % 120)) AS claim_date",
                                      "if(id % 7 = 0, null, cast(id / 3 AS decimal(18,2))) AS claim_amount", "id")
    full = rows(monthly_rollup(df))
    assert rows(refresh_monthly(monthly_rollup(df.where("id < 600")), df.where("id >= 600"))) == full
    march = rows(recompute_months(df, df.where("claim_date = date'2024-03-05'")))
    assert march == [x for x in full if str(x[0]) == "2024-03-01"]


def test_quantiles_of_many_rows_are_close(spark):
    df = spark.range(0, 400_000, 1, 16).selectExpr("(id * 7919) % 400000 AS x", "cast(null AS int) AS y")
    row = {r["column_name"]: r for r in profile_numeric(df, ["x", "y"], quantiles=[0.1, 0.5]).collect()}
    assert abs(row["x"]["p10"] - 40_000) < 1_600 and abs(row["x"]["p50"] - 200_000) < 1_600
    assert row["x"]["mean"] == 199_999.5 and row["x"]["filled"] == 400_000
    assert row["y"]["p50"] is None and row["y"]["filled"] == 0
    assert profile_numeric(df.limit(0), ["x"]).first()["p50"] is None


def test_lag_percentiles(spark):
    df = spark.range(1, 101).selectExpr("timestamp_seconds(1704067200 - id) AS t")
    assert tuple(lag_percentiles(df, "t", "2024-01-01").first()) == (50.0, 95.0)


def test_literal_report_with_null_and_repeated_keys(spark, rows):
    s = spark.createDataFrame([(None, 1.0), (1, 1.0), (1, 2.0), (2, None)], "k int, v double")
    t = spark.createDataFrame([(None, 1.0), (1, 1.0), (2, 4.0), (3, 1.0)], "k int, v double")
    want = [(None, 1.0, None, None), (None, None, 1.0, None), (1, 2.0, 1.0, 1.0), (None, None, 1.0, None)]
    assert rows(reconcile_literal(s, t, "k", "v")) == sorted(want, key=repr)
