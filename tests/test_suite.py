import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from etlkit.operators import SuiteFailed, claims_suite, load_suite, order_violations, raise_on_failure, run_suite
from etlkit.operators import rules as r
from etlkit.operators.quantiles import exact_quantiles


def results(df, rules):
    return {x["rule_id"]: x for x in run_suite(df, rules).collect()}


@pytest.fixture(scope="module")
def claims(spark):
    return spark.range(2000).select(
        F.format_string("P%08d", "id").alias("patient_id"), F.format_string("C%08d", "id").alias("claim_id"),
        F.when(F.col("id") % 50 == 0, "bad").otherwise("A01.5").alias("diagnosis_code"),
        F.lit(500.0).alias("claim_amount"), F.lit(400.0).alias("paid_amount"), F.lit(0.2).alias("copay_amount"),
        F.lit(0.5).alias("insurance_paid"), F.lit(0.3).alias("patient_paid"),
        F.when(F.col("id") % 200 != 0, F.lit("2024-01-15").cast("date")).alias("visit_date"), F.lit("DR1").alias("provider_id"),
        F.lit("PENDING").alias("claim_status"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("processed_at"))


def test_published_suite_passes_on_sound_claims(claims):
    result = run_suite(claims, claims_suite())
    found = {x["rule_id"]: x for x in result.collect()}
    assert len(found) == 19 and all(x["success"] for x in found.values())
    assert found["matches:diagnosis_code"]["unexpected_count"] == 40
    assert found["not_null:visit_date"]["unexpected_count"] == 10
    assert {x["category"] for x in found.values()} == {
        "volume", "schema", "completeness", "uniqueness", "format", "validity", "range", "statistical", "timeliness", "consistency", "type"}
    raise_on_failure(result)


def test_each_fault_is_found(claims):
    faults = {
        "row_count": claims.limit(10),
        "has_column:provider_id": claims.drop("provider_id"),
        "not_null:patient_id": claims.withColumn("patient_id", F.nullif("patient_id", F.lit("P00000001"))),
        "unique:patient_id": claims.withColumn("patient_id", F.lit("P00000001")),
        "matches:patient_id": claims.withColumn("patient_id", F.col("claim_id")),
        "between:claim_amount": claims.withColumn("claim_amount", F.lit(2e6)),
        "between:visit_date": claims.withColumn("visit_date", F.lit("2019-01-01").cast("date")),
        "mean_between:claim_amount": claims.withColumn("claim_amount", F.lit(1.0)),
        "in_set:claim_status": claims.withColumn("claim_status", F.lit("LOST")),
        "pair_compare:paid_amount<=claim_amount": claims.withColumn("paid_amount", F.lit(501.0)),
        "sum_equals:copay_amount+insurance_paid+patient_paid": claims.withColumn("copay_amount", F.lit(0.9)),
        "columns_match": claims.drop("claim_id"),
        "has_type:claim_amount": claims.withColumn("claim_amount", F.lit("500")),
        "increasing:processed_at": claims.withColumn("processed_at", F.timestamp_seconds(-F.col("claim_amount") * F.rand(1) * 1000)),
    }
    for rule_id, df in faults.items():
        rules = claims_suite()
        if rule_id == "has_type:claim_amount":
            rules = [x for x in rules if x.rule_id == rule_id]
        assert not results(df, rules)[rule_id]["success"], rule_id


def test_failure_raises(claims):
    with pytest.raises(SuiteFailed) as failed:
        raise_on_failure(run_suite(claims, [r.not_null("patient_id"), r.has_column("email"), r.row_count(high=5)]))
    assert failed.value.failures == ["has_column:email", "row_count"]


def test_rule_on_an_absent_column_fails_quietly(claims):
    found = results(claims, [r.not_null("email"), r.unique("email"), r.mean_between("email", 0, 1), r.not_null("patient_id")])
    assert [found[k]["success"] for k in ("not_null:email", "unique:email", "mean_between:email", "not_null:patient_id")] == [False, False, False, True]


def test_nulls_are_outside_the_denominator_except_for_not_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), (None,)], "c string")
    found = results(df, [r.in_set("c", ["a"]), r.not_null("c"), r.matches("c", "^[ab]$")])
    assert (found["in_set:c"]["element_count"], found["in_set:c"]["unexpected_count"], found["in_set:c"]["unexpected_pct"]) == (2, 1, 50.0)
    assert (found["not_null:c"]["element_count"], found["not_null:c"]["unexpected_count"]) == (4, 2)
    assert found["matches:c"]["success"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "c string, x double")
    found = results(df, [r.in_set("c", ["a"]), r.mean_between("x", 0, 1), r.unique("c"), r.increasing("x", order_by="c"), r.row_count(low=1)])
    assert found["in_set:c"]["success"] and found["in_set:c"]["unexpected_pct"] is None
    assert found["unique:c"]["success"] and found["increasing:x"]["success"]
    assert not found["mean_between:x"]["success"] and not found["row_count"]["success"]


def test_pair_rule_ignores_missing_values(spark):
    df = spark.createDataFrame([(1, 2), (3, None), (None, 1), (5, 4)], "a int, b int")
    row = results(df, [r.pair_compare("a", "<=", "b")])["pair_compare:a<=b"]
    assert (row["element_count"], row["unexpected_count"]) == (2, 1)
    assert results(df, [r.pair_compare("a", "=", "b")])["pair_compare:a=b"]["unexpected_count"] == 2


def test_unique_counts_every_row_of_a_repeated_key(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "k int")
    row = results(df, [r.unique("k")])["unique:k"]
    assert (row["element_count"], row["unexpected_count"]) == (4, 3)


def test_references_ignore_nulls(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    row = results(child, [r.references("k", parent, "id")])["references:k"]
    assert (row["element_count"], row["unexpected_count"]) == (4, 1)


def test_quantile_fresh_complete_blank(spark):
    df = spark.createDataFrame([(float(i), dt.datetime(2024, 1, 1), " " if i == 1 else "x") for i in range(1, 101)], "x double, t timestamp, s string")
    found = results(df, [r.quantile_between("x", 0.5, 49, 51), r.fresh("t", "2024-01-02", 3600), r.complete(["x", "t"]), r.not_blank("s")])
    assert found["quantile_between:x:0.5"]["success"] and found["complete:x+t"]["observed"] == 1.0
    assert not found["fresh:t"]["success"] and found["fresh:t"]["observed"] == 86400.0
    assert found["not_blank:s"]["unexpected_count"] == 1


def test_schema_rule(spark):
    expected = spark.createDataFrame([], "a int, b string").schema
    assert r.schema_differences(spark.createDataFrame([], "a bigint").schema, expected) == ["a: bigint instead of int", "b: missing"]
    assert not results(spark.createDataFrame([], "a int, b int"), [r.schema_matches(expected)])["schema_matches"]["success"]


def test_one_scan_for_all_row_and_total_rules(spark, claims, tmp_path):
    claims.write.parquet(str(tmp_path / "c"))
    table = spark.read.parquet(str(tmp_path / "c"))
    rules = [x for x in claims_suite() if not isinstance(x, r.JobRule)]
    plan = run_suite(table, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def brute_force(data, within, strictly):
    bad = {}
    groups = {}
    for g, k, v in data:
        groups.setdefault(g if within else None, []).append((k, v))
    for g, pairs in groups.items():
        pairs = sorted(p for p in pairs if p[1] is not None)
        bad[g] = (len(pairs), sum(b[1] <= a[1] if strictly else b[1] < a[1] for a, b in zip(pairs, pairs[1:])))
    return bad


@pytest.mark.parametrize("within", [True, False])
@pytest.mark.parametrize("strictly", [True, False])
def test_order_against_brute_force(spark, within, strictly):
    rng = random.Random(7)
    # A third of the rows share a group, and another third share an order key.
    data = [(1 if i % 3 == 0 else rng.randrange(5), 0 if i % 3 == 1 else rng.randrange(400),
             None if rng.random() < 0.05 else rng.randrange(50)) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, k int, v int")
    found = order_violations(df, "v", ["k"], within=["g"] if within else [], strictly=strictly).collect()
    got = {(x["g"] if within else None): (x["element_count"], x["unexpected_count"]) for x in found}
    assert got == brute_force(data, within, strictly)


def test_order_of_text_times(spark):
    df = spark.createDataFrame([(1, "2024-01-01T00:00:00Z"), (2, "2024-01-01T01:00:00+02:00"), (3, "junk")], "k int, t string")
    row = results(df, [r.increasing("t", order_by="k")])["increasing:t"]
    assert (row["element_count"], row["unexpected_count"]) == (2, 1)


def test_equal_neighbours(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "k int, v int")
    assert results(df, [r.increasing("v", order_by="k")])["increasing:v"]["success"]
    assert not results(df, [r.increasing("v", order_by="k", strictly=True)])["increasing:v"]["success"]


def test_a_share_is_compared_as_a_ratio(spark):
    df = spark.range(100).selectExpr("if(id < 55, 1, null) AS v")
    assert run_suite(df, [r.not_null("v", mostly=0.55)]).first()["success"]
    assert not run_suite(df, [r.not_null("v", mostly=0.551)]).first()["success"]


def test_suite_from_text(spark):
    text = """{"expectations": [
      {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "v", "mostly": 0.5}, "meta": {"category": "own"}},
      {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1, "max_value": 5}},
      {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "v", "value_set": [1, 2]}}]}"""
    found = {r["rule_type"]: (r["success"], r["category"]) for r in run_suite(spark.createDataFrame([(1,), (3,), (None,)], "v int"), load_suite(text)).collect()}
    assert found["not_null"] == (True, "own") and found["row_count"][0] and not found["in_set"][0]
    for bad in ('{"expectation_type": "expect_magic", "kwargs": {}}', '{"expectation_type": "expect_column_to_exist", "kwargs": {"column": "v", "x": 1}}'):
        with pytest.raises(ValueError):
            load_suite('{"expectations": [' + bad + ']}')


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_exact_quantiles(spark, n):
    values = [None if i % 11 == 5 else float((i * 37) % 101 if i % 3 else 4) for i in range(n)]
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(values)], "a double, b double").repartition(5)
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = {r["name"]: (r["n"], r["values"]) for r in exact_quantiles(df, {"a": df["a"], "b": df["b"]}, qs).collect()}
    for name, column in (("a", [v for v in values if v is not None]), ("b", [float(i) for i in range(n)])):
        column.sort()
        assert found[name] == (len(column), [column[max(1, -(-round(q * len(column), 6) // 1).__int__()) - 1] if column else None for q in qs])
