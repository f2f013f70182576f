"""A third of all rows share one key: plans must divide them, results must not change."""

import pytest
from pyspark.sql import functions as F

from etlkit.operators import as_of_join, key_lookup, latest_per_key, reconcile, upsert

N = 60_000


@pytest.fixture
def small_thresholds(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Rows 0, 3, 6, ... have key 0; written as several files so that the hot key comes from several tasks."""
    path = str(tmp_path_factory.mktemp("hot") / "facts")
    spark.range(0, N, 1, 8).selectExpr("if(id % 3 = 0, 0, id) AS patient_id", "id AS claim_id", "uuid() AS filler",
                                       "date_add(date'2020-01-01', int(id % 700)) AS claim_date").write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_point_in_time_join_splits_a_hot_key(spark, hot, small_thresholds):
    dim = spark.range(N).selectExpr("id AS patient_id", "id AS patient_key", "date'2020-01-01' AS effective_date", "cast(null AS date) AS expiration_date")
    out = as_of_join(hot, dim, "patient_id", "claim_date", ["patient_key"])
    assert "isSkew=true" in final_plan(out) or "skew=true" in final_plan(out)
    assert out.where("patient_key = patient_id").count() == N


def test_key_lookup_splits_a_hot_key(spark, hot, small_thresholds):
    dim = spark.range(1, N).selectExpr("id AS patient_id", "id * 10 AS patient_key")
    out = key_lookup(hot, dim, "patient_id", "patient_key")
    plan = final_plan(out)
    assert "isSkew=true" in plan or "skew=true" in plan
    assert out.where("patient_key = -1").count() == N // 3


def test_upsert_with_a_hot_target_and_hot_changes(spark, hot, small_thresholds):
    target = hot.select(F.col("claim_id"), F.lit(0).alias("v"))
    changes = hot.select(F.col("patient_id").alias("claim_id"), F.col("claim_id").alias("seq"), F.lit(1).alias("v"))
    out = upsert(target, changes, ["claim_id"], "seq", ["v"], stamp=None)
    assert out.count() == N and out.where("v = 1").count() == changes.select("claim_id").distinct().count()


def test_hot_versions_are_reduced_before_the_shuffle(spark, hot):
    out = latest_per_key(hot, ["patient_id"], "claim_id", ["claim_date"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("Partial"), plan.index("Exchange")
    assert after < before, "the partial rank limit lies below the exchange"
    assert out.where("patient_id = 0").first()["claim_id"] == N - 3


def test_reconcile_collapses_a_hot_key(spark, hot):
    report = {r["patient_id"]: r for r in reconcile(hot, hot.where("claim_id % 2 = 0"), ["patient_id"], ["claim_date"]).where("patient_id = 0").collect()}
    assert (report[0]["status"], report[0]["source_rows"], report[0]["target_rows"]) == ("duplicate_key", N // 3, N // 6)
