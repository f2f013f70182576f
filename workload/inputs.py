"""The given tables, read under the names the queries use them by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etlkit.session import configure


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def claims(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as claims."""
    return load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("claim_id"), F.col("o_custkey").alias("patient_id"),
        F.col("o_totalprice").alias("claim_amount"), F.to_date("o_orderdate").alias("claim_date"),
        F.col("o_orderstatus").alias("claim_status"), F.col("o_orderpriority").alias("priority"))


CLAIMS_SQL = """claims AS (SELECT o_orderkey AS claim_id, o_custkey AS patient_id, o_totalprice AS claim_amount,
  CAST(o_orderdate AS DATE) AS claim_date, o_orderstatus AS claim_status, o_orderpriority AS priority FROM orders)"""


def line_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Line items summed per order: what the claim amounts are checked against."""
    return load(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("claim_id")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("claim_amount"))


def open_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Claims whose amount is not known while their status is P."""
    known = F.when(F.col("claim_status") != "P", F.col("claim_amount").cast("decimal(18,2)"))
    return claims(spark, folder).select("claim_id", known.alias("claim_amount"))


RECONCILE_SQL = """
s AS (SELECT o_orderkey AS claim_id, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS claim_amount
      FROM orders),
t AS (SELECT l_orderkey AS claim_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS claim_amount
      FROM lineitem GROUP BY 1)"""
