"""Monthly totals and their refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
TOTAL = "decimal(38,2)"


def _with_average(totals: DataFrame) -> DataFrame:
    mean = F.try_divide(F.col("total_amount").cast("double"), F.col("amount_count").cast("double"))
    return totals.withColumn("avg_amount", mean)


def monthly_rollup(df: DataFrame, date_column: str = "claim_date", amount_column: str = "claim_amount",
                   extra: list[Column] = ()) -> DataFrame:
    """claim_month, total_claims, amount_count, total_amount, avg_amount, and the `extra` aggregates.

    Amounts are summed as decimals, so the total does not depend on the order of the rows; the count of
    filled amounts is kept so that rollups can be added up and their averages still come out right.
    """
    return _with_average(df.groupBy(F.trunc(date_column, "month").alias("claim_month")).agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.count(amount_column).alias("amount_count"),
        F.sum(F.col(amount_column).cast(MONEY)).cast(TOTAL).alias("total_amount"), *extra))


def refresh_monthly(view: DataFrame, added: DataFrame, date_column: str = "claim_date",
                    amount_column: str = "claim_amount") -> DataFrame:
    """The view brought up to date with `added` rows, without reading the base table.

    The view has one row per month, so adding the new rollup to it is a small job. For changed or deleted
    rows use `recompute_months`.
    """
    names = ["claim_month", "total_claims", "amount_count", "total_amount"]
    delta = monthly_rollup(added, date_column, amount_column).select(*names)
    return _with_average(view.select(*names).unionByName(delta).groupBy("claim_month").agg(
        F.sum("total_claims").alias("total_claims"), F.sum("amount_count").alias("amount_count"),
        F.sum("total_amount").cast(TOTAL).alias("total_amount")))


def recompute_months(base: DataFrame, changed: DataFrame, date_column: str = "claim_date",
                     amount_column: str = "claim_amount") -> DataFrame:
    """Rollup of the months in which `changed` rows fall, from the base table."""
    months = changed.select(F.trunc(date_column, "month").alias("_month")).distinct()
    touched = base.withColumn("_month", F.trunc(date_column, "month")).join(months, "_month", "left_semi")
    return monthly_rollup(touched, date_column, amount_column)
