"""Totals kept up to date from changes alone: every image of a row counts +1 or -1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.functions.arrays import array_of
from etlkit.operators.rollups import MONEY, TOTAL, _with_average

TOTALS = ["claim_month", "total_claims", "amount_count", "total_amount"]


def signed_rows(changes: DataFrame, before: str = "before", after: str = "after", once: list[str] = ()) -> DataFrame:
    """The images of the changes as rows with `_sign`: -1 for what was there, +1 for what is there now.

    An insert has no image before it, a delete none after it, and an update that moves a row to another group has one in
    each. Messages that repeat are taken once if `once` names the columns that identify a change.
    """
    if once:
        changes = changes.dropDuplicates(list(once))
    images = array_of(*[(F.col(c).isNotNull(), F.struct(F.lit(sign).alias("_sign"), F.col(c).alias("_row"))) for c, sign in ((before, -1), (after, 1))])
    return changes.select(F.inline(images)).select("_sign", "_row.*")


def signed_rollup(rows: DataFrame, date_column: str = "claim_date", amount_column: str = "claim_amount") -> DataFrame:
    """What `signed_rows` change in the monthly totals: TOTALS per month, of either sign; months that come out even are left out.

    Added up before the shuffle, so it moves one row per month and task.
    """
    sign, amount = F.col("_sign"), F.col(amount_column).cast(MONEY)
    sums = rows.groupBy(F.trunc(date_column, "month").alias("claim_month")).agg(
        F.sum(sign.cast("bigint")).alias("total_claims"), F.sum(F.when(amount.isNotNull(), sign).otherwise(0).cast("bigint")).alias("amount_count"),
        F.sum(F.when(sign > 0, amount).otherwise(-amount)).cast(TOTAL).alias("total_amount"))
    even = (F.col("total_claims") == 0) & (F.col("amount_count") == 0) & (F.coalesce("total_amount", F.lit(0)) == 0)
    return sums.where(~even)


def maintain_rollup(view: DataFrame, delta: DataFrame) -> DataFrame:
    """The view of `monthly_rollup` after a delta of `signed_rollup`, without the base table.

    Months in which no row is left disappear, and a month whose amounts are all unknown has no total, as if all had been
    computed anew. Both tables have one row per month. A total below zero means that the changes do not belong to the view:
    it fails.
    """
    both = view.select(*TOTALS).unionByName(delta.select(*TOTALS)).groupBy("claim_month").agg(
        F.sum("total_claims").alias("total_claims"), F.sum("amount_count").alias("amount_count"), F.sum("total_amount").cast(TOTAL).alias("total_amount"))
    sound = F.when((F.col("total_claims") < 0) | (F.col("amount_count") < 0) | (F.col("amount_count") > F.col("total_claims")),
                   F.raise_error(F.concat(F.lit("the changes do not belong to the total of "), F.coalesce(F.col("claim_month").cast("string"), F.lit("no month")))).cast("bigint"))
    kept = both.withColumn("total_claims", F.coalesce(sound, "total_claims")).where("total_claims <> 0")
    return _with_average(kept.withColumn("total_amount", F.when(F.col("amount_count") > 0, F.col("total_amount"))))
