"""Profiles of columns, tables and loads."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from etlkit.functions.audit import moment
from etlkit.operators.quantiles import exact_quantiles, quantiles_and_totals


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, null_count, null_percentage; the percentage of an empty table is NULL."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column_name"), (F.col("total") - F.col(f"n{i}")).alias("null_count"),
                     F.col("total").alias("total")) for i, c in enumerate(columns)]
    share = F.try_divide(F.col("null_count").cast("double") * 100.0, F.col("total").cast("double"))
    return counts.select(F.inline(F.array(*rows))).select(
        "column_name", "null_count", F.round(share, 2).alias("null_percentage"))


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: cells, filled_cells, completeness = filled / cells over the listed columns."""
    filled = reduce(operator.add, [F.count(c) for c in columns])
    totals = df.agg((F.count(F.lit(1)) * len(columns)).alias("cells"), filled.alias("filled_cells"))
    return totals.withColumn("completeness",
                             F.try_divide(F.col("filled_cells").cast("double"), F.col("cells").cast("double")))


def freshness(df: DataFrame, column: str, as_of, max_lag_seconds: int) -> DataFrame:
    """One row: newest value, its lag behind `as_of`, and whether it is fresh."""
    totals = df.agg(F.max(column).alias("latest"))
    lag = moment(as_of).cast("double") - F.col("latest").cast("timestamp").cast("double")
    return totals.withColumn("lag_seconds", lag).withColumn(
        "is_fresh", F.coalesce(F.col("lag_seconds") <= max_lag_seconds, F.lit(False)))


def lag_percentiles(df: DataFrame, column: str, as_of, quantiles: list[float] = (0.5, 0.95)) -> DataFrame:
    """One row: how far the rows lie behind `as_of`, in seconds, as `lag_p50`, `lag_p95`, ..."""
    lag = moment(as_of).cast("double") - F.col(column).cast("timestamp").cast("double")
    return exact_quantiles(df, {"lag": lag}, list(quantiles)).select(
        *[F.get("values", F.lit(i)).alias(f"lag_p{q * 100:g}") for i, q in enumerate(quantiles)])


def profile_numeric(df: DataFrame, columns: list[str], quantiles: list[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column: filled rows, min, max, mean, stddev and exact quantiles named `p25`, `p50`, ...

    Three scans of the listed columns: sketches; moments with the counts around each quantile; the values near them.
    """
    wanted = [float(q) for q in quantiles]
    totals = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        totals += [F.count(c).alias(f"n{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
                   F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"sd{i}")]
    found, row = quantiles_and_totals(df, {c: F.col(c) for c in columns}, wanted, totals)
    moments = df.sparkSession.createDataFrame(
        [(c, *(row[f"{m}{i}"] for m in ("n", "min", "max", "mean", "sd"))) for i, c in enumerate(columns)],
        "column_name string, filled bigint, min double, max double, mean double, stddev double")
    at = found.select(F.col("name").alias("column_name"), *[F.get("values", F.lit(i)).alias(f"p{q * 100:g}") for i, q in enumerate(wanted)])
    # One row per column on either side.
    return moments.join(F.broadcast(at), "column_name")


def volume_anomalies(df: DataFrame, column: str, trailing: int = 7, z: float = 3.0,
                     fill_gaps: bool = True) -> DataFrame:
    """Rows per day against the `trailing` days before it: day, n, mean, stddev, z_score, is_anomaly.

    With `fill_gaps` a day without rows counts as a day with zero rows. A z-score needs two earlier days
    that differ; it is NULL otherwise.
    """
    daily = df.select(F.to_date(column).alias("day")).dropna().groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    if fill_gaps:
        span = daily.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a IS NOT NULL")
        days = span.select(F.explode(F.sequence("a", "b")).alias("day"))
        daily = days.join(daily, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))
    # One row per calendar day, however large the table: a single ordered window is bounded.
    before = Window.partitionBy(F.lit(0)).orderBy("day").rowsBetween(-trailing, -1)
    scored = daily.select("day", "n", F.avg("n").over(before).alias("mean"),
                          F.stddev_samp("n").over(before).alias("stddev"))
    score = F.try_divide(F.col("n") - F.col("mean"), F.col("stddev"))
    return scored.withColumn("z_score", score).withColumn(
        "is_anomaly", F.coalesce(F.abs("z_score") > z, F.lit(False)))
