"""Checks after a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GateFailed(Exception):
    pass


def post_load_gate(df: DataFrame, as_of: str, id_column: str = "patient_id", date_column: str = "admission_date",
                   load_column: str = "load_timestamp") -> DataFrame:
    """One row over the rows loaded on `as_of`: total_rows, null_ids, future_dates, passed."""
    today = F.lit(as_of).cast("date")
    loaded = df.where(F.to_date(load_column) == today).select(id_column, date_column)
    counts = loaded.agg(F.count(F.lit(1)).alias("total_rows"),
                        F.count_if(F.col(id_column).isNull()).alias("null_ids"),
                        F.count_if(F.to_date(date_column) > today).alias("future_dates"))
    return counts.withColumn("passed", F.expr("total_rows > 0 AND null_ids = 0 AND future_dates = 0"))


def enforce_gate(report: DataFrame) -> None:
    """Raise `GateFailed` unless the one-row report passed."""
    row = report.first()
    problems = []
    if row["total_rows"] == 0:
        problems.append("no rows loaded")
    if row["null_ids"]:
        problems.append(f"{row['null_ids']} rows without id")
    if row["future_dates"]:
        problems.append(f"{row['future_dates']} dates in the future")
    if problems:
        raise GateFailed("; ".join(problems))
