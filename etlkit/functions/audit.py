from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(as_of: dt.datetime | dt.date | str | Column | None) -> Column:
    """A timestamp column; None means the time the query runs."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(as_of).cast("timestamp")


def add_audit(df: DataFrame, as_of=None, column: str = "processed_at") -> DataFrame:
    """Stamp every row with the processing time. Pass `as_of` to make reruns give the same rows."""
    return df.withColumn(column, moment(as_of))
