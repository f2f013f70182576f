"""Is a column rising along an order? Checked over range partitions, never in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def order_violations(df: DataFrame, value: str, order_by: list[str], within: list[str] = (),
                     strictly: bool = False) -> DataFrame:
    """Per `within` group: element_count, and unexpected_count = values below the one before them.

    Rows with a NULL value or a NULL order key are left out. Rows that share an order key have no order
    among themselves; they are taken in rising order of the value, so only `strictly` can find fault
    inside such a tie. Text values are read as timestamps.

    Three steps, none of which puts a group into one task:
      1. rows that share an order key collapse to (lowest, highest, count), before the shuffle;
      2. those are range-partitioned by (group, order) and compared with their neighbour inside a slice;
      3. each slice of a group leaves its first and last value, and the slices are compared in turn.
    """
    within, order_by = list(within), list(order_by)
    v = F.col(value)
    if isinstance(df.schema[value].dataType, T.StringType):
        v = F.try_to_timestamp(v)
    rows = df.select(*within, *order_by, v.alias("_v")).dropna(subset=["_v", *order_by])
    keys = [*within, *order_by]
    if strictly:
        rows = rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
        ties = rows.groupBy(*keys).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"),
                                       F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_bad"))
    else:
        ties = rows.groupBy(*keys).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"),
                                       F.count(F.lit(1)).alias("_n"), F.lit(0).cast("bigint").alias("_bad"))
    falls = (lambda now, before: now <= before) if strictly else (lambda now, before: now < before)

    sliced = ties.repartitionByRange(*keys).withColumn("_slice", F.spark_partition_id())
    along = Window.partitionBy("_slice", *within).orderBy(*order_by)
    compared = sliced.withColumn("_falls", falls(F.col("_low"), F.lag("_high").over(along)))
    position = F.struct(*order_by)
    ends = compared.groupBy("_slice", *within).agg(
        F.sum("_n").alias("_n"),
        (F.sum("_bad") + F.count_if("_falls")).alias("_bad"),
        F.min_by("_low", position).alias("_first"),
        F.max_by("_high", position).alias("_last"))
    # A group has at most one row per slice here, so this window holds as many rows as there are slices.
    seams = Window.partitionBy(*(within or [F.lit(0)])).orderBy("_slice")
    joined = ends.withColumn("_seam", falls(F.col("_first"), F.lag("_last").over(seams)))
    return joined.groupBy(*within).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("element_count"),
        F.coalesce(F.sum("_bad") + F.count_if("_seam"), F.lit(0)).alias("unexpected_count"))
