"""Distributions of whole columns: their distance, and histograms of equal depth with edges that can be stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etlkit.operators.quantiles import exact_quantiles
from etlkit.session import staged


def _cells(df: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    """(column_name, value, more...): one row per filled cell."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
    return df.select(*more, F.inline(cells)).where("value IS NOT NULL")


def ks_distance(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: reference_rows, current_rows (filled), distance, at: the two-sample Kolmogorov-Smirnov distance.

    The distance is the largest gap between the shares of rows that do not exceed a value; `at` is the smallest value where
    it is reached. Both are NULL where a side has no values.

    Equal values of both sides collapse to one row before the shuffle. Those rows are range-partitioned by value; each slice
    adds up from its own start, and the sums of the slices, one row each, say where a slice starts. So the gap is exact
    at every value, and no task sees a column. Gaps are compared as whole numbers, crosswise multiplied.
    """
    both = _cells(reference, columns, F.lit(1).alias("r"), F.lit(0).alias("c")).unionByName(_cells(current, columns, F.lit(0).alias("r"), F.lit(1).alias("c")))
    counts = staged(both.groupBy("column_name", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c")), "value-counts")
    # Written with its slices, so that the slices mean the same to all that reads them.
    slices = staged(counts.repartitionByRange("column_name", "value").withColumn("slice", F.spark_partition_id()), "value-slices")
    sums = slices.groupBy("column_name", "slice").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    whole = Window.partitionBy("column_name")
    earlier = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("column_name", "slice", F.coalesce(F.sum("r").over(earlier), F.lit(0)).alias("r0"), F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("c0"),
                         F.sum("r").over(whole).alias("rn"), F.sum("c").over(whole).alias("cn"))
    inside = Window.partitionBy("column_name", "slice").orderBy("value")
    exact = lambda c: c.cast("decimal(18,0)")
    gap = F.abs(exact(F.col("r0") + F.sum("r").over(inside)) * exact(F.col("cn")) - exact(F.col("c0") + F.sum("c").over(inside)) * exact(F.col("rn")))
    met = slices.join(starts, ["column_name", "slice"]).select("column_name", "value", "rn", "cn", gap.alias("gap"))
    found = met.groupBy("column_name").agg(F.max("rn").alias("reference_rows"), F.max("cn").alias("current_rows"),
                                           F.max(F.struct("gap", (-F.col("value")).alias("v"))).alias("m"))
    share = F.try_divide(F.col("m.gap").cast("double"), (exact(F.col("reference_rows")) * exact(F.col("current_rows"))).cast("double"))
    names = reference.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    zero = F.lit(0).cast("bigint")
    return names.join(F.broadcast(found), "column_name", "left").select(
        "column_name", F.coalesce("reference_rows", zero).alias("reference_rows"), F.coalesce("current_rows", zero).alias("current_rows"),
        share.alias("distance"), F.when(share.isNotNull(), -F.col("m.v")).alias("at"))


# ---- histograms --------------------------------------------------------------------------------------------

def equal_depth_edges(df: DataFrame, columns: list[str], buckets: int = 10) -> DataFrame:
    """column_name, rows, edges: the upper edges of `buckets` buckets of as equal depth as the values allow.

    Edges are exact quantiles without repeats, so a value that fills several buckets ends just one; the last edge is the largest
    value. The result, one row per column, is meant to be stored: `bucket_counts` and `stability` count any later table in
    the same buckets without reading this one again. A column without values has no edges.
    """
    found = exact_quantiles(df, {c: F.col(f"`{c}`") for c in columns}, [k / buckets for k in range(1, buckets + 1)])
    return found.select(F.col("name").alias("column_name"), F.col("n").alias("rows"),
                        F.when(F.col("n") > 0, F.array_distinct("values")).otherwise(F.array().cast("array<double>")).alias("edges"))


def bucket_counts(df: DataFrame, edges: DataFrame) -> DataFrame:
    """column_name, bucket, low (excluded), high (included), n for every bucket of the stored `edges`, also empty ones.

    Values above the last edge count in a further bucket without an upper end, so no value is lost; the first
    bucket has no lower end. One scan; the edges, one row per column, travel inside the expressions.
    """
    stored = {r.column_name: list(r.edges) for r in edges.select("column_name", "edges").collect()}
    if not stored:
        return df.sparkSession.createDataFrame([], "column_name string, bucket int, low double, high double, n bigint")
    cells = []
    for name, ends in stored.items():
        value = F.col(f"`{name}`").cast("double")
        place = F.lit(0)
        for end in ends:  # as many comparisons as buckets, in compiled code
            place = place + (value > end).cast("int")
        cells.append(F.struct(F.lit(name).alias("column_name"), F.when(value.isNotNull(), place).alias("bucket")))
    counted = df.select(F.inline(F.array(*cells))).where("bucket IS NOT NULL").groupBy("column_name", "bucket").agg(F.count(F.lit(1)).alias("n"))
    rows = [(name, k, ends[k - 1] if k else None, ends[k] if k < len(ends) else None) for name, ends in stored.items() for k in range(len(ends) + 1)]
    frame = df.sparkSession.createDataFrame(rows, "column_name string, bucket int, low double, high double")
    return frame.join(F.broadcast(counted), ["column_name", "bucket"], "left").select("column_name", "bucket", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))


def stability(reference_counts: DataFrame, current: DataFrame, edges: DataFrame) -> DataFrame:
    """column_name, reference_rows, current_rows, stability_index: how far a table has moved from stored bucket counts.

    The index adds (q - p) ln(q / p) over the buckets, with p and q the shares (n + 0.5) / (rows + 0.5 buckets), so an empty
    bucket has a share too. 0 is no change; above 0.25 is commonly held to be a shift.
    """
    now = bucket_counts(current, edges).select("column_name", "bucket", F.col("n").alias("m"))
    met = reference_counts.select("column_name", "bucket", "n").join(now, ["column_name", "bucket"])
    whole = Window.partitionBy("column_name")  # as many rows as buckets
    share = lambda c: (F.col(c) + 0.5) / (F.sum(c).over(whole) + 0.5 * F.count(F.lit(1)).over(whole))
    shares = met.select("column_name", "n", "m", share("n").alias("p"), share("m").alias("q"))
    return shares.groupBy("column_name").agg(F.sum("n").alias("reference_rows"), F.sum("m").alias("current_rows"),
                                             F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("stability_index"))
