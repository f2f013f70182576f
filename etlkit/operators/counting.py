"""Counts and duplicate reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One labelled count per table: source, row_count."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(label).alias("source"), "row_count")
             for label, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def row_count_match(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: source_rows, target_rows, difference, matched."""
    tagged = source.select(F.lit(1).alias("side")).unionByName(target.select(F.lit(2).alias("side")))
    counts = tagged.agg(F.count_if(F.col("side") == 1).alias("source_rows"),
                        F.count_if(F.col("side") == 2).alias("target_rows"))
    return counts.withColumn("difference", F.col("target_rows") - F.col("source_rows")).withColumn(
        "matched", F.col("difference") == 0)


def find_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with occurrence_count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrence_count")).where("occurrence_count > 1")
