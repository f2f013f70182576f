"""Comparison of a source table with its copy."""

from __future__ import annotations

from functools import reduce
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def in_sample(keys: list[str], one_in: int) -> Column:
    """Keeps about one key in `one_in`, the same keys on every side and in every engine that has MD5."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % one_in == 0


def pair_up(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per key of either side: source_rows, target_rows, and per column source_{c}, target_{c}.

    Gives what a full outer join gives for keys that are unique on each side, with one shuffle and no sort.
    Rows of one key collapse before the shuffle, so a repeated key neither multiplies nor piles up; its
    values are then the largest ones, and its row counts say that it repeats. NULL keys form one row.
    """
    def side(df: DataFrame, is_source: bool) -> DataFrame:
        return df.select(*keys, *columns, F.lit(is_source).alias("_src"))

    both = side(source, True).unionByName(side(target, False))
    sides = []
    for c in columns:
        sides += [F.max(F.when(F.col("_src"), F.col(c))).alias(f"source_{c}"),
                  F.max(F.when(~F.col("_src"), F.col(c))).alias(f"target_{c}")]
    return both.groupBy(*keys).agg(F.count_if("_src").alias("source_rows"),
                                   F.count_if(~F.col("_src")).alias("target_rows"), *sides)


def _differs(paired: DataFrame, c: str, null_safe: bool, tolerance: float) -> Column:
    a, b = F.col(f"source_{c}"), F.col(f"target_{c}")
    unequal = a != b
    if tolerance and isinstance(paired.schema[f"source_{c}"].dataType, T.NumericType):
        unequal = F.abs(a - b) > tolerance
    if null_safe:
        return F.coalesce(unequal, a.isNull() != b.isNull())
    return F.coalesce(unequal, F.lit(False))


def reconcile(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], null_safe: bool = True,
              tolerance: float = 0.0, sample: int | None = None, keep_matches: bool = False) -> DataFrame:
    """Keys on which source and target disagree, with `status`:

    missing_in_source, missing_in_target, mismatch, duplicate_key (more than one row on a side), null_key, and
    match if `keep_matches`. With `null_safe` a NULL differs from a value; without, NULLs are never a mismatch.
    Numeric columns also get `difference_{c}`. `sample=n` compares about one key in n.
    """
    if sample:
        source, target = source.where(in_sample(keys, sample)), target.where(in_sample(keys, sample))
    paired = pair_up(source, target, keys, columns)
    differs = reduce(operator.or_, [_differs(paired, c, null_safe, tolerance) for c in columns], F.lit(False))
    status = (F.when(reduce(operator.or_, [F.col(k).isNull() for k in keys]), "null_key")
              .when((F.col("source_rows") > 1) | (F.col("target_rows") > 1), "duplicate_key")
              .when(F.col("source_rows") == 0, "missing_in_source")
              .when(F.col("target_rows") == 0, "missing_in_target")
              .when(differs, "mismatch").otherwise("match"))
    gaps = [F.abs(F.col(f"source_{c}") - F.col(f"target_{c}")).alias(f"difference_{c}") for c in columns
            if isinstance(paired.schema[f"source_{c}"].dataType, T.NumericType)]
    values = [name for c in columns for name in (f"source_{c}", f"target_{c}")]
    report = paired.select(*keys, status.alias("status"), "source_rows", "target_rows", *values, *gaps)
    return report if keep_matches else report.where("status <> 'match'")


def reconcile_literal(source: DataFrame, target: DataFrame, key: str, column: str) -> DataFrame:
    """The report as first published, a full outer join: rows only the target has show no key, NULL keys match
    nothing, a key that repeats is compared row by row, and a NULL against a value is not a mismatch.

    `reconcile` collapses keys instead, which bounds its result where keys repeat often.
    """
    s = source.select(F.col(key).alias("_s"), F.col(column).alias("_a"))
    t = target.select(F.col(key).alias("_t"), F.col(column).alias("_b"))
    a, b = F.col("_a"), F.col("_b")
    return s.join(t, F.col("_s") == F.col("_t"), "full_outer").where((a != b) | F.col("_s").isNull() | F.col("_t").isNull()).select(
        F.col("_s").alias(key), a.alias(f"source_{column}"), b.alias(f"target_{column}"), F.abs(a - b).alias("difference"))


def accuracy_rate(df: DataFrame, trusted: DataFrame, keys: list[str], columns: list[str],
                  tolerance: float = 0.0) -> DataFrame:
    """One row: compared (keys on either side), agreeing, accuracy."""
    statuses = reconcile(df, trusted, keys, columns, tolerance=tolerance, keep_matches=True)
    totals = statuses.agg(F.count(F.lit(1)).alias("compared"), F.count_if(F.col("status") == "match").alias("agreeing"))
    return totals.withColumn("accuracy", F.try_divide(F.col("agreeing").cast("double"), F.col("compared").cast("double")))


def row_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Whole rows that one table has more often than the other: the row, `only_in`, and `copies` too many.

    A bag difference in both directions from one grouping; copies are counted, not repeated.
    """
    columns = [f"`{c}`" for c in source.columns]
    both = source.withColumn("_sign", F.lit(1)).unionByName(target.select(*columns).withColumn("_sign", F.lit(-1)))
    net = both.groupBy(*columns).agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    return net.select(*columns, F.when(F.col("_net") > 0, "source").otherwise("target").alias("only_in"),
                      F.abs("_net").alias("copies"))


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Pass `df` through if it has the required columns, upper or lower case; raise otherwise."""
    have = {c.lower() for c in df.columns}
    missing = sorted(c for c in {r.lower() for r in required} if c not in have)
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df
