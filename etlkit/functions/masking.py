"""Hashing of sensitive columns, and the check that it happened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEX_DIGEST = "^[0-9a-f]{64}$"


def digest(column: str, salt: str | None = None) -> Column:
    """SHA-256 of the value as text, 64 hex characters; NULL stays NULL."""
    text = F.col(column).cast("string")
    return F.sha2(text if salt is None else F.concat(F.lit(salt), text), 256)


def mask_columns(df: DataFrame, columns: list[str], on_missing: str = "error",
                 salt: str | None = None) -> DataFrame:
    """Replace each listed column by `{column}_masked`, added at the end in the order listed.

    A listed column the table lacks is an error, since a typo would leak data; `on_missing="skip"`
    passes over it.
    """
    if on_missing not in ("error", "skip"):
        raise ValueError(f"on_missing must be 'error' or 'skip', not {on_missing!r}")
    columns = list(dict.fromkeys(columns))
    missing = [c for c in columns if c not in df.columns]
    if missing and on_missing == "error":
        raise ValueError(f"columns to mask are missing: {', '.join(missing)}")
    present = [c for c in columns if c in df.columns]
    kept = [F.col(c) for c in df.columns if c not in present]
    return df.select(*kept, *[digest(c, salt).alias(f"{c}_masked") for c in present])


def masking_check(masked: DataFrame, columns: list[str], original: DataFrame | None = None,
                  keys: list[str] | None = None) -> DataFrame:
    """One row per sensitive column: is the original gone, is every masked value a digest, does any still
    equal its original.

    `leaked_values` needs `original` and the `keys` that pair its rows with the masked ones; it is NULL
    without them. Rows are compared on their distinct (key, value) pairs, so repeated keys do not multiply.
    """
    out = []
    for c in columns:
        name = f"{c}_masked"
        has = name in masked.columns
        out.append((c, c not in masked.columns and has, has))
    counts = []
    for i, (c, _, has) in enumerate(out):
        value = F.col(f"{c}_masked") if has else F.lit(None).cast("string")
        counts.append(F.count(value).alias(f"n{i}"))
        counts.append(F.count_if(~value.rlike(HEX_DIGEST)).alias(f"bad{i}"))
    totals = masked.agg(*counts)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(gone).alias("original_removed"),
                 F.col(f"n{i}").alias("masked_values"), F.col(f"bad{i}").alias("not_digest"))
        for i, (c, gone, _) in enumerate(out)])
    report = totals.select(F.inline(rows))
    if original is None:
        return report.withColumn("leaked_values", F.lit(None).cast("bigint")).withColumn(
            "passed", F.col("original_removed") & (F.col("not_digest") == 0))
    checked = [c for c, _, has in out if has]
    if not checked:
        return report.withColumn("leaked_values", F.lit(None).cast("bigint")).withColumn("passed", F.lit(False))

    def cells(df: DataFrame, name: str, is_masked: bool) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(name.format(c)).cast("string").alias("_value")) for c in checked])
        return df.select(*keys, F.inline(pairs)).withColumn("_masked", F.lit(is_masked)).dropna(subset=[*keys, "_value"])

    # All columns in one grouping; rows of one pair collapse before the shuffle.
    both = cells(masked, "{}_masked", True).unionByName(cells(original, "{}", False))
    met = both.groupBy("column_name", *keys, "_value").agg(F.bool_or("_masked").alias("after"), F.bool_and("_masked").alias("only"))
    leaks = met.where("after AND NOT only").groupBy("column_name").agg(F.count(F.lit(1)).alias("_n"))
    counted = F.when(F.col("column_name").isin(checked), F.coalesce("_n", F.lit(0).cast("bigint")))
    return report.join(leaks, "column_name", "left").withColumn("leaked_values", counted).drop("_n").withColumn(
        "passed", F.col("original_removed") & (F.col("not_digest") == 0)
        & (F.coalesce(F.col("leaked_values"), F.lit(1)) == 0))
