"""Search for sensitive values anywhere in a table that should not hold them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.session import staged

FILTER_BITS = 1 << 26  # 8 MB, whatever the number of values; more values only mean more hits to confirm
PROBES = 4


def _cells(df: DataFrame, columns: list[str], name: str, more: list[Column] = ()) -> DataFrame:
    """(name, value): the filled cells of the listed columns as text."""
    cells = F.array(*[F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    return df.select(F.inline(cells)).where(F.col("value").isNotNull())


def _filter_of(values: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of the column `value`: the words of bits that are set, added up by their number before and after the shuffle."""
    places = F.array(*[F.pmod(F.xxhash64(F.lit(k), "value"), F.lit(bits)) for k in range(PROBES)])
    words = values.select(F.explode(places).alias("place")).groupBy(F.shiftright("place", 5).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(place % 32 AS INT))")).alias("bits"))
    out = np.zeros(bits // 32, np.uint32)
    packed = words.toPandas()  # at most bits / 32 rows
    out[packed["word"].to_numpy(np.int64)] = packed["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def find_leaked_values(output: DataFrame, original: DataFrame, sensitive: list[str], allowed: dict[str, list[str]] | None = None,
                       least_length: int = 1, bits: int = FILTER_BITS) -> DataFrame:
    """sensitive_column, found_in, cells, values: original values of sensitive columns that stand in cells of the output, in any row and column.

    All values are compared as text. `allowed` names, per sensitive column, output columns where its values may stand; values
    shorter than `least_length` are passed over, since short ones are found anywhere. `cells` counts output cells, `values`
    different values. Columns without a leak have no row.

    The values are put into a Bloom filter of a fixed size, which is sent to all tasks; every cell of every output column is held against
    it. The few cells that pass, added up by value, are joined with the distinct originals, so what is reported is exact.
    """
    if bits % 32:
        raise ValueError("a filter consists of words of 32 bits")
    long_enough = F.length("value") >= least_length
    originals = staged(_cells(original, sensitive, "sensitive_column").where(long_enough).distinct(), "original-values")
    sent = output.sparkSession.sparkContext.broadcast(_filter_of(originals.select("value").distinct(), bits))

    @F.pandas_udf("boolean")
    def held(*places: pd.Series) -> pd.Series:
        words, found = sent.value, np.ones(len(places[0]), bool)
        for p in places:
            at = p.to_numpy()
            found &= words[at >> 5] >> (at & 31).astype(np.uint32) & 1 == 1
        return pd.Series(found)

    cells = _cells(output, output.columns, "found_in").where(long_enough)
    hits = cells.where(held(*[F.pmod(F.xxhash64(F.lit(k), "value"), F.lit(bits)) for k in range(PROBES)]))
    counted = hits.groupBy("found_in", "value").agg(F.count(F.lit(1)).alias("cells"))
    leaks = counted.join(originals, "value")
    for column, places in (allowed or {}).items():
        leaks = leaks.where((F.col("sensitive_column") != column) | ~F.col("found_in").isin(places))
    return leaks.groupBy("sensitive_column", "found_in").agg(F.sum("cells").alias("cells"), F.count(F.lit(1)).alias("values"))
