"""Quantiles of whole columns: exact by range slices, or approximate from sketches of bounded size."""

from __future__ import annotations

import math
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from etlkit.functions.arrays import array_of
from etlkit.session import staged

MERGERS = 256
# Size parameter of the sketches: rank error about 0.1 %, and some 100 KB per sketch, whatever the row count.
DEFAULT_K = 4_000
BRACKET_K = 1_000  # rank error about 0.3 %, well inside BAND
BAND = 0.01
SAMPLE = 0.05  # share of the rows that brackets are guessed from
FEW_VALUES = 100_000  # values that need not be cut into slices to be ranked


def _brackets(df: DataFrame, columns: dict[str, Column], quantiles: list[float]) -> dict[tuple[str, int], tuple]:
    """Per column and quantile a low and a high value around it, from a sketch of sampled rows; None stands for an open end."""
    ends = [min(max(end, 0.0), 1.0) for q in quantiles for end in (q - BAND, q + BAND)]
    found = approximate_quantiles(df.sample(SAMPLE, 7), columns, ends, BRACKET_K).first()
    return {(name, i): (found[name][2 * i] if q > BAND else None, found[name][2 * i + 1] if q < 1 - BAND else None)
            for name in columns for i, q in enumerate(quantiles)}


def exact_quantiles(df: DataFrame, columns: dict[str, Column], quantiles: list[float]) -> DataFrame:
    """Per column: name, n (filled values) and `values`, one per quantile, in their order; NULL without values.

    The quantile `q` is the smallest value that at least the share `q` of the values does not exceed. See
    `quantiles_and_totals`.
    """
    return quantiles_and_totals(df, columns, quantiles)[0]


def quantiles_and_totals(df: DataFrame, columns: dict[str, Column], quantiles: list[float], totals: list[Column] = ()) -> tuple[DataFrame, Row]:
    """`exact_quantiles`, and one row of the aggregates `totals`, taken on the way.

    A sketch of sampled rows gives a bracket of some 2 * BAND of the values around each quantile. One scan counts the values
    below each bracket, a second one takes only the values inside, and the wanted rank is looked up among them. Where it does
    not lie inside, the bracket is opened, so the sample decides what is read and moved, never the result. Equal values are
    counted before the shuffle: a value is one row however often it occurs. No task sees a column, and the driver sees a few
    numbers per quantile.
    """
    values = {name: c.cast("double") for name, c in columns.items()}
    brackets = _brackets(df, columns, quantiles)
    below = [(f"_below{k}", F.count_if(values[name] < lo)) for k, ((name, _), (lo, _)) in enumerate(brackets.items()) if lo is not None]
    row = df.agg(*totals, *[F.count(v).alias(f"_n{j}") for j, v in enumerate(values.values())], *[c.alias(n) for n, c in below]).first()
    n = {name: row[f"_n{j}"] for j, name in enumerate(columns)}
    asked = {}
    for k, ((name, i), (lo, hi)) in enumerate(brackets.items()):
        rank, before = max(1, math.ceil(round(quantiles[i] * n[name], 6))), row[f"_below{k}"] if lo is not None else 0
        if n[name]:
            asked[name, i] = (lo, hi, rank - before) if rank > before else (None, None, rank)
    found = _ranked(df, values, asked)
    missed = {key: (None, None, max(1, math.ceil(round(quantiles[key[1]] * n[key[0]], 6)))) for key in asked if key not in found}
    found |= _ranked(df, values, missed)
    rows = [(name, n[name], [found.get((name, i)) for i in range(len(quantiles))]) for name in columns]
    return df.sparkSession.createDataFrame(rows, "name string, n bigint, values array<double>"), row


def _ranked(df: DataFrame, values: dict[str, Column], asked: dict[tuple[str, int], tuple]) -> dict[tuple[str, int], float]:
    """The value of the given rank among those from low to high, for each (column, quantile) for which there is one."""
    if not asked:
        return {}
    cells = []
    for (name, i), (lo, hi, _) in asked.items():
        v = values[name]
        inside = reduce(operator.and_, [v >= lo] * (lo is not None) + [v <= hi] * (hi is not None), v.isNotNull())
        cells.append((inside, F.struct(F.lit(name).alias("name"), F.lit(i).alias("i"), v.alias("value"))))
    counts = df.select(F.inline(array_of(*cells))).groupBy("name", "i", "value").agg(F.count(F.lit(1)).alias("c"))
    ranks = df.sparkSession.createDataFrame([(name, i, rank) for (name, i), (_, _, rank) in asked.items()], "name string, i int, rank bigint")
    # Written with its slices, so that the slices mean the same to all that reads them.
    counts = staged(counts, "quantiles")
    if counts.count() <= FEW_VALUES:
        slices = counts.withColumn("slice", F.lit(0))
    else:
        slices = staged(counts.repartitionByRange("name", "i", "value").withColumn("slice", F.spark_partition_id()), "quantile-slices")
    # As many rows as quantiles and slices.
    sums = slices.groupBy("name", "i", "slice").agg(F.sum("c").alias("c"))
    running = Window.partitionBy("name", "i").orderBy("slice")
    held = sums.withColumn("upto", F.sum("c").over(running)).withColumn("before", F.col("upto") - F.col("c")).drop("c").join(
        F.broadcast(ranks), ["name", "i"]).where("rank > before AND rank <= upto")
    along = Window.partitionBy("name", "i").orderBy("value")
    hits = slices.join(F.broadcast(held), ["name", "i", "slice"]).withColumn("_to", F.col("before") + F.sum("c").over(along)).where(
        (F.col("_to") >= F.col("rank")) & (F.col("_to") - F.col("c") < F.col("rank")))
    return {(r.name, r.i): r.value for r in hits.select("name", "i", "value").collect()}


def approximate_quantiles(df: DataFrame, columns: dict[str, Column], quantiles: list[float], k: int = DEFAULT_K) -> DataFrame:
    """One row: per column an array of approximate quantiles, in one pass.

    Each task sketches its rows; `MERGERS` tasks merge those of the others, and one task merges the outcome.
    With a single merge step the last task would receive one sketch from every task of the job. The error of a
    rank is about 0.1 % at the default `k`.
    """
    # Numbered inside, so that a name may hold a dot.
    named = df.select(*[c.cast("double").alias(f"c{j}") for j, c in enumerate(columns.values())])
    numbers = [f"c{j}" for j in range(len(columns))]
    first = named.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("_merger")).agg(
        *[F.kll_sketch_agg_double(c, F.lit(k)).alias(c) for c in numbers])
    merged = first.agg(*[F.kll_merge_agg_double(c, F.lit(k)).alias(c) for c in numbers])

    def of(c: str, q: float) -> Column:
        return F.when(F.kll_sketch_get_n_double(F.col(c)) > 0, F.kll_sketch_get_quantile_double(F.col(c), F.lit(float(q))))

    return merged.select(*[F.array(*[of(c, q) for q in quantiles]).alias(name) for c, name in zip(numbers, columns)])
