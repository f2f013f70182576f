"""Data-quality rules. A rule says what to check; `split` and `suite` decide how it runs.

Kinds, by what they need to see:
  RowRule     one boolean per row        - usable in splits and suites
  TotalRule   one aggregate of the table - evaluated together with the row rules in a single pass
  SchemaRule  column names and types     - no data is read
  JobRule     a grouping or a join       - one job of its own, as for MeasureRule
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.functions.audit import moment
from etlkit.operators.ordering import order_violations
from etlkit.operators.quantiles import exact_quantiles

TYPE_FAMILIES = {
    "numeric": T.NumericType,
    "string": T.StringType,
    "date": T.DateType,
    "timestamp": (T.TimestampType, T.TimestampNTZType),
    "boolean": T.BooleanType,
}
# Type names the suite files use, and the family each stands for.
FAMILY_OF = {"float": "numeric", "double": "numeric", "decimal": "numeric", "int": "numeric",
             "integer": "numeric", "bigint": "numeric", "str": "string", "datetime": "timestamp"}
COMPARE = {"=": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le,
           ">": operator.gt, ">=": operator.ge}


@dataclass(frozen=True)
class Rule:
    rule_id: str
    rule_type: str
    category: str
    columns: tuple[str, ...]
    mostly: float = 1.0

    def missing_from(self, df: DataFrame) -> list[str]:
        return [c for c in self.columns if c not in df.columns]


@dataclass(frozen=True)
class RowRule(Rule):
    """`test` gives the condition; rows where a column of `columns` is NULL are outside the denominator
    of a suite unless `counts_nulls`. In a split every row that does not pass, NULLs included, is rejected."""

    test: Callable[[DataFrame], Column] = None
    counts_nulls: bool = False

    def passes(self, df: DataFrame) -> Column:
        return F.coalesce(self.test(df), F.lit(False))

    def applies(self) -> Column:
        if self.counts_nulls or not self.columns:
            return F.lit(True)
        return reduce(operator.and_, [F.col(c).isNotNull() for c in self.columns])


@dataclass(frozen=True)
class TotalRule(Rule):
    value: Callable[[DataFrame], Column] = None
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class SchemaRule(Rule):
    test: Callable[[T.StructType], bool] = None


@dataclass(frozen=True)
class JobRule(Rule):
    """`job` returns one row: element_count, unexpected_count."""

    job: Callable[[DataFrame], DataFrame] = None


@dataclass(frozen=True)
class MeasureRule(Rule):
    """`job` returns one row, observed and element_count, and `observed` must lie in the bounds."""

    job: Callable[[DataFrame], DataFrame] = None
    low: float | None = None
    high: float | None = None


# ---- schema ------------------------------------------------------------------------------------------------

def has_column(column: str, category: str = "schema") -> SchemaRule:
    return SchemaRule(f"has_column:{column}", "has_column", category, (column,),
                      test=lambda s: column in s.names)


def columns_match(names: list[str], exact: bool = False, category: str = "schema") -> SchemaRule:
    wanted = set(names)
    return SchemaRule("columns_match", "columns_match", category, tuple(sorted(wanted)),
                      test=lambda s: wanted == set(s.names) if exact else wanted <= set(s.names))


def has_type(column: str, family: str, category: str = "type") -> SchemaRule:
    kind = TYPE_FAMILIES[FAMILY_OF.get(family, family)]
    return SchemaRule(f"has_type:{column}", "has_type", category, (column,),
                      test=lambda s: column in s.names and isinstance(s[column].dataType, kind))


def schema_differences(found: T.StructType, expected: T.StructType, check_nullable: bool = False) -> list[str]:
    """What `found` lacks or has otherwise than `expected`, one text per difference."""
    out = []
    for field in expected.fields:
        if field.name not in found.names:
            out.append(f"{field.name}: missing")
            continue
        other = found[field.name]
        if other.dataType != field.dataType:
            out.append(f"{field.name}: {other.dataType.simpleString()} instead of {field.dataType.simpleString()}")
        elif check_nullable and other.nullable and not field.nullable:
            out.append(f"{field.name}: nullable")
    return out


def schema_matches(expected: T.StructType, check_nullable: bool = False, category: str = "schema") -> SchemaRule:
    return SchemaRule("schema_matches", "schema_matches", category, tuple(expected.names),
                      test=lambda s: not schema_differences(s, expected, check_nullable))


# ---- one row at a time -------------------------------------------------------------------------------------

def not_null(column: str, mostly: float = 1.0, category: str = "completeness") -> RowRule:
    return RowRule(f"not_null:{column}", "not_null", category, (column,), mostly,
                   test=lambda df: F.col(column).isNotNull(), counts_nulls=True)


def not_blank(column: str, mostly: float = 1.0, category: str = "completeness") -> RowRule:
    """Neither empty nor white space only; NULLs are the business of `not_null`."""
    return RowRule(f"not_blank:{column}", "not_blank", category, (column,), mostly,
                   test=lambda df: F.trim(F.col(column)) != "")


def matches(column: str, pattern: str, mostly: float = 1.0, category: str = "format") -> RowRule:
    """Java regular expression; a `$` at its end also accepts one trailing newline."""
    return RowRule(f"matches:{column}", "matches", category, (column,), mostly,
                   test=lambda df: F.col(column).rlike(pattern))


def between(column: str, low=None, high=None, mostly: float = 1.0, category: str = "range") -> RowRule:
    """Inclusive; bounds are cast to the column's type, so dates may be given as text."""

    def test(df: DataFrame) -> Column:
        kind = df.schema[column].dataType
        bounds = []
        if low is not None:
            bounds.append(F.col(column) >= F.lit(low).cast(kind))
        if high is not None:
            bounds.append(F.col(column) <= F.lit(high).cast(kind))
        return reduce(operator.and_, bounds, F.lit(True))

    return RowRule(f"between:{column}", "between", category, (column,), mostly, test=test)


def in_set(column: str, values: list, mostly: float = 1.0, category: str = "validity") -> RowRule:
    return RowRule(f"in_set:{column}", "in_set", category, (column,), mostly,
                   test=lambda df: F.col(column).isin(list(values)))


def not_future(column: str, as_of=None, mostly: float = 1.0, category: str = "timeliness") -> RowRule:
    return RowRule(f"not_future:{column}", "not_future", category, (column,), mostly,
                   test=lambda df: F.col(column) <= moment(as_of).cast(df.schema[column].dataType))


def pair_compare(left: str, op: str, right: str, mostly: float = 1.0, category: str = "consistency") -> RowRule:
    """Compare two columns; rows where either is missing are ignored by a suite."""
    return RowRule(f"pair_compare:{left}{op}{right}", "pair_compare", category, (left, right), mostly,
                   test=lambda df: COMPARE[op](F.col(left), F.col(right)))


def sum_equals(columns: list[str], total: float, precision: float = 0.0, mostly: float = 1.0,
               category: str = "consistency") -> RowRule:
    return RowRule(f"sum_equals:{'+'.join(columns)}", "sum_equals", category, tuple(columns), mostly,
                   test=lambda df: F.abs(reduce(operator.add, [F.col(c) for c in columns]) - F.lit(total)) <= precision)


def expr_rule(name: str, condition: str | Column, columns: list[str] = (), mostly: float = 1.0,
              category: str = "custom") -> RowRule:
    """Any boolean SQL text or Column. Rows where a listed column is NULL are ignored by a suite."""
    return RowRule(name, "expr_rule", category, tuple(columns), mostly,
                   test=lambda df: F.expr(condition) if isinstance(condition, str) else condition)


# ---- one value per table -----------------------------------------------------------------------------------

def row_count(low: int | None = None, high: int | None = None, category: str = "volume") -> TotalRule:
    return TotalRule("row_count", "row_count", category, (),
                     value=lambda df: F.count(F.lit(1)).cast("double"), low=low, high=high)


def mean_between(column: str, low: float, high: float, category: str = "statistical") -> TotalRule:
    return TotalRule(f"mean_between:{column}", "mean_between", category, (column,),
                     value=lambda df: F.avg(column).cast("double"), low=low, high=high)


def quantile_between(column: str, q: float, low: float, high: float,
                     category: str = "statistical") -> MeasureRule:
    def job(df: DataFrame) -> DataFrame:
        return exact_quantiles(df, {"s": F.col(column)}, [q]).select(F.get("values", F.lit(0)).alias("observed"), F.col("n").alias("element_count"))

    return MeasureRule(f"quantile_between:{column}:{q}", "quantile_between", category, (column,), job=job, low=low, high=high)


def complete(columns: list[str], at_least: float = 1.0, category: str = "completeness") -> TotalRule:
    """Share of filled cells over the listed columns."""
    filled = lambda df: reduce(operator.add, [F.count(c) for c in columns])
    return TotalRule(f"complete:{'+'.join(columns)}", "complete", category, tuple(columns),
                     value=lambda df: F.try_divide(filled(df).cast("double"), F.count(F.lit(1)) * len(columns)),
                     low=at_least)


def fresh(column: str, as_of, max_lag_seconds: int, category: str = "timeliness") -> TotalRule:
    """The newest value lies at most `max_lag_seconds` before `as_of`."""
    return TotalRule(f"fresh:{column}", "fresh", category, (column,),
                     value=lambda df: (moment(as_of).cast("double")
                                       - F.max(F.col(column).cast("timestamp")).cast("double")),
                     high=max_lag_seconds)


# ---- one job of its own ------------------------------------------------------------------------------------

def unique(columns: str | list[str], mostly: float = 1.0, category: str = "uniqueness") -> JobRule:
    """Every row of a key that occurs more than once counts as unexpected. Keys are counted before they
    are shuffled, so a key that fills the table costs no more than any other."""
    keys = [columns] if isinstance(columns, str) else list(columns)

    def job(df: DataFrame) -> DataFrame:
        return df.select(*keys).dropna("any").groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("element_count"),
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("unexpected_count"))

    return JobRule(f"unique:{'+'.join(keys)}", "unique", category, tuple(keys), mostly, job=job)


def references(column: str, parent: DataFrame, parent_column: str, mostly: float = 1.0,
               category: str = "referential") -> JobRule:
    """Every value occurs in the parent; NULLs are ignored. Both sides are reduced to distinct keys first."""

    def job(df: DataFrame) -> DataFrame:
        known = parent.select(F.col(parent_column).alias("k")).dropna().distinct().withColumn("known", F.lit(True))
        return df.select(F.col(column).alias("k")).dropna().groupBy("k").agg(F.count(F.lit(1)).alias("n")).join(
            known, "k", "left").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("element_count"),
            F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("unexpected_count"))

    return JobRule(f"references:{column}", "references", category, (column,), mostly, job=job)


def increasing(column: str, order_by: str | list[str], within: list[str] = (), strictly: bool = False,
               mostly: float = 1.0, category: str = "timeliness") -> JobRule:
    """Values do not fall when the rows are taken in the order of `order_by`, per `within` group if given."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)

    def job(df: DataFrame) -> DataFrame:
        return order_violations(df, column, order, list(within), strictly).agg(
            F.coalesce(F.sum("element_count"), F.lit(0)).alias("element_count"),
            F.coalesce(F.sum("unexpected_count"), F.lit(0)).alias("unexpected_count"))

    return JobRule(f"increasing:{column}", "increasing", category, (column, *order, *within), mostly, job=job)
