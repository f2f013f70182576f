"""Run a list of rules over a table."""

from __future__ import annotations

import json
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.operators.rules import (JobRule, MeasureRule, RowRule, Rule, SchemaRule, TotalRule, between, columns_match,
                                    has_column, has_type, in_set, increasing, matches, mean_between, not_null,
                                    pair_compare, row_count, sum_equals, unique)

class SuiteFailed(Exception):
    """At least one rule of a suite failed; `failures` holds their ids."""

    def __init__(self, failures: list[str]):
        super().__init__(f"failed rules: {', '.join(failures)}")
        self.failures = failures


RATIO, BOUNDS, FIXED = "ratio", "bounds", "fixed"
META = ("array<struct<rule_id:string, rule_type:string, column:string, category:string, verdict:string, mostly:double,"
        " low:double, high:double, fixed:boolean>>")


def _verdict(rule: Rule, df: DataFrame) -> dict:
    """How the rule's result follows from its measures: a share of passing elements, a value in bounds, or
    nothing but the schema."""
    out = {"rule_id": rule.rule_id, "rule_type": rule.rule_type, "column": ",".join(rule.columns) or None,
           "category": rule.category, "verdict": RATIO, "mostly": rule.mostly}
    if isinstance(rule, SchemaRule):
        out.update(verdict=FIXED, fixed=rule.test(df.schema))
    elif rule.missing_from(df):
        out.update(verdict=FIXED, fixed=False)
    elif isinstance(rule, (TotalRule, MeasureRule)):
        out.update(verdict=BOUNDS, low=rule.low, high=rule.high)
    return out


def run_suite(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One result row per rule, as a lazy DataFrame.

    Row and total rules of the whole suite share one aggregation, hence one scan; schema rules read no data;
    each uniqueness, reference, order or quantile rule adds one job over the columns it names. A rule on a
    column the table lacks fails, rather than stopping the suite.
    """
    if len({r.rule_id for r in rules}) < len(rules):
        raise ValueError("rule ids must be unique within a suite")
    verdicts = [_verdict(rule, df) for rule in rules]
    totals, shared, jobs = [F.count(F.lit(1)).alias("total")], [], []
    for i, (rule, verdict) in enumerate(zip(rules, verdicts)):
        n = bad = value = None
        if verdict["verdict"] == FIXED:
            pass
        elif isinstance(rule, RowRule):
            n, bad = f"n{i}", f"bad{i}"
            totals += [F.count_if(rule.applies()).alias(n), F.count_if(rule.applies() & ~rule.passes(df)).alias(bad)]
        elif isinstance(rule, TotalRule):
            n, value = "total", f"value{i}"
            totals.append(rule.value(df).cast("double").alias(value))
        elif isinstance(rule, JobRule):
            jobs.append(rule.job(df).selectExpr(f"{i} AS i", "bigint(element_count) AS n", "bigint(unexpected_count) AS bad",
                                                "double(null) AS value"))
            continue
        elif isinstance(rule, MeasureRule):
            jobs.append(rule.job(df).selectExpr(f"{i} AS i", "bigint(element_count) AS n", "bigint(null) AS bad",
                                                "double(observed) AS value"))
            continue
        else:
            raise TypeError(f"not a rule: {rule!r}")
        shared.append(f"named_struct('i', {i}, 'n', bigint({n or 'null'}), 'bad', bigint({bad or 'null'}), "
                      f"'value', double({value or 'null'}))")
    parts = [df.agg(*totals).selectExpr(f"inline(array({', '.join(shared)}))")] if shared else []
    measures = reduce(DataFrame.unionByName, [*parts, *jobs])
    described = measures.withColumn("r", F.from_json(F.lit(json.dumps(verdicts)), META)[F.col("i")])
    return described.selectExpr(
        "r.rule_id", "r.rule_type", "r.column", "r.category",
        f"""CASE r.verdict WHEN '{FIXED}' THEN r.fixed WHEN '{RATIO}' THEN n = 0 OR double(n - bad) / n >= r.mostly
            ELSE value IS NOT NULL AND value >= coalesce(r.low, value) AND value <= coalesce(r.high, value) END AS success""",
        f"CASE r.verdict WHEN '{RATIO}' THEN try_divide(double(n - bad), n) ELSE value END AS observed",
        "n AS element_count", "bad AS unexpected_count", "try_divide(100 * double(bad), n) AS unexpected_pct")


def raise_on_failure(result: DataFrame) -> DataFrame:
    """Raise `SuiteFailed` unless every rule passed; `result` has one row per rule."""
    failures = [r["rule_id"] for r in result.where(~F.col("success")).select("rule_id").collect()]
    if failures:
        raise SuiteFailed(sorted(failures))
    return result


def claims_suite() -> list[Rule]:
    """The published 19-entry suite for the claims quality table."""
    # Fixed values of the published suite: bounds, patterns, thresholds and sets.
    return [
        row_count(1_000, 10_000_000),
        has_column("patient_id"),
        has_column("diagnosis_code"),
        has_column("visit_date"),
        has_column("provider_id"),
        not_null("patient_id"),
        not_null("visit_date", mostly=0.99),
        unique("patient_id"),
        matches("patient_id", "^P[0-9]{8}$"),
        matches("diagnosis_code", r"^[A-Z][0-9]{2}(\.[0-9]{1,2})?$", mostly=0.95, category="validity"),
        between("claim_amount", 0, 1_000_000),
        between("visit_date", "2020-01-01", "2026-12-31", category="timeliness"),
        mean_between("claim_amount", 100, 50_000),
        in_set("claim_status", ["PENDING", "APPROVED", "DENIED", "PROCESSING"]),
        pair_compare("paid_amount", "<=", "claim_amount"),
        sum_equals(["copay_amount", "insurance_paid", "patient_paid"], total=1, precision=0.01),
        columns_match(["patient_id", "claim_id", "diagnosis_code", "claim_amount", "visit_date", "provider_id",
                       "claim_status"], exact=False),
        has_type("claim_amount", "float"),
        increasing("processed_at", order_by="claim_id"),
    ]


def load_suite(text: str, order_by: str = "claim_id") -> list[Rule]:
    """The rules of a suite file: JSON with `expectations`, each an `expectation_type`, its `kwargs`, and optionally
    `meta.category`. `mostly` is read from the arguments. `order_by` is the order in which values are to increase
    where an entry names none. An unknown type, or an argument not understood, is an error."""
    out = []
    for n, entry in enumerate(json.loads(text)["expectations"]):
        kind, args = entry["expectation_type"], dict(entry.get("kwargs", {}))
        if kind not in _READ:
            raise ValueError(f"entry {n}: unknown expectation_type {kind!r}")
        changes = {}
        if "mostly" in args:
            changes["mostly"] = float(args.pop("mostly"))
        if category := (entry.get("meta") or {}).get("category"):
            changes["category"] = category
        rule = _READ[kind](args, order_by)
        if args:
            raise ValueError(f"entry {n}: arguments of {kind} not understood: {', '.join(sorted(args))}")
        out.append(replace(rule, **changes))
    return out


def _bounds(a: dict) -> tuple:
    return a.pop("min_value", None), a.pop("max_value", None)


def _pair(a: dict, _) -> Rule:
    """Equal, or, with `or_equal`, not above; rows with a missing value are ignored, which is the only choice."""
    if a.pop("ignore_row_if", "either_value_is_missing") != "either_value_is_missing":
        raise ValueError("pairs are compared where both values are there")
    return pair_compare(a.pop("column_A"), "<=" if a.pop("or_equal", False) else "=", a.pop("column_B"))


def _rising(a: dict, order_by: str) -> Rule:
    a.pop("parse_strings_as_datetimes", None)  # columns have types here
    return increasing(a.pop("column"), order_by=a.pop("order_by", order_by), strictly=a.pop("strictly", False))


# The names of expectation types and their arguments in suite files.
_READ = {
    "expect_table_row_count_to_be_between": lambda a, _: row_count(*_bounds(a)),
    "expect_column_to_exist": lambda a, _: has_column(a.pop("column")),
    "expect_column_values_to_not_be_null": lambda a, _: not_null(a.pop("column")),
    "expect_column_values_to_be_unique": lambda a, _: unique(a.pop("column")),
    "expect_column_values_to_match_regex": lambda a, _: matches(a.pop("column"), a.pop("regex")),
    "expect_column_values_to_be_between": lambda a, _: between(a.pop("column"), *_bounds(a)),
    "expect_column_mean_to_be_between": lambda a, _: mean_between(a.pop("column"), *_bounds(a)),
    "expect_column_values_to_be_in_set": lambda a, _: in_set(a.pop("column"), a.pop("value_set")),
    "expect_column_pair_values_to_be_equal": _pair,
    "expect_multicolumn_sum_to_equal": lambda a, _: sum_equals(a.pop("column_list"), total=a.pop("sum_total"), precision=a.pop("precision", 0)),
    "expect_table_columns_to_match_set": lambda a, _: columns_match(a.pop("column_set"), exact=a.pop("exact_match", True)),
    "expect_column_values_to_be_of_type": lambda a, _: has_type(a.pop("column"), a.pop("type_")),
    "expect_column_values_to_be_increasing": _rising,
}
