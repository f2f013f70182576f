"""Total split of a table into valid and rejected rows: each row is on exactly one side."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.functions.arrays import array_of
from etlkit.functions.audit import add_audit
from etlkit.operators.rules import RowRule, matches, not_null

# Fixed value: the pattern of the published load.
ETL_CODE_PATTERN = "^[A-Z][0-9]{2}$"


def clinical_rules(id_column: str = "patient_id", code_column: str = "diagnosis_code",
                   pattern: str = ETL_CODE_PATTERN) -> list[RowRule]:
    return [not_null(id_column), matches(code_column, pattern)]


def _row_rules(rules: list) -> list[RowRule]:
    other = [r.rule_id for r in rules if not isinstance(r, RowRule)]
    if other:
        raise ValueError(f"a split needs rules that judge single rows: {', '.join(other)}")
    if not rules:
        raise ValueError("a split needs at least one rule")
    return rules


def failed_rules(df: DataFrame, rules: list[RowRule]) -> Column:
    """array<string>: ids of the rules the row fails, empty if it passes all."""
    return array_of(*[(~r.passes(df), F.lit(r.rule_id)) for r in _row_rules(rules)])


def with_outcome(df: DataFrame, rules: list[RowRule], as_of=None) -> DataFrame:
    """Add `failed_rules`, `outcome` ('valid' or 'rejected') and `processed_at` in one projection pass."""
    tagged = add_audit(df.withColumn("failed_rules", failed_rules(df, rules)), as_of)
    return tagged.withColumn("outcome", F.when(F.size("failed_rules") == 0, "valid").otherwise("rejected"))


def split_valid(df: DataFrame, rules: list[RowRule], as_of=None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) as two plans over the same source; both carry `processed_at`, the rejected side
    also `failed_rules`.

    The valid side filters on the bare conditions, so the optimizer can push them into the scan. To write
    both sides from one scan, use `sinks.write_outcomes`.
    """
    valid = df.where(reduce(operator.and_, [r.test(df) for r in _row_rules(rules)]))
    rejected = df.where(~reduce(operator.and_, [r.passes(df) for r in rules])).withColumn(
        "failed_rules", failed_rules(df, rules))
    return add_audit(valid, as_of), add_audit(rejected, as_of)


def split_literal(df: DataFrame, id_column: str = "patient_id", code_column: str = "diagnosis_code",
                  pattern: str = ETL_CODE_PATTERN, as_of=None) -> tuple[DataFrame, DataFrame]:
    """The split as first published, for parity: rows that have an id but no fitting code are on neither side,
    and only valid rows are stamped."""
    has_id = F.col(id_column).isNotNull()
    return add_audit(df.where(has_id & F.col(code_column).rlike(pattern)), as_of), df.where(~has_id)
