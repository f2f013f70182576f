"""Migration of one table: extract, check its columns, transform, publish by full refresh, compare counts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from etlkit.operators.reconciling import require_columns
from etlkit.operators.rules import Rule
from etlkit.plans.runlog import RunLog
from etlkit.session import drop_scratch, scratch_path
from etlkit.sinks.tables import publish_if_valid
from etlkit.sources.tables import extract_table

# The columns the migrated table must have.
REQUIRED_COLUMNS = ["customer_id", "email", "created_at"]


@dataclass(frozen=True)
class MigrationRun:
    run_id: str
    extracted: int
    published: int
    counts_match: bool


def run_migration(spark: SparkSession, reader: str | Callable[[SparkSession], DataFrame], target: str,
                  transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                  required: list[str] = REQUIRED_COLUMNS, rules: list[Rule] = (),
                  keeps_rows: bool = True, partition_col: str | None = None,
                  run_log_path: str | None = None) -> MigrationRun:
    """The source is read once, into staging, and after the transform written once more, beside the target, which it
    becomes by a rename. The published count must equal the staged one, or `SuiteFailed` is raised and the target stays;
    a transform that is meant to drop or add rows says so by `keeps_rows=False`. The staged extract is deleted at the end."""
    log = RunLog(spark, run_log_path)
    with log.timed("migration"):
        stage = scratch_path(spark, "extract")
        extract, extracted = extract_table(spark, reader, stage_path=stage)
        require_columns(extract, required)
        _, published = publish_if_valid(transform(extract), list(rules), target, partition_col=partition_col,
                                        expected_rows=extracted if keeps_rows else None)
        log.record("migration", extracted=extracted, published=published)
        drop_scratch(spark, stage)
    log.save()
    return MigrationRun(log.run_id, extracted, published, extracted == published)
