"""Batch load: read, mask, split, write both sides."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.functions.masking import mask_columns
from etlkit.operators.rules import RowRule, expr_rule
from etlkit.operators.split import clinical_rules, with_outcome
from etlkit.plans.runlog import RunLog
from etlkit.sinks.tables import REJECTED, VALID, outcome_path, write_outcomes
from etlkit.sources.schemas import CLINICAL_SCHEMA
from etlkit.sources.tables import CORRUPT, read_table


@dataclass(frozen=True)
class EtlRun:
    run_id: str
    loaded: int
    valid: int
    rejected: int
    valid_path: str
    rejected_path: str


def run_batch_etl(spark: SparkSession, input_path: str, output_path: str, fmt: str = "parquet",
                  schema: T.StructType = CLINICAL_SCHEMA, mask: list[str] = ("name", "dob"),
                  rules: list[RowRule] | None = None, partition_col: str | None = "visit_date", as_of=None,
                  rules_before_mask: bool = False, run_log_path: str | None = None,
                  batch_id: int | None = None, options: dict[str, str] | None = None) -> EtlRun:
    """One scan of the input, one write job; the counts are taken while the rows pass.

    Masking comes first, so rules see masked columns only; `rules_before_mask` turns that round for rules
    on sensitive columns. The raw text of rows that do not parse may hold anything: it is masked as well,
    and those rows are rejected.

    Rows are appended. With a `batch_id`, such as the load date as a number, the load is a partition of its
    own, and running it again replaces what an earlier attempt left, on every side. `options` go to the reader, such
    as {"header": "true"} for text with a header line.
    """
    log = RunLog(spark, run_log_path)
    rules = clinical_rules() if rules is None else list(rules)
    with log.timed("batch_etl"):
        raw = read_table(spark, input_path, fmt, schema, **(options or {}))
        sensitive = list(mask)
        if CORRUPT in raw.columns:
            sensitive.append(CORRUPT)
            unparsed = CORRUPT if rules_before_mask else f"{CORRUPT}_masked"
            rules.append(expr_rule("parses", F.col(unparsed).isNull()))
        if rules_before_mask:
            tagged = mask_columns(with_outcome(raw, rules, as_of), sensitive)
        else:
            tagged = with_outcome(mask_columns(raw, sensitive), rules, as_of)
        counts = Observation("batch_etl")
        write_outcomes(tagged, output_path, [partition_col] if partition_col else [], batch_id, counts)
        seen = counts.get
        log.record("batch_etl", **{k: seen[k] for k in ("loaded", "valid", "rejected")})  # only streams have late rows
    log.save()
    return EtlRun(log.run_id, seen["loaded"], seen["valid"], seen["rejected"],
                  outcome_path(output_path, VALID), outcome_path(output_path, REJECTED))
