from etlkit.operators.changes import apply_changes, drop_deleted, latest_per_key, merge_versions, upsert
from etlkit.operators.counting import find_duplicates, row_count_match, row_counts
from etlkit.operators.digests import DigestDiff, digest_diff, row_digest
from etlkit.operators.distributions import bucket_counts, equal_depth_edges, ks_distance, stability
from etlkit.operators.leaks import find_leaked_values
from etlkit.operators.modelling import (as_of_join, assign_keys, build_dim_date, build_dim_provider, fixed_span,
                                        key_lookup, load_fact, merged_as_of, number_new_rows, refresh_patients, rows_without_key,
                                        scd2_merge, span_of, splice_versions)
from etlkit.operators.ordering import order_violations
from etlkit.operators.profiling import completeness, freshness, lag_percentiles, null_profile, profile_numeric, volume_anomalies
from etlkit.operators.reconciling import (accuracy_rate, in_sample, reconcile, reconcile_literal, require_columns,
                                          row_diff)
from etlkit.operators.rollups import monthly_rollup, recompute_months, refresh_monthly
from etlkit.operators.signed import maintain_rollup, signed_rollup, signed_rows
from etlkit.operators.split import clinical_rules, split_literal, split_valid, with_outcome
from etlkit.operators.suite import SuiteFailed, claims_suite, load_suite, raise_on_failure, run_suite
