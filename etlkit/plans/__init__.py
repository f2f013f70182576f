from etlkit.plans.batch_etl import EtlRun, run_batch_etl
from etlkit.plans.gates import GateFailed, enforce_gate, post_load_gate
from etlkit.plans.migration import MigrationRun, run_migration
from etlkit.plans.runlog import RunLog
from etlkit.plans.stream_etl import RollupTo, StreamRun, Topic, decoded_events, run_stream_etl, served_events
from etlkit.plans.upkeep import (QUARANTINED, apply_batch_to_rollup, collect_dead_letters, letters_of, load_committed,
                                 replay_dead_letters)
