from etlkit.streaming.sinks import (CADENCE, current_rows, fold_changes, fold_new_changes, fold_rollup, read_rollup, read_rollup_parts, write_batches,
                                    write_changes_stream, write_events, write_rollup_stream, write_split_stream,
                                    write_table_stream)
from etlkit.streaming.sources import CHANGE_OPS, kafka_options, parse_cdc, read_events
from etlkit.streaming.transforms import dedup_events, event_rollup, served_columns, to_message, with_event_time
