from etlkit.sinks.clustering import Reclustering, file_intervals, overlaps, recluster
from etlkit.sinks.files import recover, stream_id
from etlkit.sinks.tables import (LATE, REJECTED, VALID, append_rejected, append_table, create_table, outcome_path,
                                 publish_if_valid, read_outcome, replace_table, upsert_table, write_clustered,
                                 write_outcomes)
from etlkit.sinks.versions import VersionConflict, drop_old_versions, publish_version, read_version, roll_back, version, versions
