from etlkit.sources.schemas import (CLAIMS_SCHEMA, CLINICAL_EVENT_SCHEMA, CLINICAL_SCHEMA, DIM_DATE_SCHEMA,
                                    DIM_PATIENT_SCHEMA, FACT_CLAIMS_SCHEMA, MESSAGE_SCHEMA)
from etlkit.sources.tables import (balanced_cuts, balanced_predicates, extract_table, late_slice, next_ledger, incremental_slice, jdbc_reader, loaded_on,
                                   range_predicates, read_table, split_corrupt)
