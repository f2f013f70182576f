from etlkit.functions.audit import add_audit, moment
from etlkit.functions.converting import TYPE_MAP, convert_types, spark_type, split_converted
from etlkit.functions.masking import digest, mask_columns, masking_check
