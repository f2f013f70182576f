"""Batch and streaming data work on Spark: loads, masking, quality rules, reconciliation, merges, star schemas."""

from etlkit.session import configure, get_session, scratch_path, shared_folder, staged
