"""Run metrics, appended to a table."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

RUN_LOG_SCHEMA = "run_id string, step string, metric string, value double, recorded_at timestamp"


class RunLog:
    """Collects (step, metric, value) during a run and appends them to a Parquet table at its end."""

    def __init__(self, spark: SparkSession, path: str | None, run_id: str | None = None):
        self.spark, self.path = spark, path
        self.run_id = run_id or uuid.uuid4().hex
        self.rows: list[tuple] = []

    def record(self, step: str, **metrics: float) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        self.rows += [(self.run_id, step, name, float(value), now) for name, value in metrics.items()]

    @contextmanager
    def timed(self, step: str):
        start = time.monotonic()
        try:
            yield
        except Exception:
            self.record(step, failed=1)
            self.save()
            raise
        finally:
            self.record(step, seconds=time.monotonic() - start)

    def save(self) -> None:
        if self.path and self.rows:
            self.spark.createDataFrame(self.rows, RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        self.rows = []
