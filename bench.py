"""Time the registered queries and print one JSON line.

BENCH_SF_DIR   folder of the tables          (default /root/testdata/sf0.1)
BENCH_CPUS     local cores                   (default all)
BENCH_RUNS     warm runs per query           (default 3)
BENCH_QUERIES  names, separated by commas    (default the headline queries; "all" for every registered one)
BENCH_ORACLE   1 to time DuckDB on the same tables and cores as well
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import workload  # noqa: E402
from etlkit import get_session  # noqa: E402

HEADLINE = [
    "etl_flagship", "mask_columns", "split_total", "range_prune", "monthly_rollup", "find_duplicates", "reconcile_literal",
    "reconcile_null_safe", "row_diff", "incremental_slice", "latest_per_key", "upsert", "apply_changes", "quality_suite",
    "increasing_global", "null_profile", "profile_numeric", "volume_anomalies", "orphan_keys", "convert_types", "scd2_merge",
    "load_fact", "batch_etl", "parse_cdc", "event_rollup", "dedup_events", "split_stream", "change_stream_table",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    workload.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = sorted(workload.QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = get_session("bench", f"local[{cpus}]", **{"spark.ui.enabled": "false", "spark.driver.memory": "8g",
                                                     "spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "row_counts", folder)  # start-up of the JVM and of the code generator
    first, warm = {}, {}
    for name in names:
        first[name] = round(run(spark, name, folder), 3)
        warm[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
    out = {"metric": "total seconds, median of warm runs", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
           "first_run": first, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}
    if os.environ.get("BENCH_ORACLE") == "1":
        from tests.compare import connect
        con = connect(folder)
        con.execute(f"SET threads = {int(cpus)}")
        out["duckdb"] = {}
        for name in names:
            start = time.perf_counter()
            con.execute(workload.SQL[name]).fetchall()
            out["duckdb"][name] = round(time.perf_counter() - start, 3)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
