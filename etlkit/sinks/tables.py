"""Batch sinks on partitioned Parquet tables."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.operators.changes import latest_per_key, merge_winners
from etlkit.operators.rules import Rule
from etlkit.operators.suite import SuiteFailed, raise_on_failure, run_suite
from etlkit.session import staged
from etlkit.sinks.files import Folders, next_folder, recover, replace_folder, swap_in, swap_in_partitions

VALID, REJECTED, LATE = "valid", "rejected", "late"
OUTCOMES = (VALID, REJECTED, LATE)
BATCH_LOADS = "batch"  # name of the loads that no stream writes


def arranged(df: DataFrame, partition_cols: list[str], cluster_cols: list[str] = ()) -> DataFrame:
    """Lay rows out for a partitioned write: rows of one partition meet in few tasks, so a table partition
    gets few files, and adaptive execution cuts a large partition into several tasks, so a hot one does not
    hold up the job. `cluster_cols` sorts each file, which narrows its row-group ranges."""
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    if cluster_cols:
        df = df.sortWithinPartitions(*partition_cols, *cluster_cols)
    return df


def _write(df: DataFrame, path: str, mode: str, partition_cols: list[str], cluster_cols: list[str] = (),
           fmt: str = "parquet", counts: tuple[Observation, list[Column]] | None = None, arrange: bool = True, dynamic: bool = True) -> None:
    if arrange:
        df = arranged(df, partition_cols, cluster_cols)
    if counts:
        # After the shuffle: the tasks that write count once each, also if an executor is lost and others rerun.
        df = df.observe(counts[0], *counts[1])
    writer = df.write.format(fmt).mode(mode)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if partition_cols and dynamic else "static")
    writer.save(path)


def append_table(df: DataFrame, path: str, partition_col: str | None = None, fmt: str = "parquet") -> None:
    _write(df, path, "append", [partition_col] if partition_col else [], fmt=fmt)


def append_rejected(rejected: DataFrame, path: str) -> bool:
    """Append to `{path}_rejected`; an empty side writes nothing. Returns whether anything was written."""
    if rejected.isEmpty():
        return False
    append_table(rejected, f"{path}_rejected")
    return True


def replace_table(df: DataFrame, path: str, partition_col: str | None = None, whole: bool = True,
                  arrange: bool = True) -> None:
    """Full refresh; with `whole=False` only the partitions that `df` has rows for are replaced.

    `arrange=False` skips the shuffle for rows that are laid out by partition already. A full refresh is written
    beside the table and swapped in by renames, see `sinks.files`; `df` may read from it.
    """
    columns = [partition_col] if partition_col else []
    if whole:
        replace_folder(df, path, lambda rows, folder: _write(rows, folder, "overwrite", columns, arrange=arrange, dynamic=False))
    else:
        _write(df, path, "overwrite", columns, arrange=arrange)


def write_clustered(df: DataFrame, path: str, partition_cols: list[str], cluster_cols: list[str],
                    mode: str = "append") -> None:
    _write(df, path, mode, list(partition_cols), list(cluster_cols))


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None,
                 partition_cols: list[str] = (), defaults: dict[str, str] | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS over Parquet. Non-null columns are declared so, but Parquet tables do not
    enforce it: check with a rule. `defaults` maps columns to SQL expressions."""
    defaults = defaults or {}
    columns = []
    for f in schema.fields:
        text = f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
        columns.append(text + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else ""))
    text = f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet"
    if partition_cols:
        text += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})"
    if path:
        text += f" LOCATION '{path}'"
    spark.sql(text)


# ---- both sides of a split from one scan -------------------------------------------------------------------

def write_outcomes(tagged: DataFrame, path: str, partition_cols: list[str] = (), batch_id: int | None = None,
                   counts: Observation | None = None, stream: str = BATCH_LOADS) -> None:
    """Write valid and rejected rows in one job, as the partitions `outcome=...` of one folder.

    All sides come from one scan. With a `batch_id`, the batch of the `stream` (or other kind of load) is a partition
    of its own on each side, and writing it again replaces all of it, wherever its rows went before. `counts`
    receives loaded, valid, rejected and late.
    """
    seen = counts and (counts, [F.count(F.lit(1)).alias("loaded"),
                                *[F.count_if(F.col("outcome") == side).alias(side) for side in OUTCOMES]])
    if batch_id is None:
        _write(tagged, path, "append", ["outcome", *partition_cols], counts=seen)
        return
    files = Folders(tagged.sparkSession, path)
    for side in OUTCOMES:
        files.delete(f"{outcome_path(path, side)}/stream={stream}/batch_id={batch_id}")
    _write(tagged.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")}), path, "append",
           ["outcome", "stream", "batch_id", *partition_cols], counts=seen)


def outcome_path(path: str, outcome: str) -> str:
    """Where one side lies: a Parquet table of its own."""
    return f"{path.rstrip('/')}/outcome={outcome}"


def read_outcome(spark: SparkSession, path: str, outcome: str, schema: T.StructType | None = None) -> DataFrame:
    """Valid rows without their (empty) `failed_rules`, or rejected or late rows with it. Only that side is read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(path).where(F.col("outcome") == outcome).drop("outcome", "stream")
    return rows.drop("failed_rules") if outcome == VALID else rows


# ---- merge into a table ------------------------------------------------------------------------------------

def _is_one_of(column: str, values: list) -> Column:
    known = [v for v in values if v is not None]
    hit = F.col(column).isin(known)
    return hit | F.col(column).isNull() if len(known) < len(values) else hit


def _partition_folder(column: str, value) -> str:
    text = "__HIVE_DEFAULT_PARTITION__" if value is None else quote(str(value), safe=" -_.,+")
    return f"{column}={text}"


def upsert_table(spark: SparkSession, path: str, changes: DataFrame, keys: list[str], newest: str | list[str],
                 tie_break: list[str], partition_col: str | None = None, as_of=None,
                 stamp: str | None = "processed_at", most_partitions: int = 100_000) -> None:
    """Merge changes into a Parquet table, rewriting only the partitions they touch.

    Touched are the partitions the new rows go to and those their earlier versions lie in, so a row whose
    partition value changed leaves no copy behind. The new content is written once, beside the table, and comes in by
    renames; a merge that failed at any step is finished or undone when it runs again, which gives the same table.
    A merge that touches more than `most_partitions` is refused: choose a coarser partition column.
    """
    recover(spark, path)
    target = spark.read.parquet(path)
    winners = staged(latest_per_key(changes, keys, newest, tie_break))
    if partition_col is None:
        replace_folder(merge_winners(target, winners, keys, as_of, stamp), path, lambda rows, folder: rows.write.mode("overwrite").parquet(folder))
        return
    places = winners.select(partition_col)
    if partition_col not in keys:
        held = target.select(*keys, partition_col).join(winners.select(*keys), keys, "left_semi")
        places = places.unionByName(held.select(partition_col))
    touched = [r[0] for r in places.distinct().limit(most_partitions + 1).collect()]
    if not touched:
        return
    if len(touched) > most_partitions:
        raise ValueError(f"the changes touch more than {most_partitions} partitions of {path}")
    affected = target.where(_is_one_of(partition_col, touched))
    merged = merge_winners(affected, winners, keys, as_of, stamp)
    _write(merged, next_folder(path), "overwrite", [partition_col], dynamic=False)
    swap_in_partitions(spark, path, [_partition_folder(partition_col, v) for v in touched])


# ---- publish only what passes ------------------------------------------------------------------------------

def publish_if_valid(df: DataFrame, rules: list[Rule], target: str, stage_path: str | None = None,
                     partition_col: str | None = None, expected_rows: int | None = None,
                     as_table: bool = False) -> tuple[DataFrame, int]:
    """Stage, check, publish. Returns the suite result and the number of rows published.

    The rules run on what was staged. If a rule fails, or the
    count differs from `expected_rows`, the target stays as it was and `SuiteFailed` is raised. Otherwise the
    staged rows become the target: by renames, if they were staged beside it (without `stage_path`), by a copy that is
    then swapped in from a `stage_path` of the caller's, or, with `as_table`, by pointing the catalog table
    `target` at that durable `stage_path`, which moves no data. A stage of a failed check is kept until the next call.
    """
    spark = df.sparkSession
    if as_table and not stage_path:
        raise ValueError("as_table needs a stage_path that lasts: the table will lie there")
    if stage_path:
        replace_table(df, stage_path, partition_col)
    else:
        recover(spark, target)
        _write(df, next_folder(target), "overwrite", [partition_col] if partition_col else [], dynamic=False)
    held = spark.read.schema(df.schema).parquet(stage_path or next_folder(target))
    rows = held.count()  # from the file footers
    result = run_suite(held, rules) if rules else None
    if result is not None:
        result = spark.createDataFrame(result.collect(), result.schema)  # one row per rule
        raise_on_failure(result)
    if expected_rows is not None and rows != expected_rows:
        raise SuiteFailed([f"row count {rows} instead of {expected_rows}"])
    if as_table:
        spark.sql(f"ALTER TABLE {target} SET LOCATION '{stage_path}'")
        if partition_col and spark.conf.get("spark.sql.catalogImplementation") == "hive":
            spark.sql(f"MSCK REPAIR TABLE {target}")
        spark.catalog.refreshTable(target)
    elif stage_path:
        replace_table(held, target, partition_col, arrange=False)
    else:
        swap_in(spark, target)
    return result, rows
