"""Stream sinks. Each takes a checkpoint folder, and a repeated micro-batch adds nothing twice."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from etlkit.operators.changes import drop_deleted, latest_per_key, merge_versions
from etlkit.operators.rules import RowRule
from etlkit.operators.split import with_outcome
from etlkit.sinks.files import Folders, recover, replace_folder, stream_id
from etlkit.sinks.tables import write_outcomes
from etlkit.streaming.transforms import to_message

# Fixed value: the published cadence of micro-batches.
CADENCE = "5 minutes"


def _triggered(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    """`every=None` works off what is there and stops; otherwise a batch starts at each interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def write_events(df: DataFrame, checkpoint: str, fmt: str = "kafka", options: dict[str, str] | None = None,
                 key: str | None = None, every: str | None = CADENCE) -> StreamingQuery:
    """Publish rows as messages: to a topic, or to files with the same key and value columns."""
    return _triggered(to_message(df, key).writeStream.format(fmt).options(**(options or {})).outputMode("append"),
                      checkpoint, every)


def write_table_stream(df: DataFrame, path: str, checkpoint: str, partition_cols: list[str] = (),
                       every: str | None = CADENCE) -> StreamingQuery:
    """Append to a Parquet folder; its commit log makes each batch count once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    return _triggered(writer, checkpoint, every)


def write_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append", every: str | None = CADENCE) -> StreamingQuery:
    """Hand each micro-batch to `write(batch, batch_id)`, which must leave the same result when repeated."""
    return _triggered(df.writeStream.foreachBatch(write).outputMode(mode), checkpoint, every)


def write_split_stream(df: DataFrame, rules: list[RowRule], path: str, checkpoint: str, as_of=None,
                       every: str | None = CADENCE, stream: str | None = None) -> StreamingQuery:
    """Valid rows and dead letters from one pass per micro-batch; read them with `sinks.read_outcome`.

    A batch replaces the one of the same `stream` and number. The name comes from the checkpoint unless it is given;
    give one to let a replay after a lost checkpoint, with the same batches, replace what the first run wrote.
    """
    stream = stream or stream_id(df.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_outcomes(with_outcome(batch, rules, as_of), path, batch_id=batch_id, stream=stream)

    return write_batches(df, write, checkpoint, every=every)


BATCH = ["stream", "batch_id"]


def replace_batch(batch: DataFrame, batch_id: int, path: str, stream: str) -> None:
    """Write a batch under the stream's name and its number, in place of what an earlier attempt left."""
    Folders(batch.sparkSession, path).delete(f"{path.rstrip('/')}/stream={stream}/batch_id={batch_id}")
    batch.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")}).write.mode("append").partitionBy(*BATCH).parquet(path)


def replace_part(rows: DataFrame, batch_id: int, path: str) -> None:
    """Like `replace_batch`, where the folder belongs to one stream."""
    part = f"{path.rstrip('/')}/batch_id={batch_id}"
    Folders(rows.sparkSession, path).delete(part)
    rows.write.mode("overwrite").parquet(part)


# ---- windowed totals ---------------------------------------------------------------------------------------

def write_rollup_stream(rollup: DataFrame, path: str, checkpoint: str, every: str | None = CADENCE) -> StreamingQuery:
    """Write the windows each micro-batch changed, so open windows are visible before they close."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # A stateful batch has as many partitions as the state; its few rows fit a file or two.
        replace_batch(batch.hint("rebalance"), batch_id, path, stream)

    stream = stream_id(rollup.sparkSession, checkpoint)
    return write_batches(rollup, write, checkpoint, mode="update", every=every)


def read_rollup(spark: SparkSession, path: str, dimensions: list[str]) -> DataFrame:
    """The newest state of each window."""
    keys = ["window_start", "window_end", *dimensions]
    return latest_per_key(spark.read.parquet(path), keys, BATCH, ["events"]).drop(*BATCH)


def read_rollup_parts(spark: SparkSession, path: str, dimensions: list[str]) -> DataFrame:
    """Totals per window of counts that each batch added, in place of states that follow one another."""
    rows = spark.read.parquet(path)
    sums = [c for c in rows.columns if c == "events" or c.startswith("sum_")]
    return rows.groupBy("window_start", "window_end", *dimensions).agg(*[F.sum(c).alias(c) for c in sums])


def fold_rollup(spark: SparkSession, path: str, dimensions: list[str]) -> None:
    """Shrink a rollup to the newest state of each window, in place: the versions become one batch under the name and
    number of the newest, so batches that follow still count as newer. Run it while no stream writes."""
    recover(spark, path)
    rows = spark.read.parquet(path)
    last = rows.agg(F.max(F.struct(*BATCH)).alias("m")).first()["m"]
    if last is None:
        return
    folded = latest_per_key(rows, ["window_start", "window_end", *dimensions], BATCH, ["events"]).withColumns(
        {"stream": F.lit(last["stream"]), "batch_id": F.lit(last["batch_id"]).cast("bigint")})
    replace_folder(folded, path, lambda df, folder: df.hint("rebalance").write.mode("overwrite").partitionBy(*BATCH).parquet(folder))


# ---- change streams into a table ---------------------------------------------------------------------------

def write_changes_stream(changes: DataFrame, keys: list[str], newest: str | list[str], tie_break: list[str],
                         path: str, checkpoint: str, every: str | None = CADENCE) -> StreamingQuery:
    """Keep the last change per key of each micro-batch. The work is in proportion to the batch, not to the
    table; `current_rows` merges on read and `fold_changes` shortens what there is to merge."""
    def write(batch: DataFrame, batch_id: int) -> None:
        replace_batch(latest_per_key(batch, keys, newest, tie_break), batch_id, path, stream)

    stream = stream_id(changes.sparkSession, checkpoint)
    return write_batches(changes, write, checkpoint, every=every)


def current_rows(changes: DataFrame, keys: list[str], newest: str | list[str], tie_break: list[str],
                 base: DataFrame | None = None, op: str = "op") -> DataFrame:
    """The table as of the last change: newest version per key, wherever and whenever it arrived, without
    the keys whose newest change is a delete."""
    versions = [v.drop(*BATCH) for v in ([changes] if base is None else [base, changes])]
    return drop_deleted(merge_versions(*versions, keys=keys, newest=newest, tie_break=tie_break), op)


def fold_changes(base: DataFrame | None, changes: DataFrame, keys: list[str], newest: str | list[str],
                 tie_break: list[str], path: str) -> None:
    """Write base and changes as one version per key to the new folder `path`, the next base. Deletes are
    kept as versions, so that a change that arrives late does not bring a deleted row back."""
    versions = [v.drop(*BATCH) for v in ([changes] if base is None else [base, changes])]
    merge_versions(*versions, keys=keys, newest=newest, tie_break=tie_break).write.mode("errorifexists").parquet(path)


def fold_new_changes(spark: SparkSession, path: str, keys: list[str], newest: str | list[str], tie_break: list[str],
                     base: str) -> None:
    """Fold the batches of a change stream that `base` does not hold yet into it, and delete them from `path`.

    The base keeps the newest batch it holds beside its rows, and both come in by one swap; batches up to that mark
    are not read again, so repeating the call after a failure adds nothing. Run it while no stream writes.
    """
    recover(spark, base)
    files = Folders(spark, base)
    mark = json.loads(files.read(f"{base}/_folded.json")) if files.exists(f"{base}/_folded.json") else {}
    batches = {(s.partition("=")[2], int(b.partition("=")[2])) for s in files.children(path) if s.startswith("stream=")
               for b in files.children(f"{path.rstrip('/')}/{s}") if b.startswith("batch_id=")}
    new = sorted(b for b in batches if b[1] > mark.get(b[0], -1))
    if new:
        rows = spark.read.parquet(path).where(F.array_contains(F.array(*[F.lit(f"{s}/{b}") for s, b in new]), F.concat_ws("/", *BATCH)))
        versions = [spark.read.parquet(base)] if files.exists(base) else []
        merged = merge_versions(*versions, rows.drop(*BATCH), keys=keys, newest=newest, tie_break=tie_break)
        for s, b in new:
            mark[s] = max(mark.get(s, -1), b)

        def write(df: DataFrame, folder: str) -> None:
            df.write.mode("overwrite").parquet(folder)
            files.write(f"{folder}/_folded.json", json.dumps(mark))

        replace_folder(merged, base, write)
    for s, b in batches:
        if b <= mark.get(s, -1):
            files.delete(f"{path.rstrip('/')}/stream={s}/batch_id={b}")
