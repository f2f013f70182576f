"""Tables kept up to date in numbered steps that may fail anywhere and be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etlkit.operators.rules import RowRule
from etlkit.operators.signed import maintain_rollup, signed_rollup, signed_rows
from etlkit.operators.split import failed_rules
from etlkit.session import staged
from etlkit.sinks.tables import REJECTED, VALID
from etlkit.sinks.versions import Version, publish_version, read_version, version
from etlkit.sources.tables import late_slice, next_ledger

QUARANTINED = "quarantined"


def apply_batch_to_rollup(spark: SparkSession, path: str, changes: DataFrame, batch_id: int, once: list[str] = (), **columns: str) -> Version:
    """Bring the published monthly totals at `path` up to date with one batch of before and after images.

    The batch's number is published with the totals, in one step: a batch that has been applied, or lies before one that
    was, changes nothing, however often it comes. Two writers at once: one of them fails with `VersionConflict`.
    """
    now = version(spark, path)
    if now.meta.get("batch_id", -1) >= batch_id:
        return now
    delta = signed_rollup(signed_rows(changes, once=once), **columns)
    return publish_version(maintain_rollup(read_version(spark, path, now.number), delta), path, made_from=now.number, meta={"batch_id": batch_id})


# ---- loads of a source that commits late -------------------------------------------------------------------

def load_committed(spark: SparkSession, source: DataFrame, target: str, state: str, keys: list[str], ts: str, look_back: str) -> int:
    """Append to the folder `target` the rows of `source` that no earlier load has brought; returns how many.

    Rows may become visible up to `look_back` (such as '2 hours') after rows with later times. The state holds the mark and a
    ledger of (key, digest) for the rows inside the window; see `late_slice`. Load n is the partition load=n of the target,
    and the state that follows it is published as version n. A load that failed before that is done again and replaces its
    partition, so each row comes once whatever fails.
    """
    now = version(spark, state)
    number = now.number + 1 if now else 1
    mark = now.meta["mark"] if now else None
    ledger = read_version(spark, state, now.number) if now else None
    fresh = staged(late_slice(source, ts, keys, ledger, mark, look_back), "load")
    newest = fresh.agg(F.max(F.col(ts)).cast("string").alias("t"), F.count(F.lit(1)).alias("n")).first()
    mark = max(m for m in (mark, newest["t"]) if m is not None) if mark or newest["t"] else None
    fresh.withColumn("load", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(target)
    publish_version(next_ledger(fresh, ts, keys, ledger, mark, look_back), state, made_from=number - 1, meta={"mark": mark})
    return newest["n"]


# ---- replay of dead letters --------------------------------------------------------------------------------

def collect_dead_letters(rejected: DataFrame, path: str, message_id: str) -> Version:
    """Publish rejected messages as dead letters: one row per message, judged once, with `outcome` and `attempts`.

    A message that is there already keeps its state, so collecting the same messages again changes nothing.
    """
    spark = rejected.sparkSession
    names = [c for c in rejected.columns if c not in ("outcome", "attempts", "failed_rules", "replay")]
    fresh = rejected.select(*names).dropDuplicates([message_id]).select(
        "*", F.lit(REJECTED).alias("outcome"), F.lit(1).alias("attempts"), F.array().cast("array<string>").alias("failed_rules"), F.lit(0).alias("replay"))
    now = version(spark, path)
    if now is None:
        return publish_version(fresh, path, made_from=0, meta={"replay": 0})
    held = read_version(spark, path, now.number)
    new = fresh.join(held.select(message_id), message_id, "left_anti")
    return publish_version(held.unionByName(new.select(*held.columns)), path, made_from=now.number, meta=now.meta)


def replay_dead_letters(spark: SparkSession, path: str, rules: list[RowRule], replay: int, most_attempts: int = 3,
                        repair: dict[str, Column] | None = None) -> Version:
    """Judge the rejected dead letters again, by new rules and after `repair` of columns; publishes the outcome of all as one version.

    A message that passes moves to the side `valid`, with the number of the replay; one that fails has an attempt more, and is
    `quarantined` after `most_attempts`. Only rejected messages are judged, so each moves once and
    valid + rejected + quarantined stays the same. A replay with a number that has been published changes nothing, and one that
    fails at any step leaves the letters as they were.
    """
    now = version(spark, path)
    if now.meta["replay"] >= replay:
        return now
    held = read_version(spark, path, now.number)
    letters = held.where(F.col("outcome") == REJECTED).withColumns(repair or {})
    judged = letters.withColumn("failed_rules", failed_rules(letters, rules))
    attempts = F.col("attempts") + 1
    outcome = F.when(F.size("failed_rules") == 0, F.lit(VALID)).when(attempts >= most_attempts, F.lit(QUARANTINED)).otherwise(F.lit(REJECTED))
    moved = judged.withColumns({"outcome": outcome, "attempts": attempts, "replay": F.lit(replay)}).select(*held.columns)
    return publish_version(held.where(F.col("outcome") != REJECTED).unionByName(moved), path, made_from=now.number, meta={"replay": replay}, expected_rows=now.rows)


def letters_of(spark: SparkSession, path: str, outcome: str, replay: int | None = None) -> DataFrame:
    """The dead letters of one side; with `replay` only those that this replay moved there."""
    found = read_version(spark, path).where(F.col("outcome") == outcome)
    return found if replay is None else found.where(F.col("replay") == replay)
