"""Latest version per key, and the merge of changes into a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etlkit.functions.audit import add_audit


def latest_per_key(df: DataFrame, keys: list[str], newest: str | list[str], tie_break: list[str]) -> DataFrame:
    """One row per key: the one with the largest `newest`, ties settled by the largest `tie_break`.

    The rank filter lets Spark keep one row per key and task before the shuffle, so versions of one key
    do not pile up in one place.
    """
    newest = [newest] if isinstance(newest, str) else list(newest)
    if not tie_break:
        raise ValueError("name tie-break columns: rows with equal times would be picked at random")
    order = [F.col(c).desc_nulls_last() for c in [*newest, *tie_break]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], newest: str | list[str], tie_break: list[str],
           as_of=None, stamp: str | None = "processed_at") -> DataFrame:
    """The target after the merge: the latest change of a key replaces its row or is added as a new one.

    `changes` must bring every column of the target except `stamp`, which is set to `as_of` on the rows
    that come from changes. Columns only `changes` has, such as its update time, are dropped.
    """
    return merge_winners(target, latest_per_key(changes, keys, newest, tie_break), keys, as_of, stamp)


def merge_winners(target: DataFrame, winners: DataFrame, keys: list[str], as_of=None,
                  stamp: str | None = "processed_at") -> DataFrame:
    """The merge itself, for changes that are one row per key already.

    The target is not shuffled if the keys of the changes are few enough to be sent to all executors. NULL keys
    match NULL keys, so merging the same changes again changes nothing.
    """
    lacking = [c for c in target.columns if c not in winners.columns and c != stamp]
    if lacking:
        raise ValueError(f"changes lack target columns: {', '.join(lacking)}")
    incoming = add_audit(winners, as_of, stamp) if stamp in target.columns else winners
    incoming = incoming.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.columns])
    return without_keys(target, winners, keys).unionByName(incoming)


def without_keys(target: DataFrame, winners: DataFrame, keys: list[str]) -> DataFrame:
    """The target's rows whose key is none of the winners', NULL counting as equal to NULL."""
    named = winners.select(*[F.col(k).alias(f"_w{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_w{i}")) for i, k in enumerate(keys)]
    return target.join(named, same, "left_anti").select(*target.columns)


def merge_versions(*parts: DataFrame, keys: list[str], newest: str | list[str], tie_break: list[str]) -> DataFrame:
    """Latest version per key over several sets of versions, whichever set it is in."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return latest_per_key(merged, keys, newest, tie_break)


def drop_deleted(versions: DataFrame, op: str = "op", deleted: Column | None = None) -> DataFrame:
    return versions.where(~(F.col(op) == "d") if deleted is None else ~deleted)


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str], newest: str | list[str],
                  tie_break: list[str], op: str = "op") -> DataFrame:
    """The target after inserts, updates and deletes: per key the last change decides, `op` 'd' removes it."""
    winners = latest_per_key(changes, keys, newest, tie_break)
    kept = without_keys(target, winners, keys)
    return kept.unionByName(drop_deleted(winners, op).select(*target.columns))
