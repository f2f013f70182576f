"""Versioned tables: immutable folders of rows and small pointers, so that a reader always meets a whole table."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from etlkit.operators.rules import Rule
from etlkit.operators.suite import SuiteFailed, raise_on_failure, run_suite
from etlkit.sinks.files import Folders

POINTERS, DATA = "_versions", "data"


class VersionConflict(RuntimeError):
    """Somebody else published after the version this publication was made from."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str  # below the table's path
    rows: int
    schema: str
    made_from: int = 0  # the version it follows, 0 for none
    meta: dict = field(default_factory=dict)


def _pointer(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{POINTERS}/{number:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, rising."""
    names = Folders(spark, path).children(f"{path.rstrip('/')}/{POINTERS}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The version of that number, or the current one; None for a table never published."""
    if number is None:
        found = versions(spark, path)
        if not found:
            return None
        number = found[-1]
    return Version(**json.loads(Folders(spark, path).read(_pointer(path, number))))


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of a version, by default the current one. The plan names its folder, so what is published later, also while
    the rows are being read, does not change them."""
    found = version(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.schema(T.StructType.fromJson(json.loads(found.schema))).parquet(f"{path.rstrip('/')}/{found.folder}")


def _point(spark: SparkSession, path: str, new: Version) -> Version:
    if not Folders(spark, path).create_if_absent(_pointer(path, new.number), json.dumps(asdict(new))):
        raise VersionConflict(f"version {new.number} of {path} has been published by somebody else")
    return new


def publish_version(df: DataFrame, path: str, rules: list[Rule] = (), made_from: int | None = None, meta: dict | None = None,
                    expected_rows: int | None = None, partition_col: str | None = None) -> Version:
    """Write `df` as the next version of the table at `path` and return it.

    The rows go to a folder of their own, are judged there by `rules` and counted, and become the current version when their
    pointer appears, which either happens as a whole or not. Nothing that is current is ever moved or deleted, so a
    reader finds the old table or the new one, and after a failure at any step the old one. `made_from` is the number of
    the version `df` was derived from (the current one when this is called, if not given): if another one has been published
    since, `VersionConflict` is raised and the rows are not published. `df` may read from `path`.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if made_from is None:
        made_from = (versions(spark, path) or [0])[-1]
    folder = f"{DATA}/{made_from + 1:012d}-{uuid.uuid4().hex[:12]}"
    files = Folders(spark, path)
    writer = df.write.partitionBy(partition_col) if partition_col else df.write
    writer.parquet(f"{path}/{folder}")
    try:
        held = spark.read.schema(df.schema).parquet(f"{path}/{folder}")
        rows = held.count()  # from the file footers
        if rules:
            raise_on_failure(run_suite(held, list(rules)))
        if expected_rows is not None and rows != expected_rows:
            raise SuiteFailed([f"row count {rows} instead of {expected_rows}"])
        return _point(spark, path, Version(made_from + 1, folder, rows, held.schema.json(), made_from, meta or {}))
    except (SuiteFailed, VersionConflict):
        files.delete(f"{path}/{folder}")
        raise


def roll_back(spark: SparkSession, path: str, number: int) -> Version:
    """Publish a kept version again, as the next one; its rows are not copied."""
    old, now = version(spark, path, number), versions(spark, path)[-1]
    return _point(spark, path, Version(now + 1, old.folder, old.rows, old.schema, number, old.meta))


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Forget all but the newest `keep` versions; returns the numbers of those dropped.

    Pointers go first, oldest first, so a version that can be found can be read. Then folders go that no kept pointer names and
    that lie before the current version: those of dropped versions and of publications that failed. A reader of a dropped
    version fails, and so does a publication that began before as many versions as are kept.
    """
    files, path = Folders(spark, path), path.rstrip("/")
    found = versions(spark, path)
    dropped = found[:-max(1, keep)]
    for number in dropped:
        files.delete(_pointer(path, number))
    held = {version(spark, path, n).folder for n in found[len(dropped):]}
    for name in files.children(f"{path}/{DATA}"):
        if f"{DATA}/{name}" not in held and found and int(name[:12]) <= found[-1]:
            files.delete(f"{path}/{DATA}/{name}")
    return dropped
