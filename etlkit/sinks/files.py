"""Folders that change as a whole: replaced by renames that a later call can finish."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

DONE = "_SUCCESS"


class Folders:
    """The file system of a path, through Hadoop's interface, so that it may be any store Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.gateway, self.conf = spark.sparkContext._gateway, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._at(path).getFileSystem(self.conf)

    def _at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._at(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self._at(path), True)

    def rename(self, source: str, target: str) -> None:
        self.fs.mkdirs(self._at(target).getParent())
        if not self.fs.rename(self._at(source), self._at(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def children(self, path: str) -> list[str]:
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self._at(path))) if self.exists(path) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self._at(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Complete under its name or not there: written beside it and renamed."""
        part = f"{path}.part"
        stream = self.fs.create(self._at(part), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.delete(path)
        self.rename(part, path)

    def create_if_absent(self, path: str, text: str) -> bool:
        """Complete under its name, unless that is taken: written beside it and renamed without replacing. Whether it was."""
        part = f"{path}.{uuid.uuid4().hex}.part"
        stream = self.fs.create(self._at(part), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        modes = self.gateway.new_array(rename, 1)
        modes[0] = rename.NONE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(self._at(part), self._at(path), modes)
            return True
        except Exception:
            self.delete(part)
            if self.exists(path):
                return False
            raise


def _beside(path: str) -> tuple[str, str]:
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/_next_{name}", f"{head}/_previous_{name}"


def next_folder(path: str) -> str:
    """Where the next content of `path` is to be written before `swap_in`."""
    return _beside(path)[0]


def swap_in(spark: SparkSession, path: str) -> None:
    """Make the complete content of `next_folder(path)` that of `path`. Whichever step fails, `recover` finishes it."""
    files, path = Folders(spark, path), path.rstrip("/")
    new, old = _beside(path)
    if not files.exists(f"{new}/{DONE}"):
        raise OSError(f"{new} is not complete")
    files.delete(old)
    if files.exists(path):
        files.rename(path, old)
    files.rename(new, path)
    files.delete(old)


PLAN = "_plan.json"


def swap_in_partitions(spark: SparkSession, path: str, folders: list[str]) -> None:
    """Replace the partitions `folders` of `path` by those of `next_folder(path)`; one it lacks is emptied.

    The plan is written down first, and every step may be repeated, so `recover` finishes what was begun.
    """
    files, new = Folders(spark, path), next_folder(path)
    held = set(files.children(new))
    files.write(f"{new}/{PLAN}", json.dumps({"replace": [f for f in folders if f in held], "empty": [f for f in folders if f not in held]}))
    _apply(files, path.rstrip("/"), new)


def _apply(files: Folders, path: str, new: str) -> None:
    plan = json.loads(files.read(f"{new}/{PLAN}"))
    for name in plan.get("add", []):
        if files.exists(f"{new}/{name}"):
            files.rename(f"{new}/{name}", f"{path}/{name}")
    for folder in plan["replace"]:
        if files.exists(f"{new}/{folder}"):  # else this partition has been moved already
            files.delete(f"{path}/{folder}")
            files.rename(f"{new}/{folder}", f"{path}/{folder}")
    for folder in plan["empty"]:
        files.delete(f"{path}/{folder}")
    files.delete(new)


def replace_files(df: DataFrame, path: str, old: list[str]) -> None:
    """Write `df` beside `path`, move its files in and delete the `old` ones, all by a plan that `recover` finishes."""
    spark, path = df.sparkSession, path.rstrip("/")
    files, new = Folders(spark, path), next_folder(path)
    df.write.mode("overwrite").parquet(new)
    added = [name for name in files.children(new) if not name.startswith(("_", "."))]
    files.write(f"{new}/{PLAN}", json.dumps({"add": added, "replace": [], "empty": [name.rpartition("/")[2] for name in old]}))
    _apply(files, path, new)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo an interrupted change of `path`. Called before each change; readers may call it too."""
    files, path = Folders(spark, path), path.rstrip("/")
    new, old = _beside(path)
    if files.exists(f"{new}/{PLAN}"):
        _apply(files, path, new)
    elif not files.exists(path) and files.exists(f"{new}/{DONE}"):
        files.rename(new, path)
    elif not files.exists(path) and files.exists(old):
        files.rename(old, path)
    files.delete(new)
    if files.exists(path):
        files.delete(old)


def replace_folder(df: DataFrame, path: str, write) -> None:
    """Write by `write(df, folder)` beside `path`, then swap; `df` may read from `path`."""
    recover(df.sparkSession, path)
    write(df, next_folder(path))
    swap_in(df.sparkSession, path)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that keeps its state in `checkpoint`, the same after each restart.

    Batch numbers begin at 0 in every checkpoint, so a batch is known by both. Names sort by when they were given.
    """
    files, mark = Folders(spark, checkpoint), f"{checkpoint.rstrip('/')}/etlkit_stream_id"
    if not files.exists(mark):
        files.write(mark, f"{int(time.time() * 1000):014d}-{uuid.uuid4().hex[:12]}")
    return files.read(mark)
