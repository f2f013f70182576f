"""Clustering across the files of a Parquet table, told by the key intervals in their footers."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from etlkit.session import staged
from etlkit.sinks.files import recover, replace_files

FILE_ROWS = 1_000_000
STRETCHES = 64  # stretches rewritten by one job


def file_intervals(spark: SparkSession, path: str, key: str) -> DataFrame:
    """file, rows, low, high: the interval of the key in each file, as the footers tell it; no row is read.

    `low` and `high` are text that sorts like the key: whole numbers, dates, times and text do. A file without statistics has no
    interval; one without values, an empty one.
    """
    names = spark.createDataFrame([(f,) for f in spark.read.parquet(path).inputFiles()], "file string")

    def look(batches):
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                fs, where = pafs.FileSystem.from_uri(name)
                with fs.open_input_file(where) as f:
                    meta = pq.ParquetFile(f).metadata
                chunks = [meta.row_group(g).column(c) for g in range(meta.num_row_groups) for c in range(meta.num_columns) if meta.row_group(g).column(c).path_in_schema == key]
                ends, known = [], True
                for chunk in chunks:
                    stats = chunk.statistics
                    if stats is not None and stats.has_min_max:
                        ends += [_sortable(stats.min), _sortable(stats.max)]
                    elif stats is None or stats.null_count != chunk.num_values:
                        known = False
                rows.append({"file": name, "rows": meta.num_rows, "low": min(ends, default="") if known else None, "high": max(ends, default="") if known else None})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("file", pa.string()), ("rows", pa.int64()), ("low", pa.string()), ("high", pa.string())]))

    return names.repartition(max(1, names.count() // 64)).mapInArrow(look, "file string, rows bigint, low string, high string")


def _sortable(value) -> str:
    """Text that sorts like the value: whole numbers from 0 to 2**64 after a shift, all else by its ISO or plain form."""
    if isinstance(value, bool) or not isinstance(value, int):
        return value.isoformat() if hasattr(value, "isoformat") else str(value)
    return f"{value + (1 << 63):020d}"


def overlaps(intervals: DataFrame, file_rows: int = FILE_ROWS) -> DataFrame:
    """The files with `stretch`, `depth` and `rewrite`: a sweep over the intervals in the order of their lower ends.

    Files whose intervals meet, in one value or more, form a stretch; `depth` is the largest number of files that hold one value of
    it. Neighbouring stretches of fewer than half of `file_rows` rows each are taken together. Stretches of several files
    are to be rewritten. If a file has no interval, all files are one stretch. One row per file that holds rows.
    """
    filled = intervals.where("rows > 0")
    bounds = filled.withColumn("_unknown", F.max(F.col("low").isNull()).over(Window.partitionBy(F.lit(0))))
    order = Window.partitionBy(F.lit(0)).orderBy("low", "high", "file")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opens = ~F.col("_unknown") & F.coalesce(F.col("low") > F.max("high").over(before), F.lit(True))
    stretched = bounds.withColumn("_opens", opens).withColumn("_s", F.sum(F.col("_opens").cast("int")).over(order)).drop("_opens", "_unknown")
    line = Window.partitionBy(F.lit(0)).orderBy("_s")
    sizes = stretched.groupBy("_s").agg(F.sum("rows").alias("_rows")).withColumn("_small", F.col("_rows") < file_rows / 2)
    goes_on = F.col("_small") & F.coalesce(F.lag("_small").over(line), F.lit(False))
    grouped = sizes.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("stretch", F.sum("_new").over(line).cast("bigint"))
    # Depth: how many files have begun less those that have ended, at each beginning.
    events = stretched.where("low IS NOT NULL").select("_s", F.inline(F.array(F.struct(F.col("low").alias("v"), F.lit(0).alias("k"), F.lit(1).alias("d")),
                                                                             F.struct(F.col("high").alias("v"), F.lit(1).alias("k"), F.lit(-1).alias("d")))))
    depth = events.withColumn("_d", F.sum("d").over(Window.partitionBy("_s").orderBy("v", "k"))).groupBy("_s").agg(F.max("_d").cast("bigint").alias("depth"))
    placed = stretched.join(grouped.select("_s", "stretch"), "_s").join(depth, "_s", "left")
    return placed.select("file", "rows", "low", "high", "stretch", "depth", (F.count(F.lit(1)).over(Window.partitionBy("stretch")) > 1).alias("rewrite"))


@dataclass(frozen=True)
class Reclustering:
    files: int
    rewritten: int
    depth: int


def recluster(spark: SparkSession, path: str, key: str, file_rows: int = FILE_ROWS) -> Reclustering:
    """Rewrite the files of an unpartitioned Parquet table that overlap in `key` or are small, so that every value lies in one file.

    Files that neither overlap nor have a small neighbour are not opened beyond their footers; a call that finds none to rewrite
    writes nothing. The rows of the others are range-partitioned by the key into files of about `file_rows` rows, sorted inside; a value's
    rows stay in one file, however many they are. Files come in and go by a plan that is written down first, so `recover`
    finishes what was begun; between two of its steps a reader may meet rows twice. Rows without a key lie in the first file.
    """
    recover(spark, path)
    found = staged(overlaps(file_intervals(spark, path, key), file_rows), "file-intervals")
    files, deepest = found.agg(F.count(F.lit(1)), F.max("depth")).first()
    schema, stretches = spark.read.parquet(path).schema, {}
    for row in found.where("rewrite").select("stretch", "file", "rows").collect():  # names of files
        stretches.setdefault(row.stretch, []).append(row)
    many = sorted(stretches.values(), key=lambda rows: rows[0].stretch)
    for some in (many[i:i + STRETCHES] for i in range(0, len(many), STRETCHES)):
        # A stretch by itself, so that no new file reaches over a file that stays.
        laid = [spark.read.schema(schema).parquet(*[r.file for r in rows]).repartitionByRange(max(1, sum(r.rows for r in rows) // file_rows), key).sortWithinPartitions(key)
                for rows in some]
        replace_files(reduce(DataFrame.unionByName, laid), path, [r.file for rows in some for r in rows])
    return Reclustering(files, sum(map(len, many)), deepest or 0)
