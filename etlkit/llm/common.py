"""Helpers of the corpus operators: staged tables, stable hashes of words, sums of fixed-size arrays, linked groups."""

from __future__ import annotations

import gc
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etlkit.session import configure, drop_scratch, scratch_path

# Tasks get the code of this package with their functions, so it need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules["etlkit.llm"])

SLICE_BYTES = 1 << 20  # text handled at once by the array code of one task, or one document if it is longer
CACHED = 1 << 14  # numbers handled at once by chains of array operations, so that what lies between them stays in a core's cache
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession):
    """Spark deletes the shuffle files of writes started in here as each ends; nothing else reads them. The setting decides
    about files only, so threads that share a session cannot change one another's results by it."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of staged tables that nothing will read again."""
    for df in tables:
        drop_scratch(df.sparkSession, df.staged_at)


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that others cannot clash with those of an operator."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{n}`") for n in names])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    out = np.array(x, np.uint64)
    flat = out.reshape(-1)
    for i in range(0, len(flat), CACHED):
        _mix(flat[i:i + CACHED])
    return out


def _mix(x: np.ndarray) -> None:
    """`mixed` in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
SPACES = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64. The tables, as long as the longest asked for, or up to twice that, are kept once per process,
    where no function that is sent to tasks takes them along and no finished task leaves its own behind."""
    kept = vars(sys.modules.setdefault("_etlkit_powers", ModuleType("_etlkit_powers"))).setdefault("tables", {})
    if base not in kept or len(kept[base]) < n:
        full = np.full(max(n, CACHED, min(2 * len(kept.get(base, ())), SLICE_BYTES * 2)), base)
        full[0] = 1
        kept[base] = np.multiply.accumulate(full)
    return kept[base][:n]


def prefix_hashes(data: np.ndarray, codes: np.ndarray = BYTE_CODES) -> np.ndarray:
    """Polynomial hashes of all prefixes of `data`, modulo 2**64: entry i covers the first i items."""
    out, factors = np.zeros(len(data) + 1, np.uint64), powers(BASE, len(data))
    for i in range(0, len(data), CACHED):
        part = data[i:i + CACHED]
        values = codes[part] if part.dtype == np.uint8 else part.astype(np.uint64)
        values *= factors[i:i + CACHED]
        values[:1] += out[i:i + 1]
        np.cumsum(values, out=out[i + 1:i + 1 + len(part)])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end), equal for equal contents wherever they stand."""
    out, factors = np.empty(len(start), np.uint64), powers(BASE_INVERSE, len(prefix))
    for i in range(0, len(start), CACHED):
        a, part = start[i:i + CACHED], out[i:i + CACHED]
        np.subtract(prefix[end[i:i + CACHED]], prefix[a], out=part)
        part *= factors[a]
        _mix(part)
    return out


def window_hashes(prefix: np.ndarray, width: int) -> np.ndarray:
    """`span_hashes` of all spans of `width` items, in their order."""
    out, factors = np.empty(max(0, len(prefix) - width), np.uint64), powers(BASE_INVERSE, len(prefix))
    for i in range(0, len(out), CACHED):
        part = out[i:i + CACHED]
        np.subtract(prefix[i + width:i + width + len(part)], prefix[i:i + len(part)], out=part)
        part *= factors[i:i + len(part)]
        _mix(part)
    return out


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, one text after the other, and where each begins; NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, np.uint8)[ends[0]:ends[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut record batches into pieces of about `size` bytes of text: (rows, bytes, starts)."""
    for batch in batches:
        data, ends = text_arrays(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + size, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), data[ends[at]:ends[to]], ends[at:to + 1] - ends[at]
            at = to


def words_of(data: np.ndarray, ends: np.ndarray, lower: bool = True, between: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, by default between white space: (hash, text index, start, end), A-Z in lower case."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = np.frombuffer(data.tobytes().translate((~between).tobytes()), bool)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = ends[1:-1][ends[1:-1] < len(data)]
    first[cut] |= inside[cut]
    start = np.flatnonzero(first)
    last = inside  # true at the last byte of a word
    last[:-1] &= ~inside[1:] | first[1:]
    end = np.flatnonzero(last) + 1
    where = np.repeat(np.arange(len(ends) - 1), np.diff(np.searchsorted(start, ends)))
    return word_hashes(data, start, end, np.where(between, np.uint64(0), BYTE_CODES[LOWER] if lower else BYTE_CODES)), where, start, end


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """`span_hashes` of the words [start, end), one after the other, if `codes` is zero for the bytes between them."""
    out = np.empty(len(start), np.uint64)
    cuts = np.unique(np.append(np.searchsorted(start, np.arange(0, len(data), CACHED)), len(start)))
    for lo, hi in zip(cuts.tolist(), cuts[1:].tolist()):
        at, part = start[lo:hi] - start[lo], out[lo:hi]
        values = np.take(codes, data[start[lo]:end[hi - 1]])
        values *= powers(BASE, len(values))
        np.add.reduceat(values, at, out=part)
        part *= powers(BASE_INVERSE, len(values))[at]
        _mix(part)
    return out


def runs_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k successive word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(k))
    for i in range(0, n, CACHED):
        part = out[i:i + CACHED]
        for j in range(k):
            part *= BASE
            part += hashes[i + j:i + j + len(part)]
            _mix(part)
    return out


def array_rows(arrays: dict[int, np.ndarray], width: int = 1 << 13) -> pa.RecordBatch:
    """Rows (part, values) of fixed-size arrays, cut into parts that several tasks can add up; float32 arrays travel so."""
    parts, values = [], []
    for k, array in arrays.items():
        flat = array.ravel() if array.dtype == np.float32 else array.astype(np.float64).ravel()
        for i in range(0, len(flat), width):
            if flat[i:i + width].any():
                parts.append(k * (1 << 20) + i // width)
                values.append(flat[i:i + width].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(values, pa.binary())], ["part", "data"])


def added_up(rows: DataFrame, shapes: list[tuple[int, ...]], name: str, width: int = 1 << 13, single: bool = False) -> list[np.ndarray]:
    """Sum the arrays that tasks have put out with `array_rows`. Their size is fixed, whatever the input.

    Parts meet by their number, a few rows of each at a time, so no task holds more than its own parts.
    """
    spark = rows.sparkSession
    partial = staged(rows, name)

    narrow = range(1 << 31) if single else range(0)  # with `single`, tasks have put out float32

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = data.as_buffer()
                more = np.frombuffer(raw, np.float32 if part in narrow else np.float64).astype(np.float64)
                sums[part] = sums[part] + more if part in sums else more.copy()
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["part", "data"])

    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, 256)
    try:
        found = partial.repartition("part").mapInArrow(add, "part int, data binary").collect()
    finally:
        spark.conf.set(key, before)
    discard(partial)
    out = []
    for k, shape in enumerate(shapes):
        flat = np.zeros(int(np.prod(shape)))
        for row in found:
            if row.part >> 20 == k:
                i = (row.part & ((1 << 20) - 1)) * width
                flat[i:i + width] = np.frombuffer(row.data, np.float64)
        out.append(flat.reshape(shape))
    return out


LINKS_AT_ONCE = 1 << 20  # links that a task turns into stars at once


def stars(u: pa.Array, v: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Links that group the nodes as the links (u, v) do: each node but the smallest of its group with that smallest."""
    coded = pa.concat_arrays([u, v]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    a, b = rank[coded.indices.to_numpy()].reshape(2, -1)
    low = np.arange(len(order))
    while len(a):
        np.minimum.at(low, np.maximum(low[a], low[b]), np.minimum(low[a], low[b]))
        while not np.array_equal(low, low[low]):
            low = low[low]
        apart = low[a] != low[b]
        a, b = a[apart], b[apart]
    kept = np.flatnonzero(low != np.arange(len(low)))
    return coded.dictionary.take(pa.array(order[kept])), coded.dictionary.take(pa.array(order[low[kept]]))


def _starred(links: DataFrame) -> DataFrame:
    """Each task turns the links (u, v) it holds into stars, LINKS_AT_ONCE at a time, whatever their number."""
    def each(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= LINKS_AT_ONCE:
                yield turned(held)
                held, n = [], 0
        if n:
            yield turned(held)

    def turned(held):
        return pa.RecordBatch.from_arrays(list(stars(*[pa.concat_arrays([x.column(k) for x in held]) for k in range(2)])), ["u", "v"])

    return links.mapInArrow(each, links.schema)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each u has one v only, and no v is a u."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("low")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("low").alias("low")).where("up + low > 1 AND up > 0").isEmpty()


def linked_groups(links: DataFrame, name: str, most: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over the undirected links (a, b), for nodes with a link.

    Tasks first turn the links they hold into stars, which settles links that fit one task. Others are turned in rounds: each
    node's larger neighbours, then its smaller ones, are joined to its smallest neighbour, until all are stars; a chain of n
    links takes about log n rounds. The minimum of a node is aggregated before the shuffle, and it is one row, so a node with
    many links makes no large group. Half a round is written down at a time, since the driver's memory grows with the plans.
    """
    edges = staged(_starred(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()), f"{name}-links")
    for _ in range(most):
        released(edges.sparkSession)
        if _are_stars(edges):
            break
        # Both directions; m: smallest of a node and its neighbours.
        both = edges.union(edges.select("v", "u")).toDF("n", "o")
        least = both.groupBy("n").agg(F.min("o").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = staged(both.where("o > n").join(least, "n").select(F.col("o").alias("u"), F.col("m").alias("v")).union(
            least.select(F.col("n").alias("u"), F.col("m").alias("v"))).where("u <> v"), f"{name}-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        last, edges = edges, staged(_starred(large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()), f"{name}-round")
        discard(last, large)
    else:
        raise RuntimeError("links did not settle")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def released(spark: SparkSession) -> None:
    """Let the driver collect what no variable holds any more, so that executors delete the shuffle files behind it, and give
    the memory that it has freed back to the system.

    Without this files stay until the driver's memory fills, which in a long run of joins can be after the disks have; and
    what its threads have freed stays with them, some 200 MB after two pipelines.
    """
    gc.collect()
    jvm = spark.sparkContext._jvm
    jvm.System.gc()
    beans, name = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    asked = spark.sparkContext._gateway.new_array(jvm.Object, 4)  # what `jcmd` calls System.trim_native_heap, without arguments
    asked[0], asked[1] = name, "systemTrimNativeHeap"
    try:
        call.invoke(beans, asked)
    except Py4JJavaError:  # JVMs before 17.0.9 or without glibc have no such command
        pass


SMALL_KEYS = 500_000  # ids that may be sent to every task


def only_with(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows of `df` whose `column` is in `keys` (distinct). Up to SMALL_KEYS counted ids are broadcast, so wide rows
    stay where they are; more are joined by a shuffle."""
    few = keys.count() <= SMALL_KEYS
    return df.join(F.broadcast(keys) if few else keys, column, "left_semi")


def without(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows of `df` whose `column` is not in `keys` (distinct); NULLs stay. Joined like `only_with`."""
    keys = staged(keys, "dropped")
    few = keys.count() <= SMALL_KEYS
    return df.join(F.broadcast(keys) if few else keys, column, "left_anti").select(*df.columns)
