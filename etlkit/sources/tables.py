"""Batch sources: files with a fixed schema, database extracts, incremental slices."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.operators.digests import row_digest
from etlkit.sources.schemas import CLINICAL_SCHEMA

CORRUPT = "_corrupt_record"
TEXT_FORMATS = ("csv", "json")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = CLINICAL_SCHEMA, bad_rows: str = "reject",
               **options: str) -> DataFrame:
    """Read a file or a folder with a fixed schema, without inference.

    For text formats, rows that do not parse are kept with their raw text in `_corrupt_record`
    (`bad_rows="reject"`) or stop the job (`bad_rows="fail"`). `split_corrupt` parts them.
    """
    if bad_rows not in ("reject", "fail"):
        raise ValueError(f"bad_rows must be 'reject' or 'fail', not {bad_rows!r}")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        if fmt in TEXT_FORMATS:
            if bad_rows == "reject":
                schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
                reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            else:
                reader = reader.option("mode", "FAILFAST")
        reader = reader.schema(schema)
    return reader.load(path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, rows that did not parse with their raw text)."""
    if CORRUPT not in df.columns:
        return df, df.sparkSession.createDataFrame([], f"{CORRUPT} string")
    # The parser looks only at the columns a query needs, and would pass a row whose bad cell is in another
    # one. This condition is true for every row and needs them all.
    whole = df.where(F.hash(*[c for c in df.columns if c != CORRUPT]) >= -2**31)
    return whole.where(F.col(CORRUPT).isNull()).drop(CORRUPT), whole.where(F.col(CORRUPT).isNotNull())


def range_predicates(column: str, lower: int, upper: int, parts: int) -> list[str]:
    """One condition per partition of a parallel database read. They overlap nowhere and leave no row out."""
    if parts < 2 or upper <= lower:
        return ["1 = 1"]
    step = max(1, (upper - lower) // parts)
    return predicates_of_cuts(column, [lower + step * i for i in range(1, parts) if lower + step * i < upper])


def predicates_of_cuts(column: str, cuts: list[int]) -> list[str]:
    """The conditions of the ranges that rising cuts leave; rows without a value are in the first one."""
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *middle, f"{column} >= {cuts[-1]}"]


def jdbc_reader(url: str, table: str, column: str, lower: int, upper: int, parts: int,
                fetchsize: int = 10_000, **properties: str) -> Callable[[SparkSession], DataFrame]:
    """A reader for `extract_table` that pulls a database table in `parts` parallel ranges of `column`."""
    predicates = range_predicates(column, lower, upper, parts)

    def read(spark: SparkSession) -> DataFrame:
        return spark.read.jdbc(url, table, predicates=predicates,
                               properties={"fetchsize": str(fetchsize), **properties})

    return read


def extract_table(spark: SparkSession, reader: str | Callable[[SparkSession], DataFrame],
                  stage_path: str | None = None, fail_if_empty: bool = True) -> tuple[DataFrame, int | None]:
    """Extract a whole table; returns the extract and its row count.

    `reader` is a Parquet path or a function such as `jdbc_reader(...)`. With `stage_path` the extract is
    written there by the executors and read back, so the source is read once.
    Without it the count is None and only emptiness is tested.
    """
    source = spark.read.parquet(reader) if isinstance(reader, str) else reader(spark)
    if stage_path is None:
        if fail_if_empty and source.isEmpty():
            raise ValueError("extract is empty")
        return source, None
    source.write.mode("overwrite").parquet(stage_path)
    staged = spark.read.schema(source.schema).parquet(stage_path)
    rows = staged.count()  # from the file footers
    if fail_if_empty and rows == 0:
        raise ValueError("extract is empty")
    return staged, rows


def incremental_slice(source: DataFrame, source_ts: str, target: DataFrame | None = None,
                      target_ts: str | None = None, mark: Column | None = None) -> DataFrame:
    """Source rows newer than the high-water mark.

    The mark is `mark` if the caller stored one, else the largest `target_ts` in the target. An empty
    target means a first load: every row with a `source_ts` comes through.
    """
    if mark is not None:
        return source.where(F.col(source_ts) > mark)
    first_load = F.lit("0001-01-01 00:00:00").cast(target.schema[target_ts].dataType)
    newest = target.select(F.coalesce(F.max(target_ts), first_load)).scalar()
    return source.where(F.col(source_ts) > newest)


# ---- rows that are committed late --------------------------------------------------------------------------

def _versions(df: DataFrame, ts: str, keys: list[str]) -> DataFrame:
    """(keys..., ts, _d, _e): one row per version of a key."""
    one, two = row_digest(df, df.columns)
    return df.select(*keys, ts, one.alias("_d"), two.alias("_e"))


def _since(df: DataFrame, ts: str, mark: str | None, look_back: str) -> Column:
    """Is the row above the mark less the look-back window?"""
    if mark is None:
        return F.col(ts).isNotNull()
    return F.col(ts) > F.lit(mark).cast(df.schema[ts].dataType) - F.expr(f"INTERVAL {look_back}")


def late_slice(source: DataFrame, ts: str, keys: list[str], ledger: DataFrame | None, mark: str | None, look_back: str) -> DataFrame:
    """Source rows above `mark` less `look_back` that the `ledger` does not hold, each version of a key once.

    A row that became visible late, below the mark, comes with the next slice, if it is not more than `look_back` late.
    Without a mark every row with a `ts` comes. Only the window is read: the condition on `ts` reaches the scan.
    """
    rows = source.where(_since(source, ts, mark, look_back))
    one, two = row_digest(rows, source.columns)
    marked = rows.withColumns({"_d": one, "_e": two}).dropDuplicates(["_d", "_e"])
    if ledger is not None:
        known = ledger.where(_since(ledger, ts, mark, look_back)).select("_d", "_e")
        marked = marked.join(known, ["_d", "_e"], "left_anti")
    return marked.select(*source.columns)


def next_ledger(fresh: DataFrame, ts: str, keys: list[str], ledger: DataFrame | None, mark: str | None, look_back: str) -> DataFrame:
    """The versions a later slice must not bring again: those inside the window of the new `mark`, as (keys..., ts, digest)."""
    held = _versions(fresh, ts, keys)
    if ledger is not None:
        held = held.unionByName(ledger)
    return held.where(_since(held, ts, mark, look_back))


# ---- balanced parts ----------------------------------------------------------------------------------------

CELLS = 1024  # counted parts of an interval that a cut may lie in


def balanced_cuts(df: DataFrame, column: str, parts: int, tolerance: float = 0.02) -> list[int]:
    """Values of a whole-number column that cut its rows into `parts` ranges of nearly equal counts: a range ends before its cut.

    Every open cut has an interval its value lies in. A round counts the rows of CELLS equal cells of all these intervals in one
    aggregation, and each cut goes on in the cell its target falls into, until a cell border is within `tolerance` of a
    part's share, or the cell is a single value, which cannot be cut: a key with more rows than a part makes a part of its own.
    At most 7 rounds for 64 bits, 13 for decimals of up to 37 digits without fraction; the driver sees the counts of cells. Rows
    without a value count in the first range.
    """
    low, high, rows, filled = df.agg(F.min(column), F.max(column), F.count(F.lit(1)), F.count(column)).first()
    if parts < 2 or not filled or low == high:
        return []
    low, high = int(low), int(high)
    # Distances from a border may take a bit more than the values do.
    kind = "bigint" if -(1 << 62) <= low and high < 1 << 62 else "decimal(38,0)"
    absent, value = rows - filled, F.col(column).cast(kind)
    number = lambda n: F.lit(str(n)).cast(kind)
    slack = tolerance * rows / parts / 2
    opened = {k: (low, high + 1, absent) for k in range(1, parts)}  # interval, rows before it
    cuts: dict[int, int] = {}
    while opened:
        intervals = sorted({i for i in opened.values()})
        place = F.lit(None).cast("bigint")
        for n, (a, b, _) in enumerate(intervals):
            step = -(-(b - a) // CELLS)
            cell = F.call_function("div", value - number(a), number(step))
            place = F.when((value >= number(a)) & (value < number(b)), F.lit(n * (CELLS + 1)) + cell).otherwise(place)
        counts = dict(df.where(F.col(column).isNotNull()).select(place.alias("p")).where("p IS NOT NULL").groupBy("p").agg(F.count(F.lit(1))).collect())
        for k, (a, b, before) in list(opened.items()):
            n, step, target = intervals.index((a, b, before)), -(-(b - a) // CELLS), rows * k / parts
            at, upto = a, before
            while at < b:
                more = counts.get(n * (CELLS + 1) + (at - a) // step, 0)
                if upto + more > target:
                    break
                at, upto = at + step, upto + more
            end = min(at + step, b)
            best = min(((at, upto), (end, upto + counts.get(n * (CELLS + 1) + (at - a) // step, 0))), key=lambda c: abs(c[1] - target))
            if abs(best[1] - target) <= slack or end - at <= 1 or at >= b:
                cuts[k] = best[0]
                del opened[k]
            else:
                opened[k] = (at, end, upto)
    return sorted({c for c in cuts.values() if low < c <= high})


def balanced_predicates(df: DataFrame, column: str, parts: int, tolerance: float = 0.02) -> list[str]:
    """One condition per part of a parallel extract, as `range_predicates` gives, but of nearly equal row counts for any keys."""
    return predicates_of_cuts(column, balanced_cuts(df, column, parts, tolerance))


def loaded_on(df: DataFrame, load_ts: str, as_of: str) -> DataFrame:
    """Rows loaded on the day `as_of`. The optimizer turns this into a pushed-down time range."""
    return df.where(F.to_date(load_ts) == F.lit(as_of).cast("date"))
