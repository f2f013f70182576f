"""Tables compared by order-free digests: a tree of key ranges, of which only those that differ are opened."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.operators.reconciling import row_diff
from etlkit.session import drop_scratch, scratch_path

BITS = 12  # a range is cut into 2**BITS
LEAF_ROWS = 64  # ranges of no more rows are not cut further
SLICE_BITS = 10  # a slice of about 2**SLICE_BITS digests tells how much differs
DENSE = 1 / 16  # share of differing rows from which whole rows are compared at once
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def row_digest(df: DataFrame, columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of the listed columns that tell NULL from absence: a hash passes over NULLs, so a second value says where they are."""
    names = [F.col(f"`{c}`") for c in columns]
    empty = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in names])
    return [F.xxhash64(empty, *names), F.xxhash64(F.lit("other way"), *reversed(names), empty)]


@dataclass
class DigestDiff:
    """What a comparison found, and what it took: `moved` counts the digests that were shuffled one by one, `fetched` the whole rows; `dense`
    says that so much differs that all rows were compared whole."""

    rows: DataFrame
    rounds: int
    compared: int
    moved: int
    fetched: int
    dense: bool = False


def _address(df: DataFrame, key: str | None, columns: list[str]) -> Column:
    """A row's place in the tree, 64 bits: its key's value where that is a whole number or a date, else a hash of the key, or of the row without one."""
    if key is None:
        return row_digest(df, columns)[0]
    if isinstance(df.schema[key].dataType, WHOLE):
        value = F.unix_date(F.col(key)) if isinstance(df.schema[key].dataType, T.DateType) else F.col(key)
        return F.coalesce(value.cast("bigint"), F.lit(-(1 << 63)))
    return F.xxhash64(F.col(key), F.col(key).isNull())


def _differing_share(digests: DataFrame, rows: int) -> tuple[int, float]:
    """The digests in a slice of hash values, and the share of them that one side has more often."""
    bits = max(0, rows.bit_length() - SLICE_BITS)
    part = digests.where(F.col("_e").bitwiseAND(F.lit((1 << bits) - 1)) == 0)
    per_row = part.groupBy("_d", "_e").agg(F.sum("_s").alias("net"), F.count(F.lit(1)).alias("n"))
    looked, differing = per_row.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.abs("net")), F.lit(0))).first()
    return looked, differing / max(1, looked)


def digest_diff(source: DataFrame, target: DataFrame, key: str | None = None, leaf_rows: int = LEAF_ROWS) -> DigestDiff:
    """`row_diff` by digests: the whole rows one table has more often than the other, with `only_in` and `copies`.

    Each side is read once for (address, digest) per row, 24 bytes, which are written down unshuffled. A round adds up counts and
    digests per range and side, in one aggregation that moves a row per range and task; the ranges that differ are cut again, those of
    up to `leaf_rows` rows are looked into row by row. Ranges are the leading bits of the address and, when those are used
    up, of the digest, so a key with a third of all rows is cut as well. After at most 128 / BITS rounds the digests
    that one side has more often are known, and only the rows with these are read again and compared as they are.
    Equal tables cost one round. Where they are not, the digests of one slice of hash values, in which equal rows of both sides meet, are
    compared first: if more than DENSE of them differ, narrowing down would cost more than it spares, and all rows are compared as they
    are. The slice decides about the way only; both ways are exact. A NULL key is a key; `target` needs the columns of `source`, in any order.

    Two different rows pass for equal if both of their 64-bit hashes agree.
    """
    spark, columns = source.sparkSession, source.columns
    target = target.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in source.schema.fields])
    sides = [side.withColumns({"_p": _address(side, key, columns), "_d": row_digest(side, columns)[0], "_e": row_digest(side, columns)[1]}) for side in (source, target)]
    path = scratch_path(spark, "row-digests")
    sides[0].select("_p", "_d", "_e", F.lit(1).alias("_s")).unionByName(sides[1].select("_p", "_d", "_e", F.lit(-1).alias("_s"))).write.parquet(path)
    digests = spark.read.parquet(path)
    low, high, rows = digests.agg(F.min("_p"), F.max("_p"), F.count(F.lit(1))).first()

    # Levels: how many low bits of the address, then of the digest, a range leaves open.
    width = (high - low).bit_length() if rows else 0
    levels = [(left, 64) for left in range(width, 0, -BITS)] + [(0, left) for left in range(64, 0, -BITS)]
    # The address counts from the lowest one; as the difference may need 64 bits, it is cut by shifting bits without sign.
    offset = F.expr("_p") if high is None or high - low >= 1 << 63 else F.col("_p") - F.lit(low)

    def ranges(level: tuple[int, int]) -> list[Column]:
        one, two = level
        cut = lambda c, n: c if n <= 0 else F.lit(0).cast("bigint") if n >= 64 else F.shiftrightunsigned(c, n)
        return [cut(offset, one).alias("_r"), cut(F.col("_d"), two).alias("_q")]

    open_rows, rounds, moved, found, scratch = digests, 0, 0, [], [path]
    for k, level in enumerate(levels):
        rounds += 1
        finer = levels[k + 1] if k + 1 < len(levels) else (0, 0)
        wide = [F.sum(F.col(c).cast("decimal(20,0)") * F.col("_s")).alias(c) for c in ("_d", "_e")]
        sums = open_rows.groupBy(*ranges(level)).agg(F.sum("_s").alias("net"), F.count(F.lit(1)).alias("n"), *wide)
        path = scratch_path(spark, "ranges")
        sums.where("net <> 0 OR _d <> 0 OR _e <> 0").select("_r", "_q", "n").write.parquet(path)
        scratch.append(path)
        differ = spark.read.parquet(path)
        kinds = differ.agg(F.count_if(F.col("n") <= leaf_rows), F.count_if(F.col("n") > leaf_rows), F.sum(F.when(F.col("n") <= leaf_rows, F.col("n")))).first()
        if not k and kinds[1]:
            looked, share = _differing_share(digests, rows)
            moved += looked
            if share > DENSE:
                for done in scratch:
                    drop_scratch(spark, done)
                return DigestDiff(row_diff(source, target), rounds, rows, moved, rows, True)
        with_range = open_rows.withColumns({"_r": ranges(level)[0], "_q": ranges(level)[1]})
        if kinds[0]:
            moved += kinds[2]
            found.append(with_range.join(differ.where(F.col("n") <= leaf_rows).select("_r", "_q"), ["_r", "_q"], "left_semi").select("_d", "_e", "_s"))
        if not kinds[1]:
            break
        if not k:  # the whole table: nothing is left behind
            continue
        # Rows of ranges to be cut, written down for the next round where that leaves most behind.
        open_rows = with_range.join(differ.where(F.col("n") > leaf_rows).select("_r", "_q"), ["_r", "_q"], "left_semi").select("_p", "_d", "_e", "_s")
        path = scratch_path(spark, "open-digests")
        open_rows.write.parquet(path)
        scratch.append(path)
        open_rows = spark.read.parquet(path)
        if finer == (0, 0):
            moved += open_rows.count()
            found.append(open_rows.select("_d", "_e", "_s"))
    path = scratch_path(spark, "differing-rows")
    signs = found[0] if found else digests.limit(0).select("_d", "_e", "_s")
    for more in found[1:]:
        signs = signs.unionByName(more)
    signs.groupBy("_d", "_e").agg(F.sum("_s").alias("net")).where("net <> 0").select("_d", "_e").write.parquet(path)
    wanted = spark.read.parquet(path)
    kept = [side.join(wanted, ["_d", "_e"], "left_semi").select(*[F.col(f"`{c}`") for c in columns]) for side in sides]
    out = scratch_path(spark, "differing-sides")
    kept[0].withColumn("_s", F.lit(1)).unionByName(kept[1].withColumn("_s", F.lit(-1))).write.parquet(out)
    fetched = spark.read.schema(T.StructType([*source.schema.fields, T.StructField("_s", T.IntegerType())])).parquet(out)
    for done in [*scratch, path]:
        drop_scratch(spark, done)
    return DigestDiff(row_diff(fetched.where("_s = 1").drop("_s"), fetched.where("_s = -1").drop("_s")), rounds, rows, moved, fetched.count())
