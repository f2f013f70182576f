"""Sharding by histogram sort: exact byte counts below candidate boundaries, refined until the cuts are good."""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etlkit.llm.common import columns_of, staged

OVERHEAD = 16  # bytes a row costs besides its text
SLICE_BYTES = 256 << 20  # a sort task gets about this many bytes; a shard may consist of several slices
PROBES = 16  # candidate boundaries per open cut and round


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus OVERHEAD), text_crc32 (of the UTF-8 bytes; NULL text: of none)."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return columns_of(docs, "doc_id", "text").select("doc_id", (F.length(raw) + OVERHEAD).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))


CELLS_BITS = 12


def _numbers(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _place(cuts: list[tuple[int, int]]) -> Column:
    """How many cuts, given in key order, lie at or below the row's key (text_crc32, doc_id). NULL ids sort first.

    The first bits of the CRC look up the cuts of its cell; only those are compared one by one.
    """
    heads = [c >> (32 - CELLS_BITS) for c, _ in cuts]
    starts = _numbers([bisect_left(heads, cell) for cell in range((1 << CELLS_BITS) + 2)])
    cell = F.shiftright(F.col("text_crc32"), 32 - CELLS_BITS).cast("int")
    before, upto = F.get(starts, cell), F.get(starts, cell + 1)
    codes, ids = _numbers([c for c, _ in cuts]), _numbers([i for _, i in cuts])
    key_c, key_i = F.col("text_crc32"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    mine = F.arrays_zip(F.slice(codes, before.cast("int") + 1, (upto - before).cast("int")).alias("c"),
                        F.slice(ids, before.cast("int") + 1, (upto - before).cast("int")).alias("i"))
    below = F.filter(mine, lambda x: (x["c"] < key_c) | ((x["c"] == key_c) & (x["i"] <= key_i)))
    return (before + F.size(below)).cast("int")


def find_cuts(sizes: DataFrame, parts: int, tolerance: float = 0.002) -> list[tuple[int, int]]:
    """Keys (text_crc32, doc_id) that cut the rows, in key order, into `parts` of nearly equal bytes.

    A round counts, in one distributed aggregation, the exact bytes between all probes of all open cuts; each cut
    then keeps the interval its target falls into and places new probes there. A cut is done when a probe comes
    within `tolerance` of a part's share, or when its interval holds a single row or key. The driver sees at most
    parts * PROBES counts, whatever the number of rows. Cuts may fall inside a group of equal texts, so a group
    with a third of all rows spreads over as many parts as its bytes need. No rows: no cuts.
    """
    whole = sizes.agg(F.sum("size"), F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    if not whole[0] or parts < 2:
        return []
    total, low_id, high_id = whole[0], whole[1] if whole[1] is not None else 0, whole[2] if whole[2] is not None else 0
    span = high_id - low_id + 2  # ids, and one place before them for NULL

    def key(n: int) -> tuple[int, int]:
        c, i = divmod(n, span)
        return c, i + low_id - 1 if i else -(1 << 63)

    slack = max(1, int(tolerance * total / parts))
    state = {k: [0, (1 << 32) * span, (0, 0), (total, whole[3])] for k in range(1, parts)}  # low key, high key, bytes and rows below
    done: dict[int, int] = {}
    while len(done) < parts - 1:
        probes = sorted({lo + (hi - lo) * j // (PROBES + 1) for k, (lo, hi, _, _) in state.items() if k not in done
                         for j in range(1, PROBES + 1)} | {n for k in state if k not in done for n in state[k][:2]})
        found = {r[0]: r[1:] for r in sizes.groupBy(_place([key(n) for n in probes]).alias("p")).agg(F.sum("size"), F.count(F.lit(1))).collect()}
        below, counts = (0, 0), {}
        for p, n in enumerate(probes):
            more = found.get(p, (0, 0))
            below = (below[0] + more[0], below[1] + more[1])
            counts[n] = below
        for k in state:
            if k in done:
                continue
            target = total * k / parts
            lo, hi, b_lo, b_hi = state[k]
            for n in probes:
                if lo <= n <= hi and counts[n][0] <= target:
                    lo, b_lo = n, counts[n]
                elif lo <= n <= hi:
                    hi, b_hi = n, counts[n]
                    break
            state[k] = [lo, hi, b_lo, b_hi]
            best = min((lo, b_lo), (hi, b_hi), key=lambda x: abs(x[1][0] - target))
            if abs(best[1][0] - target) <= slack or hi - lo <= 1 or b_hi[1] - b_lo[1] <= 1:
                done[k] = best[0]
    return [key(done[k]) for k in range(1, parts)]


def shard_by_bytes(docs: DataFrame, shards: int = 40, tolerance: float = 0.002) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot (gapless from 0), grown_shard (NULL).

    Rows are ordered by (CRC of the text, doc_id), so equal texts stand together, and cut by `find_cuts`. After that
    there is one exchange: the slices are sorted and numbered. A shard larger than SLICE_BYTES consists of several
    slices whose row counts are added in front, so no task gets more than a slice. NULL texts count as empty; rows
    with one doc_id twice are both kept, in any order; an empty table gives no rows; other columns are ignored.
    """
    sizes = staged(document_sizes(docs), "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    per_shard = max(1, min(64, -(-total // (shards * SLICE_BYTES))))
    cuts = find_cuts(sizes, shards * per_shard, tolerance)
    place = _place(cuts) if cuts else F.lit(0)
    placed = sizes.withColumn("_slice", place).withColumn("shard", F.floor(F.col("_slice") / per_shard).cast("int"))
    order = Window.partitionBy("shard", "_slice").orderBy("text_crc32", "doc_id")
    rank = F.row_number().over(order).cast("long") - 1
    if per_shard > 1:  # at most shards * 64 rows
        counts = placed.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("n"))
        ahead = counts.select("_slice", F.coalesce(F.sum("n").over(
            Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
        numbered = placed.withColumn("_rank", rank).join(F.broadcast(ahead), "_slice").withColumn("slot", F.col("_rank") + F.col("_ahead"))
    else:
        numbered = placed.withColumn("slot", rank)
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
