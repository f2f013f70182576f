"""Line deduplication up to one edited character, by keys of deletion neighbourhoods. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etlkit.llm.common import columns_of, discard, only_with, released, staged

LEAST = 16  # characters; shorter lines are only compared for equality
SHORT = 40  # up to here a line emits its whole deletion neighbourhood
CROWDED = 32  # distinct lines with one equal half from which the other half's neighbourhood is emitted as well


ROW = "_row"
LAST = (1 << 63) - 1  # where NULL ids stand


def _told_apart(docs: DataFrame) -> DataFrame:
    """`docs` with ROW: 0, or, if ids are NULL or repeat, a number of each row's own, written down with it."""
    if docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        return docs.withColumn(ROW, F.lit(0).cast("long"))
    return staged(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered-documents")


def _lines(docs: DataFrame) -> DataFrame:
    """order (doc_id, row, line number), line; NULL ids stand after all others."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.col(ROW).alias("row"), F.posexplode(F.split("text", "\n")).alias("at", "line")).select(
        F.struct("doc_id", "row", "at").alias("order"), "line").where(F.trim("line") != "")


def _named(df: DataFrame) -> DataFrame:
    """With the line's length and a 128-bit name: equal lines have equal names."""
    return df.withColumn("length", F.char_length("line")).withColumn(
        "name", F.struct(F.xxhash64("line").alias("a"), F.xxhash64(F.lit("line"), "line").alias("b")))


KEYS = "array<struct<key:bigint,side:int>>"


def _variants(text: Column, head: Column, least: Column) -> Column:
    """Keys (key, side) of the deletion neighbourhood of `text` under the common key `head`.

    Side 2: the text without its character i, with i: texts of one length that share such a key differ in character i
    alone. Side 1: the text without a character, against side 0, a shorter text as it is.
    """
    size = F.char_length(text)
    cut = lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1))
    places = F.sequence(F.lit(1), size)
    same = F.transform(places, lambda i: F.struct(F.xxhash64(head, F.lit("v"), size, i, cut(i)).alias("key"), F.lit(2).alias("side")))
    less = F.transform(places, lambda i: F.struct(F.xxhash64(head, F.lit("x"), cut(i)).alias("key"), F.lit(1).alias("side")))
    self = F.array(F.struct(F.xxhash64(head, F.lit("x"), text).alias("key"), F.lit(0).alias("side")))
    return F.concat(F.when(size > 0, same).otherwise(F.array().cast(KEYS)), F.when((size > 0) & (size > least), less).otherwise(F.array().cast(KEYS)), self)


def _half_keys(line: Column, size: Column) -> Column:
    """Keys (key, longer, tail) of long lines: one edit leaves one half as it is, so lines of `length` characters meet
    those of equal length, and those with one more, under the half that did not change."""
    def of(n: Column, longer: int) -> list[Column]:
        half = F.floor(n / 2).cast("int")
        return [F.struct(F.xxhash64(F.lit("p"), n, F.substr(line, F.lit(1), half)).alias("key"), F.lit(longer).alias("longer"), F.lit(False).alias("tail")),
                F.struct(F.xxhash64(F.lit("s"), n, F.substr(line, size - (n - half) + 1)).alias("key"), F.lit(longer).alias("longer"), F.lit(True).alias("tail"))]

    own = F.array(*of(size, 0))
    return F.when(size > SHORT, F.concat(own, F.array(*of(size - 1, 1)))).when(size == SHORT, own)


def _with_earlier(rows: DataFrame) -> DataFrame:
    """(line, earlier) pairs from rows (key, side, name, order): each with the first line of the other side of its key."""
    once = rows.groupBy("key", "side", "name").agg(F.min("order").alias("order"))
    first = lambda *sides: F.min(F.when(F.col("side").isin(*sides), F.col("order"))).over(Window.partitionBy("key"))
    both = once.withColumn("_0", first(0, 2)).withColumn("_1", first(1, 2))
    partners = F.filter(F.array(F.when(F.col("side") != 0, F.col("_0")), F.when(F.col("side") != 1, F.col("_1"))), lambda o: o < F.col("order"))
    return both.select(F.col("order").alias("line"), F.explode(partners).alias("earlier")).distinct()


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row, at): lines that equal an earlier line, or, from LEAST characters on, are one edit away from one.

    `docs` has a ROW. Order is (doc_id, row, line number); the earlier line counts whether or not it stays itself. Short lines emit their
    deletion neighbourhood; long ones their halves, and where more than CROWDED lines share a half, the neighbourhood
    of the other half, so no group of lines is paired with itself. Pairs found are verified by edit distance.
    """
    docs = columns_of(docs, "doc_id", ROW, "text")
    named = _named(_lines(docs))
    seen = staged(named.groupBy("name").agg(F.min("order").alias("order"), F.max("length").alias("length")), "line-names")
    short = named.where(F.col("length").between(LEAST, SHORT)).select("name", "order", F.inline(_variants(F.col("line"), F.lit(0), F.lit(LEAST))))
    near = _with_earlier(short)
    halves = named.where(F.col("length") >= SHORT).select("name", "order", F.inline(_half_keys(F.col("line"), F.col("length"))))
    once = halves.groupBy("key", "longer", "tail", "name").agg(F.min("order").alias("order"))
    met = staged(once.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("n > 1"), "line-halves")
    light = met.where(F.col("n") <= CROWDED)
    other = light.select("key", F.col("longer").alias("longer2"), F.col("name").alias("name2"), F.col("order").alias("earlier"))
    near = near.union(light.join(other, "key").where((F.col("earlier") < F.col("order")) & (F.col("name") != F.col("name2")) & (F.col("longer") + F.col("longer2") < 2)).select(
        F.col("order").alias("line"), "earlier").distinct())
    crowded = met.where(F.col("n") > CROWDED).select("key", "longer", "tail", "name", "order")
    if not crowded.isEmpty():
        text = _text_of(docs, crowded.select("order").distinct())
        size = F.char_length("line") - F.col("longer")
        half = F.floor(size / 2).cast("int")
        rest = F.when(F.col("tail"), F.substr(F.col("line"), F.lit(1), F.char_length("line") - (size - half))).otherwise(F.substr(F.col("line"), half + 1))
        keyed = crowded.join(text, "order").withColumn("rest", rest).select("name", "order", "longer", F.inline(_variants(F.col("rest"), F.col("key"), F.lit(0))))
        # Under a half's key only lines with one more character act as the longer side, and only the others as the shorter.
        near = near.union(_with_earlier(keyed.where((F.col("side") == 2) & (F.col("longer") == 0) | (F.col("side") == F.col("longer")) & (F.col("side") < 2))))
    near = staged(near, "line-pairs")
    text = staged(_text_of(docs, near.select(F.col("line").alias("order")).union(near.select("earlier")).distinct()), "line-texts")
    checked = near.join(text.select(F.col("order").alias("line"), F.col("line").alias("x")), "line").join(
        text.select(F.col("order").alias("earlier"), F.col("line").alias("y")), "earlier").where(F.levenshtein("x", "y", 1).between(0, 1))
    gone = staged(checked.select(F.col("line").alias("order")).distinct(), "line-near")
    discard(met, near, text)
    released(docs.sparkSession)
    first = seen.join(gone, "order", "left_anti").select("name", "order")
    # What stays is the first of its name and not near an earlier one.
    kept = first.select("order")
    return named.select("order").distinct().join(kept, "order", "left_anti").select("order.doc_id", "order.row", "order.at")


def _text_of(docs: DataFrame, orders: DataFrame) -> DataFrame:
    """(order, line) of the given lines, read again from their documents."""
    ids = staged(orders.select("order.doc_id").distinct(), "line-docs")
    some = only_with(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), ROW, "text"), ids, "doc_id")
    return _lines(some).join(orders, "order", "left_semi")


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """`docs` with the repeated lines taken out of `text`, and n_lines, n_removed.

    NULL texts stay NULL; blank lines stay, the texts' line breaks too; a document may end up empty. Each row is a document of its
    own: those that share a doc_id, or have none, follow one another in any one order. An empty table gives no rows. Columns of other names are carried along; n_lines
    and n_removed replace columns of those names.
    """
    names, docs = docs.columns, _told_apart(docs)
    gone = repeated_lines(docs).groupBy(F.col("doc_id").alias("_id"), F.col("row").alias(ROW)).agg(F.collect_list("at").alias("_gone"))
    # The lines pass the join as an array: split once, then picked by position.
    keyed = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn("_lines", F.split("text", "\n")).drop("text")
    out = keyed.join(gone, ["_id", ROW], "left").withColumn("_gone", F.coalesce("_gone", F.array().cast("array<int>")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    out = out.withColumn("text", F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n"))
    out = out.withColumn("n_lines", F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines"))).withColumn("n_removed", F.size("_gone"))
    return out.select(*names, *[c for c in ("n_lines", "n_removed") if c not in names])
