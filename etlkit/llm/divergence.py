"""How the sources of a language differ in their terms: recounted through transducers of the kept vocabulary."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from etlkit.llm.common import LOWER, columns_of, discard, slices, staged
from etlkit.llm.spans import packed, spans
from etlkit.llm.transducer import build, from_bytes, ordinals, to_bytes

LEAST_DOCUMENTS = 3
TOP = 200
SHARD_TERMS = 50_000  # terms of one transducer
SENT_BYTES = 64 << 20  # transducers that may be sent to every task, all together
HELD_ROWS = 500_000  # counts a task holds before it puts them out
BLOCK_TERMS = 4096  # terms of one block of the comparison of sources
BLOCK_SOURCES = 64

LETTERS = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, pa.Array]]:
    """Per slice of rows: (rows, text index of each term, its number, the distinct terms by number)."""
    for rows, data, ends in slices(batches):
        start, end, where = spans(data, ends, LETTERS)
        found = packed(LOWER[data], start, end, LETTERS).dictionary_encode()
        yield rows, where, found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def _numbered(rows: pa.RecordBatch, names: list[str], codes: dict[tuple, int]) -> np.ndarray:
    """The number of each row's values in the named columns; `codes` takes new ones."""
    return np.array([codes.setdefault(key, len(codes)) for key in zip(*(rows.column(n).to_pylist() for n in names))], np.int64)


def _added(tables: list[pa.Table], names: list[str]) -> pa.Table:
    return pa.concat_tables(tables).group_by(names).aggregate([("n", "sum")]).rename_columns([*names, "n"])


def count_terms(docs: DataFrame, names: list[str], per_document: bool) -> DataFrame:
    """(names..., term, n): in how many documents, or how often, a term stands in the rows with these names.

    A task adds up its rows before they are shuffled and holds about HELD_ROWS of them.
    """
    keys = [*names, "term"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for rows, where, ids, values in _terms(batches):
            codes: dict[tuple, int] = {}
            code, width = _numbered(rows, names, codes), max(1, len(values))
            if per_document:
                seen = np.unique(where * width + ids)
                where, ids = seen // width, seen % width
            both, n = np.unique(code[where] * width + ids, return_counts=True)
            told = [pa.array([c[k] for c in codes], pa.string()).take(pa.array(both // width)) for k in range(len(names))]
            terms = values.take(pa.array(both % width)).cast(pa.binary()).cast(pa.string())
            held.append(pa.table([*told, terms, pa.array(n.astype(np.int64))], names=[*keys, "n"]))
            if sum(t.num_rows for t in held) > HELD_ROWS:
                held = [_added(held, keys)]
                if held[0].num_rows > HELD_ROWS // 2:
                    yield from held[0].to_batches()
                    held = []
        if held:
            yield from _added(held, keys).to_batches()

    schema = ", ".join(f"{k} string" for k in keys) + ", n bigint"
    return docs.mapInArrow(count, schema).groupBy(*keys).agg(F.sum("n").alias("n"))


def vocabulary_of(docs: DataFrame, least: int) -> DataFrame:
    """(lang, term, shard, ordinal): terms in at least `least` documents of a language, numbered from 0 in byte order.

    Terms are range-partitioned into shards of about SHARD_TERMS and numbered inside them; a shard begins where the one
    before ends.
    """
    kept = staged(count_terms(docs, ["lang"], True).where(F.col("n") >= least).select("lang", "term"), "kept-terms")
    parts = max(1, -(-kept.count() // SHARD_TERMS))
    sharded = staged(kept.repartitionByRange(parts, "lang", "term").withColumn("shard", F.spark_partition_id()), "sharded-terms")
    discard(kept)
    # One row per language and shard.
    sizes = sharded.groupBy("lang", "shard").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("lang").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("lang", "shard", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("lang", "shard").orderBy("term")
    numbered = sharded.withColumn("place", F.row_number().over(inside) - 1).join(starts, ["lang", "shard"])
    out = staged(numbered.select("lang", "term", "shard", (F.col("base") + F.col("place")).alias("ordinal")), "vocabulary")
    discard(sharded)
    return out


# ---- recounting --------------------------------------------------------------------------------------------

MACHINE = "root binary, final binary, first binary, bits binary, before binary, target binary, weight binary"


def transducers(vocabulary: DataFrame) -> DataFrame:
    """One minimal transducer per language and shard, with its first term and that one's ordinal."""
    def make(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("ordinal")
        terms = rows.column("term").cast(pa.binary()).to_pylist()
        parts = to_bytes(build(terms))
        return pa.table([rows.column("lang").slice(0, 1), rows.column("ordinal").slice(0, 1), pa.array([terms[0]]), *[pa.array([p]) for p in parts]],
                        names=["lang", "base", "first_term", *[c.split()[0] for c in MACHINE.split(", ")]])

    return vocabulary.groupBy("lang", "shard").applyInArrow(make, f"lang string, base bigint, first_term binary, {MACHINE}")


def _look_up(shards: list[tuple], values: pa.Array) -> np.ndarray:
    """Ordinals of binary `values`, -1 for terms not kept; `shards` lists (first term, its ordinal, transducer) in order."""
    out = np.full(len(values), -1, np.int64)
    if not shards or not len(values):
        return out
    firsts = [s[0] for s in shards]
    shard = np.zeros(len(values), np.int64) if len(shards) == 1 else np.array([bisect_right(firsts, t) - 1 for t in values.to_pylist()])
    values = values.cast(pa.large_binary())
    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2], np.uint8)
    for s in np.unique(shard[shard >= 0]).tolist():
        mine = np.flatnonzero(shard == s)
        place = ordinals(shards[s][2], data, ends[:-1][mine], ends[1:][mine])
        out[mine] = np.where(place >= 0, place + shards[s][1], -1)
    return out


COUNTS = "lang string, source string, ordinal bigint, n bigint"


def _recount_in_text(docs: DataFrame, machines: DataFrame) -> DataFrame:
    """Counts by streaming the texts through transducers that every task holds."""
    held: dict[str, list[tuple]] = {}
    for row in machines.orderBy("lang", "base").collect():
        held.setdefault(row.lang, []).append((bytes(row.first_term), row.base, [bytes(p) for p in row[3:]]))
    sent = docs.sparkSession.sparkContext.broadcast(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = {lang: [(first, base, from_bytes(parts)) for first, base, parts in many] for lang, many in sent.value.items()}
        codes: dict[tuple, int] = {}
        keys, sums, rows_held = [], [], 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            return key, np.bincount(at, np.concatenate(sums)).astype(np.int64)  # counts of one task stay far below 2**53

        def told(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            names = list(codes)
            group = pa.array(key >> 40)
            return pa.RecordBatch.from_arrays([*[pa.array([g[k] for g in names], pa.string()).take(group) for k in (0, 1)],
                                               pa.array(key & ((1 << 40) - 1)), pa.array(n)], ["lang", "source", "ordinal", "n"])

        for rows, where, ids, values in _terms(batches):
            code, width = _numbered(rows, ["lang", "source"], codes), max(1, len(values))
            both, n = np.unique(code[where] * width + ids, return_counts=True)
            group, term = both // width, both % width
            langs = np.array([lang for lang, _ in codes], object)[group] if len(group) else np.zeros(0, object)
            place = np.full(len(both), -1, np.int64)
            for lang, many in shards.items():
                mine = np.flatnonzero(langs == lang)
                asked, back = np.unique(term[mine], return_inverse=True)
                place[mine] = _look_up(many, values.take(pa.array(asked)))[back]
            known = place >= 0
            keys.append(group[known] << 40 | place[known])
            sums.append(n[known])
            rows_held += int(known.sum())
            if rows_held > 4 * HELD_ROWS:
                key, total = added()
                keys, sums, rows_held = [key], [total], len(key)
                if rows_held > 2 * HELD_ROWS:
                    yield told(key, total)
                    keys, sums, rows_held = [], [], 0
        if rows_held:
            yield told(*added())

    return docs.mapInArrow(count, COUNTS).groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _recount_by_range(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Counts by streaming counted terms through the transducer of their range, for vocabularies too large to be sent.

    Kept terms and counted ones are range-partitioned together; a task builds the transducers of its kept terms, which come
    first, and then reads the counted ones batch by batch.
    """
    counted = count_terms(docs, ["lang", "source"], False)
    both = vocabulary.select("lang", "term", F.lit(None).cast("string").alias("source"), "ordinal").unionByName(counted, allowMissingColumns=True)
    parts = max(1, -(-vocabulary.count() // SHARD_TERMS))
    dealt = both.repartitionByRange(parts, "lang", "term").sortWithinPartitions(F.col("ordinal").isNull(), "lang", "term")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms: dict[str, tuple[list, list]] = {}
        shards: dict[str, list[tuple]] = {}
        for batch in batches:
            kept = int(np.sum(batch.column("ordinal").is_valid().to_numpy(zero_copy_only=False)))
            for lang, term, place in zip(*(batch.column(c).slice(0, kept).to_pylist() for c in ("lang", "term", "ordinal"))):
                many = terms.setdefault(lang, ([], []))
                many[0].append(term.encode())
                many[1].append(place)
            batch = batch.slice(kept)
            if not batch.num_rows:
                continue
            for lang in [lang for lang in terms if lang not in shards]:
                # The terms of a range are neighbours in the order, so one start tells all ordinals.
                shards[lang] = [(terms[lang][0][0], terms[lang][1][0], build(terms[lang][0]))]
            codes = _numbered(batch, ["lang"], names := {})
            place = np.full(batch.num_rows, -1, np.int64)
            for (lang,), code in names.items():
                mine = np.flatnonzero(codes == code)
                place[mine] = _look_up(shards.get(lang, []), batch.column("term").take(pa.array(mine)).cast(pa.binary()))
            known = pa.array(np.flatnonzero(place >= 0))
            yield pa.RecordBatch.from_arrays([batch.column("lang").take(known), batch.column("source").take(known), pa.array(place).take(known), batch.column("n").take(known)],
                                             ["lang", "source", "ordinal", "n"])

    return dealt.mapInArrow(count, COUNTS)


def recount(docs: DataFrame, vocabulary: DataFrame, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """(lang, source, ordinal, n): how often each kept term stands in each source of its language, where it does."""
    machines = staged(transducers(vocabulary), "transducers")
    size = machines.select(F.sum(sum(F.length(c.split()[0]) for c in MACHINE.split(", ")))).first()[0] or 0
    counts = _recount_in_text(docs, machines) if size <= sent_bytes else _recount_by_range(docs, vocabulary)
    out = staged(counts, "term-counts")
    discard(machines)
    return out


# ---- comparison --------------------------------------------------------------------------------------------

def _share(count: str, total: str, terms: str):
    """1 + floor(10**9 * (count + 1) / (total + terms)), in decimals that hold any count."""
    return F.expr(f"1 + CAST(1000000000 AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(20,0)) div CAST({total} + {terms} AS DECIMAL(20,0))")


def _sums_of_block(rows: pa.Table) -> pa.Table:
    """Sums over the terms of one block, for all ordered pairs of its sources: (lang, a, b, value, terms)."""
    number, place, share = (rows.column(c).to_numpy() for c in ("number", "ordinal", "p"))
    numbers, row = np.unique(number, return_inverse=True)
    base = place < 0  # a source's share of terms it lacks
    terms, column = np.unique(place[~base], return_inverse=True)
    shares = np.empty((len(numbers), len(terms)), np.int64)
    shares[row[base]] = share[base][:, None]
    shares[row[~base], column] = share[~base]
    block = numbers // BLOCK_SOURCES
    across = len(np.unique(block)) > 1
    a, b, value = [], [], []
    for i in range(len(numbers)):
        others = np.flatnonzero(block != block[i]) if across else np.delete(np.arange(len(numbers)), i)
        gap = shares[i] - shares[others]
        a.append(np.full(len(others), numbers[i]))
        b.append(numbers[others])
        value.append((gap * gap // shares[others]).sum(1))
    a, b, value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, value))
    return pa.table([pa.repeat(rows.column("lang")[0], len(a)), pa.array(a), pa.array(b), pa.array(value), pa.array(np.full(len(a), len(terms)))],
                    names=["lang", "a", "b", "value", "terms"])


def _compare_sources(groups: DataFrame, scored: DataFrame) -> DataFrame:
    """(lang, a, b, value): the sum over all kept terms for all ordered pairs of sources, by their numbers.

    Terms are compared in blocks of BLOCK_TERMS for two blocks of sources at a time, so a task holds a bounded matrix of
    shares. Terms that no source of the two blocks has are added at once, since their shares are those of absent terms.
    """
    block = F.expr(f"number div {BLOCK_SOURCES}")
    blocks = groups.groupBy("lang").agg((F.max(block) + 1).alias("blocks"))
    with_blocks = groups.join(blocks, "lang").withColumn("block", block)

    def in_pairs(rows: DataFrame, own: str) -> DataFrame:
        paired = rows.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        return paired.withColumns({"one": F.least(own, "other"), "two": F.greatest(own, "other")})

    placed = scored.join(with_blocks.select("lang", "number", "block", "blocks"), ["lang", "number"])
    rows = in_pairs(placed, "block").select("lang", F.expr(f"ordinal div {BLOCK_TERMS}").alias("terms_block"), "one", "two", "number", "ordinal", "p")
    met = rows.select("lang", "terms_block", "one", "two").distinct().withColumn("block", F.explode(F.array_distinct(F.array("one", "two"))))
    absent = met.join(with_blocks.select("lang", "block", "number", F.col("p0").alias("p")), ["lang", "block"]).select(
        "lang", "terms_block", "one", "two", "number", F.lit(-1).cast("bigint").alias("ordinal"), "p")
    sums = rows.unionByName(absent).groupBy("lang", "terms_block", "one", "two").applyInArrow(
        _sums_of_block, "lang string, a bigint, b bigint, value bigint, terms bigint")
    return sums.groupBy("lang", "a", "b").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value"), F.sum("terms").alias("terms"))


def audit_divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: how far each source is from the others of its language, and by which terms.

    Terms are longest stretches of ASCII letters and non-ASCII characters, A-Z in lower case; a language keeps those in at
    least `least` of its documents. A source's share of a kept term is 1 + floor(10**9 (n + 1) / (N + V)), n its occurrences,
    N those of all V kept terms; the language's is the same over all its sources. With p the source's share and q that of the
    other source ('pair') or of the language ('term'), the value of a term is floor((p - q)**2 / q). A pair has the sum over all
    kept terms, 0 if there are none; of the terms a source has with p > q the `top` are told. Ranks go from 1 by falling
    value, ties by byte order of the item: by ordinal, for terms.

    NULL text, lang and source are ''. Every row is a document, also if rows repeat or share a doc_id, which is not read. A
    source without terms has its pairs; an only source has none; an empty table gives no rows; other columns are ignored.
    The texts are read twice: to find the vocabulary, and to recount it through transducers. All numbers are exact.
    """
    docs = columns_of(docs, "text", "lang", "source").fillna("")
    vocabulary = vocabulary_of(docs.select("lang", "text"), least)
    counts = recount(docs, vocabulary, sent_bytes)

    # One row per source of a language from here on.
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    known = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "terms"])
    by_lang = Window.partitionBy("lang")
    groups = staged(known.select("lang", "source", "total", "terms", F.sum("total").over(by_lang).alias("lang_total"),
                                 (F.row_number().over(by_lang.orderBy("source")) - 1).cast("bigint").alias("number"))
                    .withColumn("p0", F.when(F.col("terms") > 0, _share("0", "total", "greatest(terms, 1L)"))), "sources")

    in_lang = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n"))
    scored = staged(counts.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "terms")).join(in_lang, ["lang", "ordinal"])
                    .withColumn("q", _share("lang_n", "lang_total", "terms")).select("lang", "source", "number", "ordinal", "p", "q"), "shares")

    own = Window.partitionBy("lang", "source")
    ranked = scored.where("p > q").withColumn("value", F.expr("(p - q) * (p - q) div q")).withColumn(
        "rank", F.row_number().over(own.orderBy(F.desc("value"), "ordinal"))).where(F.col("rank") <= top)
    terms = ranked.join(vocabulary.select("lang", "ordinal", "term"), ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    # The second side once per salt, so that the pairs of a language with many sources are not made in one task.
    salts = 16
    one = groups.withColumn("salt", F.col("number") % salts)
    two = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"), F.col("p0").alias("q0"), F.explode(F.expr(f"sequence(0L, {salts - 1}L)")).alias("salt"))
    pairs = one.join(two, ["lang", "salt"]).where("number <> b").withColumnRenamed("number", "a")
    compared = pairs.join(_compare_sources(groups, scored.select("lang", "number", "ordinal", "p")).withColumnRenamed("terms", "done"), ["lang", "a", "b"], "left")
    rest = F.expr("CAST((p0 - q0) * (p0 - q0) div q0 AS DECIMAL(20,0)) * CAST(terms - coalesce(done, 0) AS DECIMAL(18,0))")
    value = F.when(F.col("terms") > 0, F.coalesce("value", F.lit(0).cast("decimal(30,0)")) + rest).otherwise(F.lit(0).cast("decimal(30,0)")).cast("bigint")
    sources = compared.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")).withColumn(
        "rank", F.row_number().over(own.orderBy(F.desc("value"), "item")))
    return sources.unionByName(terms)
