"""Jaccard join of word n-gram sets: fixed-size subsets for small sets, inverted lists for large ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from etlkit.llm.common import (LOWER, SPACES, added_up, array_rows, columns_of, discard, linked_groups, mixed, only_with, released, runs_of,
                               slices, staged)
from etlkit.llm.spans import packed, spans

WORDS = 5
SHARE = (80, 100)  # least intersection / union
SKETCH_BITS = 20  # counters of how common n-grams are: 8 MB, whatever the input
SUBSET = 2  # elements of the subsets that small sets are looked up by
STAR_ROUNDS = 2
MARKS = 16  # 64-bit words of parity bits: fewer exclude little between sets of over 500 elements that share a half
SETS = 256  # sets whose parity bits are counted at once
SIZES = 4096  # set sizes the cost model tells apart


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of each word between white space, A-Z in lower case. Words that are equal byte by byte are one, and
    each different one of a slice is hashed as a whole."""
    data, inside = LOWER[data], ~SPACES
    start, end, where = spans(data, ends, inside)
    words = packed(data, start, end, inside).dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w, 0x5EED) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    return known[words.indices.to_numpy(zero_copy_only=False)], where


def text_sets(data: np.ndarray, ends: np.ndarray, words: int = WORDS):
    """Sorted distinct n-gram hashes of each text: (values, starts). Shorter texts have one element, all their words."""
    hashes, where = word_hashes(data, ends)
    n = len(ends) - 1
    counts = np.bincount(where, minlength=n)
    grams = runs_of(hashes, words)
    inside = where[:len(grams)] == where[words - 1:] if len(grams) else np.zeros(0, bool)
    values, of = [grams[inside]], [where[:len(grams)][inside]]
    first = np.concatenate([[0], np.cumsum(counts)])
    for k in range(1, min(words, int(counts.max(initial=0)) + 1)):
        short = np.flatnonzero(counts == k)
        if len(short):
            acc = np.full(len(short), np.uint64(k))
            for j in range(k):
                acc = mixed(acc * np.uint64(0x9E3779B97F4A7C15) + hashes[first[short] + j])
            values.append(acc)
            of.append(short)
    values, of = np.concatenate(values), np.concatenate(of)
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    values, of = values[fresh], of[fresh]
    return values, np.searchsorted(of, np.arange(n + 1))


def fingerprints(values: np.ndarray, starts: np.ndarray, salt: int) -> np.ndarray:
    """One 64-bit number per set, from its elements."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(values ^ mixed(np.array([salt + 1], np.uint64))))])
    return mixed(sums[starts[1:]] - sums[starts[:-1]] + np.diff(starts).astype(np.uint64)).view(np.int64)


def parities(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per set MARKS * 64 bits: whether an odd number of its elements falls on each. Two sets that differ in d elements
    differ in at most d bits."""
    bits, n = MARKS * 64, len(starts) - 1
    out = np.zeros((n, MARKS), np.int64)
    for lo in range(0, n, SETS):
        cuts = starts[lo:lo + SETS + 1]
        of = np.repeat(np.arange(len(cuts) - 1) * bits, np.diff(cuts))
        odd = np.bincount(of + (values[cuts[0]:cuts[-1]] & np.uint64(bits - 1)).astype(np.int64), minlength=(len(cuts) - 1) * bits).reshape(-1, bits)
        out[lo:lo + SETS] = np.packbits((odd & 1).astype(np.uint8), axis=1).view(np.int64)
    return out


def _prefix(n, extra: int = 1):
    """How many of the rarest of n elements hold at least `extra` of those shared with any set that is similar enough."""
    return np.minimum(n, n - -(-SHARE[0] * n // SHARE[1]) + extra)


def boundary(sizes: dict[int, int], list_length: float) -> int:
    """The largest set size looked up by subsets, by cost: a subset costs one row, an inverted-list entry one row
    and the entries it meets. Sets from the boundary's share on are also in the lists, as partners of larger ones."""
    best, chosen = None, 0
    n = np.array(sorted(sizes))
    count = np.array([sizes[k] for k in n], float)
    p, q = _prefix(n), _prefix(n, SUBSET)
    listed, subsets = count * p * (1 + list_length), count * q * (q - 1) / 2
    for x in range(65):
        cost = subsets[n <= x].sum() + listed[n * SHARE[1] >= SHARE[0] * (x + 1)].sum()
        if best is None or cost < best:
            best, chosen = cost, x
    return int(chosen)


def _sets_pass(docs: DataFrame, salt: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(batches):
        counts = np.zeros(1 << SKETCH_BITS)
        doc_type = None
        for rows, data, ends in slices(batches):
            doc_type = rows.column("doc_id").type
            values, starts = text_sets(data, ends)
            counts += np.bincount((values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
            n, nothing = np.diff(starts), rows.num_rows
            marks = pa.FixedSizeListArray.from_arrays(pa.array(parities(values, starts).ravel()), MARKS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(fingerprints(values, starts, salt), mask=n == 0),
                pa.array(fingerprints(values, starts, salt + 1)), marks, pa.nulls(nothing, pa.int32()), pa.nulls(nothing, pa.binary())],
                ["doc_id", "n", "node", "check", "marks", "part", "data"])
        sums = array_rows({0: counts})
        if doc_type is not None and sums.num_rows:
            no = sums.num_rows
            yield pa.RecordBatch.from_arrays([pa.nulls(no, doc_type), *[pa.nulls(no, pa.int64())] * 3, pa.nulls(no, pa.list_(pa.int64())), sums.column(0), sums.column(1)],
                                             ["doc_id", "n", "node", "check", "marks", "part", "data"])

    return docs.mapInArrow(each, f"doc_id {kind}, n long, node long, check long, marks array<long>, part int, data binary")


def ranked(values: np.ndarray, starts: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Elements with the rarest of each set first, in one order for all sets; and the set each belongs to."""
    of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return values[np.lexsort((values, common[(values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], of))], of


def lookup_keys(values: np.ndarray, starts: np.ndarray, small: int):
    """(set index, key) rows: subsets of SUBSET prefix elements for sets up to `small`, prefix elements for the others."""
    n = np.diff(starts)
    of = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(values)) - starts[of]
    listed = (at < _prefix(n)[of]) & (n[of] * SHARE[1] >= SHARE[0] * (small + 1))
    out_of, out_keys = [of[listed]], [values[listed]]
    for s in np.unique(n[(n > 0) & (n <= small)]):
        sets = np.flatnonzero(n == s)
        i, j = np.triu_indices(int(_prefix(s, SUBSET)), 1)
        if len(i):
            a, b = values[starts[sets][:, None] + i], values[starts[sets][:, None] + j]
            out_of.append(np.repeat(sets, len(i)))
            out_keys.append(mixed(mixed(a) * np.uint64(3) + b).ravel())
    return np.concatenate(out_of), np.concatenate(out_keys)


def _keys_pass(docs: DataFrame, salt: int, common, small: int) -> DataFrame:
    def each(batches):
        counts = common.value
        for rows, data, ends in slices(batches):
            values, starts = text_sets(data, ends)
            nodes, n = fingerprints(values, starts, salt), np.diff(starts)
            _, first = np.unique(nodes, return_index=True)
            arranged, _ = ranked(values, starts, counts)
            of, keys = lookup_keys(arranged, starts, small)
            keep = np.isin(of, first)
            of, keys = of[keep], keys[keep]
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(nodes[of]), pa.array(n[of].astype(np.int32))], ["key", "node", "n"])

    return docs.mapInArrow(each, "key long, node long, n int")


def _tokens(docs: DataFrame, salt: int) -> DataFrame:
    def each(batches):
        for rows, data, ends in slices(batches):
            values, starts = text_sets(data, ends)
            yield pa.RecordBatch.from_arrays([pa.array(fingerprints(values, starts, salt)),
                                              pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values.view(np.int64)))], ["node", "elements"])
    return docs.mapInArrow(each, "node long, elements array<long>")


def _verified(pairs: DataFrame, docs: DataFrame, owners: DataFrame, salt: int, name: str) -> DataFrame:
    """The pairs (a, b) that are similar enough; sets are computed again for the documents that occur in a pair."""
    spark = docs.sparkSession
    pairs = staged(pairs, f"{name}-pairs")
    released(spark)
    needed = staged(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(owners, "node").select("doc_id").distinct(), f"{name}-needed")
    asked = only_with(docs, needed.where("doc_id IS NOT NULL"), "doc_id")
    if not needed.where("doc_id IS NULL").isEmpty():  # sets that only rows without an id hold
        asked = asked.union(docs.where("doc_id IS NULL"))
    sets = staged(_tokens(asked, salt), f"{name}-sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("elements").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    whole = F.size("x") + F.size("y") - shared
    links = staged(both.where(shared * SHARE[1] >= whole * SHARE[0]).select("a", "b").distinct(), f"{name}-links")
    del both
    discard(pairs, needed, sets)
    released(spark)
    return links


def _alike(a: str, b: str):
    return (F.col(a) * SHARE[1] >= F.col(b) * SHARE[0]) & (F.col(b) * SHARE[1] >= F.col(a) * SHARE[0])


def _may_be_close(a: str, b: str, n: str, n2: str):
    """False only for pairs whose parity bits differ in more places than the elements of similar sets could."""
    apart = sum([F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in range(1, MARKS)], F.bit_count(F.col(f"{a}0").bitwiseXOR(F.col(f"{b}0"))))
    return apart * (SHARE[0] + SHARE[1]) <= (F.col(n) + F.col(n2)) * (SHARE[1] - SHARE[0])


def _enough(small: int):
    """Whether a pair met under enough keys (n, n2 elements, `met` common prefix elements): elements outside the shorter
    prefix are at most n - prefix, and the rest of the needed intersection must be in both prefixes."""
    def prefix(n):
        return n - F.ceil(n * SHARE[0] / F.lit(SHARE[1])) + 1

    needed = F.ceil((F.col("n") + F.col("n2")) * SHARE[0] / F.lit(SHARE[0] + SHARE[1]))
    outside = F.greatest(F.col("n") - prefix(F.col("n")), F.col("n2") - prefix(F.col("n2")))
    return (F.greatest("n", "n2") <= small) | (F.col("met") >= needed - outside)


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles (size of its set), component_id (smallest doc_id reachable over links, itself included).

    Sets of WORDS-word shingles, A-Z lower-cased, are linked when intersection / union >= 0.8; equal sets form one
    node, so copies are never paired. A node is looked up by keys that any partner must share (see `lookup_keys`).
    First each node is compared with one node of every key it shares, in STAR_ROUNDS; then, over the whole key table,
    the nodes that are still in different components, if they share keys enough. So a group of mutual near copies is
    not expanded into pairs but no link between components is missed. Sets are compared by 64-bit hashes of their elements; nodes by 64-bit
    fingerprints, tested with a second one and salted anew on a collision. NULL, empty and blank texts have size 0 and
    no links; rows that share a doc_id are all kept; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = columns_of(docs, "doc_id", "text")
    for salt in range(0, 20, 2):
        found = staged(_sets_pass(docs, salt), "sets")
        known = found.where("part IS NULL").select("doc_id", "n", "node", "check")
        nodes = staged(found.where("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.min("check").alias("low"), F.max("check").alias("high"), F.any_value("n").alias("n"),
            *[F.any_value(F.get("marks", F.lit(i))).alias(f"m{i}") for i in range(MARKS)]), "nodes")
        if nodes.where("low <> high").isEmpty():
            break
    (counts,) = added_up(found.where("part IS NOT NULL").select("part", "data"), [(1 << SKETCH_BITS,)], "common")
    sizes = {r[0]: r[1] for r in known.groupBy(F.least("n", F.lit(SIZES)).alias("n")).count().collect() if r[0]}
    total = max(1.0, counts.sum())
    small = boundary(sizes, float((counts ** 2).sum() / total / max(1.0, total / (1 << SKETCH_BITS))) - 1)
    common = spark.sparkContext.broadcast(np.minimum(counts, 1e9).astype(np.int32))
    bucket = Window.partitionBy("key")
    keyed = _keys_pass(docs, salt, common, small).withColumn("_low", F.min("node").over(bucket)).withColumn("_high", F.max("node").over(bucket))
    shared = staged(keyed.where("_low <> _high").drop("_low", "_high").distinct().withColumn("component", F.col("node")), "keys")
    released(spark)
    owners = nodes.select("node", "doc_id")
    links = None
    for r in range(STAR_ROUNDS):
        lead = F.min(F.struct(F.xxhash64("node", F.pmod("key", F.lit(2)), F.lit(r)).alias("h"), "node", "n", "component")).over(bucket)
        stars = shared.withColumn("lead", lead).where((F.col("component") != F.col("lead.component")) & _alike("n", "lead.n")).select(
            F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct()
        named = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"{x}n"), *[F.col(f"m{i}").alias(f"{x}{i}") for i in range(MARKS)])
        stars = stars.join(named("a"), "a").join(named("b"), "b").where(_may_be_close("a", "b", "an", "bn")).select("a", "b")
        new = _verified(stars, docs, owners, salt, f"stars-{r}")
        links = new if links is None else links.union(new)
        groups = staged(linked_groups(links, f"stars-{r}"), "groups")
        now = shared.drop("component").join(groups, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
        used, shared = shared, staged(now.withColumn("_low", F.min("component").over(bucket)).withColumn("_high", F.max("component").over(bucket)).where(
            "_low <> _high").drop("_low", "_high"), "apart")
        discard(used, groups)
        released(spark)
    marks = [f"m{i}" for i in range(MARKS)]
    apart, shared = shared, shared.join(nodes.select("node", *marks), "node")
    other = shared.select("key", *[F.col(c).alias(f"{c}2") for c in ("node", "n", "component")], *[F.col(m).alias(f"o{m[1:]}") for m in marks])
    met = shared.join(other, "key").where((F.col("component") < F.col("component2")) & _alike("n", "n2") & _may_be_close("m", "o", "n", "n2"))
    pairs = met.groupBy(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).agg(
        F.count(F.lit(1)).alias("met"), F.max("n").alias("n"), F.max("n2").alias("n2")).where(_enough(small)).select("a", "b")
    groups = staged(linked_groups(links.union(_verified(pairs, docs, owners, salt, "rest")), "all"), "groups")
    discard(apart)
    released(spark)
    placed = known.join(groups, "node", "left").withColumn("_group", F.coalesce("component", "node"))
    least = placed.where("node IS NOT NULL").groupBy("_group").agg(F.min("doc_id").alias("component_id"))
    return placed.join(least, "_group", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
