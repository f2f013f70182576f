"""Near-duplicate vectors: rotated binary codes bound inner products, exact cosines decide what the bounds leave open."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.llm.common import columns_of, linked_groups, staged

COSINE = 0.9
SAMPLE = 4096  # most pivots, and most vectors that they are chosen from
BLOCK = 16384  # most vectors of one side of a comparison
SPREAD = 8  # blocks that also few vectors are cut into
TILE = 2048  # vectors of one side that are multiplied at once
SLACK = 1e-6  # for rounding, in angles


def rotation(dimension: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed + dimension).normal(size=(dimension, dimension)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, their signs as code vectors of length 1, and the factor <code, vector> of each."""
    rotated = unit @ rotation(unit.shape[1])
    code = np.where(rotated >= 0, 1.0, -1.0) / np.sqrt(unit.shape[1])
    return rotated, code, (rotated * code).sum(1)


def compared(x: np.ndarray, y: np.ndarray, cosine: float = COSINE):
    """Pairs (i, j) with cosine(x_i, y_j) >= cosine, for unit vectors, as arrays of the pairs of one tile after the other.

    With f = <code, x>, <code, y> / f estimates <x, y> without bias over rotations, since code = f x + sqrt(1 - f^2) e
    with e orthogonal to x. As |<e, y>| <= sqrt(1 - <x, y>^2), two bounds hold for certain: below
    f c - sqrt((1 - f^2) (1 - c^2)) no pair reaches c. Only pairs that the bounds of both sides leave open, are
    computed exactly, in double precision.
    """
    if not len(x) or not len(y):
        return
    (rx, cx, fx), (ry, cy, fy) = encode(x), encode(y)
    tail = np.sqrt(1 - cosine ** 2)
    least_x = (fx * cosine - np.sqrt(np.maximum(1 - fx ** 2, 0)) * tail - 1e-5).astype(np.float32)
    least_y = fy * cosine - np.sqrt(np.maximum(1 - fy ** 2, 0)) * tail - 1e-5
    codes, rotated = cx.astype(np.float32), np.ascontiguousarray(ry.T, np.float32)
    for a in range(0, len(x), TILE):
        for b in range(0, len(y), TILE):
            i, j = np.nonzero(codes[a:a + TILE] @ rotated[:, b:b + TILE] >= least_x[a:a + TILE, None])
            i, j = i + a, j + b
            for k in range(0, len(i), 200_000):
                p, q = i[k:k + 200_000], j[k:k + 200_000]
                keep = np.einsum("ij,ij->i", rx[p], cy[q]) >= least_y[q]
                p, q = p[keep], q[keep]
                keep = np.einsum("ij,ij->i", x[p], y[q]) >= cosine
                if keep.any():
                    yield p[keep], q[keep]


def compare(x: np.ndarray, y: np.ndarray, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of `compared`."""
    pairs = [(np.zeros(0, int), np.zeros(0, int)), *compared(x, y, cosine)]
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def unit_rows(column: pd.Series) -> np.ndarray:
    x = np.array(column.tolist(), np.float64)
    x = x / np.abs(x).max(1)[:, None]  # squares of very large or small numbers would overflow or vanish
    return x / np.sqrt((x * x).sum(1))[:, None]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A few links that keep the pairs' components together."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def far_apart(unit: np.ndarray, most: int, cosine: float = COSINE) -> np.ndarray:
    """Up to `most` of the given vectors, in their order, none of which links with another."""
    chosen = np.zeros((0, unit.shape[1]))
    for x in unit:
        if len(chosen) == most:
            break
        if not len(chosen) or (chosen @ x).max() < cosine:
            chosen = np.vstack([chosen, x])
    return chosen


def angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1, 1))


def _in_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    """One pair of blocks: how many vectors each links with, and links that keep their components together."""
    rows = rows.sort_values("id", ignore_index=True)
    unit, copies = unit_rows(rows["vector"]), rows["copies"].to_numpy()
    first, second = int(rows["first"].iloc[0]), int(rows["second"].iloc[0])
    block = rows["block"].to_numpy()
    a, b = np.flatnonzero(block == first), np.flatnonzero(block == second)
    n = np.zeros(len(rows), np.int64)
    moved = to = np.zeros(0, np.int64)
    for i, j in compared(unit[a], unit[b]):
        i, j = a[i], b[j]
        if first == second:
            i, j = i[i < j], j[i < j]
        n += (np.bincount(i, copies[j], len(rows)) + np.bincount(j, copies[i], len(rows))).astype(np.int64)
        moved, to = forest(len(rows), np.concatenate([i, moved]), np.concatenate([j, to]))
    ids = rows["id"].to_numpy()
    some = np.flatnonzero(n)
    return pd.DataFrame({"id": np.concatenate([ids[some], ids[moved]]), "n": np.concatenate([n[some], np.zeros(len(moved), np.int64)]),
                         "other": pd.array(np.concatenate([np.full(len(some), -1), ids[to]]), "Int64").astype("Int64")}).assign(
                             link=np.concatenate([np.zeros(len(some), bool), np.ones(len(moved), bool)]))


def link_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept, for cosine >= 0.9.

    Equal vectors are compared once and counted with their copies. Every vector is at home in the cell of its nearest
    pivot, and visits each cell of a smaller number that its angle to the pivot does not rule out: with a member of the
    cell it can only link if that angle is at most the cell's radius and the link angle together (triangle inequality).
    So each pair that links meets in one cell, and in one only. Home vectors and visitors are cut into blocks, and a
    comparison holds two of them, of at most about BLOCK vectors whatever the size of the cell; links are counted, not
    emitted. Vectors that lie in all directions alike rule out little, and then nearly all pairs are compared.
    Vectors that are NULL, empty, zero or hold NULL or non-finite numbers link with nothing; vectors of different lengths
    never link; rows that share an id are compared as copies or links of one another but reported once per row.
    """
    spark = vectors.sparkSession
    kind = "array<float>" if vectors.schema[column].dataType.simpleString() == "array<float>" else "array<double>"
    rows = columns_of(vectors, key, column).select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vector"))
    # The largest component, NULL or NaN if there is one: NaN counts as larger than all numbers.
    largest = F.aggregate("vector", F.lit(0.0), lambda s, x: F.when(s.isNull() | x.isNull(), F.lit(None)).otherwise(F.greatest(s, F.abs(x))))
    sound = F.coalesce((largest > 0) & (largest < float("inf")), F.lit(False))
    classes = staged(rows.where(sound).groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")).where("id IS NOT NULL").withColumn(
        "dimension", F.size("vector")), "vectors")
    counts = {r[0]: r[1] for r in classes.groupBy("dimension").count().collect()}
    pivots, sizes = {}, {}
    for d, n in counts.items():
        sizes[d] = min(BLOCK, max(256, -(-n // SPREAD)))
        most = min(SAMPLE, max(1, n // sizes[d]))
        chosen = classes.where(F.col("dimension") == d).orderBy(F.xxhash64("id", F.lit("pivot"))).limit(min(SAMPLE, 4 * most))
        pivots[d] = far_apart(unit_rows(chosen.select("vector").toPandas()["vector"]), most)
    shared = spark.sparkContext.broadcast((pivots, sizes))

    def homes(batches):
        for pdf in batches:
            for d, part in pdf.groupby("dimension"):
                for at in range(0, len(part), 4096):
                    piece = part.iloc[at:at + 4096]
                    away = angles(unit_rows(piece["vector"]), shared.value[0][d])
                    home = away.argmin(1)
                    yield piece.assign(home=home.astype(np.int32), away=away[np.arange(len(piece)), home])

    homed = staged(classes.withColumn("vector", F.col("vector").cast(kind)).mapInPandas(
        homes, f"vector {kind}, id long, copies long, dimension int, home int, away double"), "homes")
    radii = {d: np.full(len(p), -np.inf) for d, p in pivots.items()}
    for d, home, away in homed.groupBy("dimension", "home").agg(F.max("away")).collect():
        radii[d][home] = away + np.arccos(COSINE) + SLACK
    bounds = spark.sparkContext.broadcast(radii)

    def cells(batches):
        for pdf in batches:
            for d, part in pdf.groupby("dimension"):
                p = shared.value[0][d]
                for at in range(0, len(part), 4096):
                    piece = part.iloc[at:at + 4096]
                    home = piece["home"].to_numpy()
                    visited = (angles(unit_rows(piece["vector"]), p) <= bounds.value[d]) & (np.arange(len(p)) < home[:, None])
                    visited[np.arange(len(piece)), home] = True
                    yield piece.drop(columns="away").assign(limit=shared.value[1][d], cells=[np.flatnonzero(v).astype(np.int32) for v in visited])

    inside = staged(homed.mapInPandas(cells, f"vector {kind}, id long, copies long, dimension int, home int, limit int, cells array<int>"), "cells").withColumn(
        "cell", F.explode("cells")).withColumn("at_home", F.col("cell") == F.col("home"))
    share = lambda at_home: F.ceil(F.count_if(F.col("at_home") == at_home) / F.max("limit")).cast("int")
    blocks = F.broadcast(inside.groupBy("dimension", "cell").agg(share(True).alias("own"), share(False).alias("visiting")))
    # Blocks of visitors are numbered after those at home, and only meet the latter.
    cut = inside.join(blocks, ["dimension", "cell"]).withColumn("block", F.when(F.col("at_home"), F.pmod(F.xxhash64("id"), F.col("own"))).otherwise(
        F.col("own") + F.pmod(F.xxhash64("id"), F.greatest("visiting", F.lit(1)))).cast("int"))
    partners = F.when(F.col("at_home"), F.col("own") + F.col("visiting")).otherwise(F.col("own"))
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0), partners - 1))).select(
        "vector", "id", "copies", "dimension", "cell", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    found = staged(paired.groupBy("dimension", "cell", "first", "second").applyInPandas(_in_blocks, "id long, n long, other long, link boolean"), "found")
    groups = linked_groups(found.where("link").select(F.col("id").alias("a"), F.col("other").alias("b")), "vectors")
    links = found.where("NOT link").groupBy("id").agg(F.sum("n").alias("n"))
    result = classes.join(links, "id", "left").join(groups, classes["id"] == groups["node"], "left").select(
        "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    marked = rows.withColumn("vector", F.when(sound, F.col("vector")))
    return marked.join(result, "vector", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"),
        (F.col("id") == F.coalesce("component_id", "id")).alias("kept"))
