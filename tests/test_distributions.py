"""Distributions against brute force."""

import math
import random

import pytest

from etlkit.operators import bucket_counts, equal_depth_edges, ks_distance, quantiles, stability
from etlkit.operators.quantiles import exact_quantiles
from pyspark.sql import functions as F


def brute_ks(a, b):
    a, b = sorted(x for x in a if x is not None), sorted(x for x in b if x is not None)
    if not a or not b:
        return len(a), len(b), None, None
    gaps = [(abs(sum(y <= x for y in a) * len(b) - sum(y <= x for y in b) * len(a)), -x) for x in {*a, *b}]
    gap, at = max(gaps)
    return len(a), len(b), gap / (len(a) * len(b)), -at


def frame(spark, x, y):
    n = max(len(x), len(y))
    return spark.createDataFrame(list(zip(x + [None] * (n - len(x)), y + [None] * (n - len(y)))), "x double, `y.z` int").repartition(3)


@pytest.mark.parametrize("seed", range(3))
def test_distance_against_brute_force(spark, seed):
    rng = random.Random(seed)
    one = lambda n, m: [None if rng.random() < 0.1 else rng.choice([7.5, rng.randrange(m) / 4, -rng.random()]) for _ in range(n)]
    whole = lambda n, m: [None if rng.random() < 0.1 else rng.choice([3, rng.randrange(m)]) for _ in range(n)]
    a, b = (one(300, 90), whole(200, 40)), (one(170, 70), whole(250, 60))
    got = {r.column_name: tuple(r)[1:] for r in ks_distance(frame(spark, *a), frame(spark, *b), ["x", "y.z"]).collect()}
    assert got == {"x": brute_ks(a[0], b[0]), "y.z": brute_ks(a[1], b[1])}


def test_distance_of_empty_and_equal_tables(spark):
    a = frame(spark, [1.0, 2.0, 2.0], [1])
    assert sorted(map(tuple, ks_distance(a, a.limit(0), ["x", "y.z"]).collect())) == [("x", 3, 0, None, None), ("y.z", 1, 0, None, None)]
    assert [tuple(r) for r in ks_distance(a, a, ["x"]).collect()] == [("x", 3, 3, 0.0, 1.0)]


def brute_quantiles(values, qs):
    values = sorted(v for v in values if v is not None)
    return [values[max(1, math.ceil(round(q * len(values), 6))) - 1] for q in qs] if values else [None] * len(qs)


@pytest.mark.parametrize("few,band,share", [(0, 0.01, 0.05), (100_000, 0.01, 0.05), (0, 0.0, 0.01), (0, 0.3, 1.0)])
def test_quantiles_are_exact_whatever_the_brackets(spark, monkeypatch, few, band, share):
    """Also where the sample's brackets miss the rank, and where ranked values are cut into slices."""
    for name, value in (("FEW_VALUES", few), ("BAND", band), ("SAMPLE", share)):
        monkeypatch.setattr(quantiles, name, value)
    rng = random.Random(1)
    x = [None if rng.random() < 0.1 else rng.choice([5.0, rng.gauss(0, 1), float(rng.randrange(9))]) for _ in range(3000)]
    y = [rng.randrange(1000) ** 2 for _ in range(2000)]
    qs = [0.0, 0.01, 0.25, 0.5, 0.999, 1.0]
    got = {r["name"]: (r.n, r["values"]) for r in exact_quantiles(frame(spark, x, y), {"x": F.col("x"), "y": F.col("`y.z`"), "no": F.lit(None)}, qs).collect()}
    assert got == {"x": (sum(v is not None for v in x), brute_quantiles(x, qs)), "y": (2000, brute_quantiles(y, qs)), "no": (0, [None] * 6)}


def test_edges_and_counts(spark):
    rng = random.Random(2)
    x = [rng.choice([4.0, float(rng.randrange(100))]) for _ in range(500)]
    edges = equal_depth_edges(frame(spark, x, []), ["x", "y.z"], 5)
    stored = {r.column_name: (r.rows, r.edges) for r in edges.collect()}
    assert stored["y.z"] == (0, []) and stored["x"][0] == 500
    ends = stored["x"][1]
    assert ends == sorted(set(brute_quantiles(x, [0.2, 0.4, 0.6, 0.8, 1.0]))) and ends[-1] == max(x)
    later = [float(rng.randrange(-20, 130)) for _ in range(300)]
    got = [tuple(r) for r in bucket_counts(frame(spark, later, [1, 2]), edges).orderBy("column_name", "bucket").collect()]
    lows, highs = [-math.inf, *ends], [*ends, math.inf]
    want = [("x", k, None if k == 0 else lows[k], None if k == len(ends) else highs[k], sum(lows[k] < v <= highs[k] for v in later)) for k in range(len(ends) + 1)]
    assert got == [*want, ("y.z", 0, None, None, 2)]
    assert sum(r[4] for r in want) == 300
    assert bucket_counts(frame(spark, x, []), edges.limit(0)).collect() == []


def test_stability(spark):
    a = frame(spark, [float(i % 50) for i in range(1000)], [])
    edges = equal_depth_edges(a, ["x"], 5)
    counts = bucket_counts(a, edges)
    same, moved = stability(counts, a, edges).first(), stability(counts, a.selectExpr("x / 3 AS x", "`y.z`"), edges).first()
    assert same.stability_index == pytest.approx(0) and same.reference_rows == 1000
    n = [r.n for r in counts.orderBy("bucket").collect()]
    m = [r.n for r in bucket_counts(a.selectExpr("x / 3 AS x"), edges).orderBy("bucket").collect()]
    p, q = ([(v + 0.5) / (1000 + 0.5 * len(n)) for v in c] for c in (n, m))
    assert moved.stability_index == pytest.approx(sum((b - a) * math.log(b / a) for a, b in zip(p, q))) and moved.stability_index > 0.25
