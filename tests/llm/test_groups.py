"""N-gram join and vector join against brute force."""

import re

import numpy as np
import pyarrow as pa
import pytest

from etlkit.llm import common, vector_join
from etlkit.llm.common import linked_groups, released, staged, stars
from etlkit.llm.ngram_join import boundary, near_groups, parities
from etlkit.llm.queries import QUERIES
from etlkit.llm.vector_join import compare, link_vectors

FOLDER = "/root/testdata/sf0.01"


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_groups(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    at = {}
    links = []
    for k, (i, s) in enumerate(sets):
        shared = {}
        for x in s:
            for j in at.get(x, ()):
                shared[j] = shared.get(j, 0) + 1
            at.setdefault(x, []).append(k)
        links += [(i, sets[j][0]) for j, n in shared.items() if 100 * n >= 80 * (len(s) + len(sets[j][1]) - n)]
    found = components([i for i, _ in sets], links)
    return sorted((i, len(s), found[i]) for i, s in sets)


def test_documents_against_brute_force(spark, rows):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    want = brute_groups([tuple(r) for r in docs.collect()])
    assert len({c for _, _, c in want}) < len(want)
    assert rows(QUERIES["op9_ngram_jaccard_join"](spark, FOLDER), "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)


def test_odd_texts(spark, rows):
    rng = np.random.default_rng(0)
    base = [f"w{i}" for i in range(40)]
    docs = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "One two", 0), (5, "one  TWO", 0), (6, "one two three", 0), (7, "a b c d e f g h i", 0),
            (8, "a b c d e f g h", 0), (9, "a b c d e f g h i", 0), (10, "é È", 0), (11, "é è", 0), (12, " ".join(base) * 300, 0)]
    docs += [(100 + k, " ".join(base[:k] + ["x"] + base[k:]), 0) for k in range(0, 41, 2)]
    docs += [(200 + k, " ".join(base[:38 - k]), 0) for k in range(0, 30, 3)]
    docs += [(300 + k, " ".join(rng.choice(base, 9)), 0) for k in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string, node long").repartition(5)
    assert rows(near_groups(df), "doc_id", "n_shingles", "component_id") == sorted(brute_groups([d[:2] for d in docs]), key=repr)
    assert near_groups(df.limit(0)).collect() == []


def test_words_that_one_hash_confuses_are_different(spark, rows):
    """A Thue-Morse word of 1,024 letters and its complement agree in every polynomial hash modulo 2**64."""
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    df = spark.createDataFrame([(1, one), (2, other), (3, f"{one} x y z w v u"), (4, f"{other} x y z w v u")], "doc_id long, text string")
    assert rows(near_groups(df), "doc_id", "component_id") == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_links_through_rows_without_id(spark, rows):
    base = [f"w{i}" for i in range(100)]
    middle = base + ["q1", "q2"]
    df = spark.createDataFrame([(1, " ".join(base[7:] + ["q1", "q2"])), (2, " ".join(base[:-6])), (None, " ".join(middle[:-1])), (None, " ".join(middle)), (5, "alone")], "doc_id long, text string")
    want = brute_groups([(i, t) for i, t in [(1, " ".join(base[7:] + ["q1", "q2"])), (2, " ".join(base[:-6])), (98, " ".join(middle[:-1])), (99, " ".join(middle)), (5, "alone")]])
    got = rows(near_groups(df), "doc_id", "component_id")
    assert {w[2] for w in want if w[0] in (1, 2)} == {1}
    assert got == sorted([(1, 1), (2, 1), (None, 1), (None, 1), (5, 5)], key=repr)


def test_bits_tell_sets_apart_that_share_a_half():
    """Sets of 600 elements: with 540 in common (Jaccard 0.82) they may be similar, with 450 or 400 (0.6 and 0.5) they are not."""
    rng = np.random.default_rng(4)
    apart = {}
    for shared in (540, 450, 400):
        sets = [rng.integers(0, 1 << 63, 1200 - shared, dtype=np.uint64) for _ in range(50)]
        values = np.concatenate([np.concatenate([x[:600], x[-600:]]) for x in sets])
        bits = parities(values, np.arange(0, 60_001, 600))
        apart[shared] = [np.bitwise_count((a ^ b).view(np.uint64)).sum() for a, b in zip(bits[::2], bits[1::2])]
    most = (600 + 600) * 20 // 180  # elements that may differ
    assert max(apart[540]) <= most
    assert min(apart[450]) > most and min(apart[400]) > most
    assert parities(values[:0], np.zeros(1, np.int64)).shape == (0, bits.shape[1])


def test_boundary_follows_cost():
    assert boundary({10: 1000, 500: 1000}, 0.0) < 10
    assert boundary({10: 1000, 500: 1000}, 1e6) >= 10


def test_long_chain_is_one_component(spark, rows):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    assert rows(linked_groups(links, "chain")) == sorted([(i, 0) for i in range(61)] + [(100, 100), (101, 100)], key=repr)
    assert linked_groups(links.limit(0), "none").collect() == []


def test_links_that_fit_one_task_take_no_rounds(spark, rows, monkeypatch):
    pairs = np.random.default_rng(3).integers(0, 3000, (2000, 2))
    links = spark.createDataFrame([*map(tuple, pairs.tolist()), *((i, i + 1) for i in range(5000, 9000))], "a long, b long")
    written = []
    monkeypatch.setattr(common, "staged", lambda df, name: written.append(name) or staged(df, name))
    groups = linked_groups(links, "few")
    assert written == ["few-links"]
    found = components({n for p in pairs.tolist() for n in p if p[0] != p[1]} | set(range(5000, 9001)), pairs.tolist() + [(i, i + 1) for i in range(5000, 9000)])
    assert rows(groups) == sorted(found.items(), key=repr)


def test_links_over_many_tasks(spark, rows):
    """Chains, a star, and names as nodes, in tasks that hold a few links each."""
    rng = np.random.default_rng(4)
    order = rng.permutation(400).tolist()
    links = list(zip(order[:250], order[1:251])) + [(order[260], x) for x in order[261:]] + [(7000, 7001)]
    keys = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name in (lambda n: n, lambda n: f"n{n}é"):
        given = [(name(a), name(b)) for a, b in links]
        ids = sorted({x for p in given for x in p})
        df = spark.createDataFrame(given, ["a", "b"])
        before = {k: spark.conf.get(k) for k in keys}
        try:
            for k, v in keys.items():
                spark.conf.set(k, v)
            assert rows(linked_groups(df, "many")) == sorted(components(ids, given).items(), key=repr)
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)


def test_stars_of_a_task():
    rng = np.random.default_rng(5)
    for n, many in ((0, 5), (1, 5), (40, 60), (5000, 4000)):
        u, v = np.sort(rng.integers(-many, many, (n, 2)))[:, ::-1].T
        a, b = stars(pa.array(u), pa.array(v))
        want = components(set(u.tolist()) | set(v.tolist()), zip(u.tolist(), v.tolist()))
        assert sorted(zip(a.to_pylist(), b.to_pylist())) == sorted((x, y) for x, y in want.items() if x != y)


def test_freed_memory_goes_back(spark):
    """What the driver's threads have freed does not stay in its allocator."""
    jvm = spark.sparkContext._jvm
    pid = int(jvm.java.lang.ProcessHandle.current().pid())

    def resident():
        with open(f"/proc/{pid}/smaps_rollup") as f:
            return int(re.search(r"Rss:\s+(\d+)", f.read())[1]) >> 10
    field = jvm.java.lang.Class.forName("sun.misc.Unsafe").getDeclaredField("theUnsafe")
    field.setAccessible(True)
    unsafe = field.get(None)
    released(spark)
    places = [unsafe.allocateMemory(60_000) for _ in range(3000)]
    for at in places:
        unsafe.setMemory(at, 60_000, 1)
    full = resident()
    for at in places[:-1]:  # the last one keeps the allocator from shrinking by itself
        unsafe.freeMemory(at)
    released(spark)
    left = resident()
    unsafe.freeMemory(places[-1])
    assert full - left > 100


def brute_vectors(found):
    ok = [(i, np.array(v, float) / max(map(abs, v))) for i, v in found if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = [(a, b) for n, (a, x) in enumerate(ok) for b, y in ok[:n] if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9]
    groups = components([i for i, _ in found], links)
    return {i: (sum(i in l for l in links), groups[i]) for i, _ in found}


def test_vectors_against_brute_force(spark, tmp_path):
    """The given vectors, with copies and turned copies of every third one added."""
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rng, found = np.random.default_rng(2), [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    for n, (_, v) in enumerate(found[:300:3]):
        v = np.array(v)
        for k in range(n % 3 + 1):
            turned = v if k == 2 else v + rng.normal(size=len(v)) * np.linalg.norm(v) * 0.4 / np.sqrt(len(v))
            found.append((100_000 + 10 * n + k, np.float32(turned).tolist()))
    spark.createDataFrame(found, df.select("vec_id", "embedding").schema).write.parquet(str(tmp_path / "embeddings.parquet"))
    want = brute_vectors(found)
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op1_embedding_near_dedup"](spark, str(tmp_path)).collect()}
    assert any(n for n, _ in want.values())
    assert got == want


def test_recall_over_many_cells(spark):
    """Planted pairs with cosines from 0.9 to 0.95, far more pivots than one."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    c = rng.uniform(0.902, 0.95, (len(x), 1))
    data = np.vstack([x, c * x + np.sqrt(1 - c ** 2) * y])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in link_vectors(df).collect()}
    assert sum(got[i].component_id == got[i + 6000].component_id for i in range(6000)) >= 0.9 * 6000


@pytest.mark.parametrize("block", [16384, 300])
def test_no_link_of_a_hot_group_is_lost(spark, monkeypatch, block):
    """A third of the rows are mutually near but different; the others are small groups and lone vectors."""
    monkeypatch.setattr(vector_join, "BLOCK", block)
    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    near = lambda centre, n, c: c * centre + np.sqrt(1 - c * c) * unit(rng.normal(size=(n, 64)))
    data = np.vstack([near(unit(rng.normal(size=(1, 64))), 2500, 0.955), *[near(unit(rng.normal(size=(1, 64))), 20, 0.95) for _ in range(100)], unit(rng.normal(size=(3000, 64)))])
    data = unit(data.astype(np.float32).astype(float))
    want = (data @ data.T >= 0.9).sum(1) - 1
    assert want[:2500].mean() > 1000
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in link_vectors(df).collect()}
    assert [got[i] for i in range(len(data))] == want.tolist()


def test_odd_vectors(spark):
    data = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]),
            (9, [1.0, 0.0]), (10, [1.0, 0.45]), (11, [0.0, 1.0]), (12, [1.0, 0.0, 0.0]), (13, [1.0, 0.0, 0.01]),
            (14, [1e200, 1e200]), (15, [2e200, 2e200]), (16, [3e-200, 3e-200]), (17, [1e-320, 0.0]), (18, [float("nan"), None]), (19, [None, float("nan")])]
    df = spark.createDataFrame([(i, v, "x") for i, v in data], "vec_id long, embedding array<double>, cells string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in link_vectors(df).collect()}
    assert got == brute_vectors(data)
    assert link_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_bounds_lose_no_pair(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(300, 24)) + rng.normal(size=24) * 2
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = compare(x, x)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(list, np.nonzero(np.einsum("ik,jk->ij", x, x) >= 0.9))))
