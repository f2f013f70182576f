"""Periodic runs against brute force, by documents and by whole queries."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from etlkit.llm.queries import QUERIES
from etlkit.llm.runs import collapse_runs, common_prefixes, may_repeat, runs_of_words, suffix_order

FOLDER = "/root/testdata/sf0.01"


def smallest_period(x):
    border, k = [0] * len(x), 0
    for i in range(1, len(x)):
        while k and x[i] != x[k]:
            k = border[k - 1]
        k += x[i] == x[k]
        border[i] = k
    return len(x) - border[-1]


def brute_runs(x, least=12):
    """Every period by itself: stretches whose words recur so much later, kept if no smaller period explains them."""
    out, n = [], len(x)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and smallest_period(x[i:j + q]) == q:
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def cases():
    rng = random.Random(6)
    yield []
    yield [1]
    yield [7] * 400
    yield [1, 2] * 90 + [1]
    for n in (11, 12, 13, 25, 26, 60, 200, 400):
        for letters in (2, 3, 5):
            yield [rng.randrange(letters) for _ in range(n)]
    for _ in range(60):
        x = []
        for _ in range(rng.randrange(1, 7)):
            part = [rng.randrange(rng.choice((2, 3, 60))) for _ in range(rng.randrange(1, 25))]
            x += part * rng.randrange(1, 6) + part[:rng.randrange(len(part))]
        yield x
    a, b = [1], [1, 2]
    while len(b) < 500:  # Fibonacci words have as many runs as there can be
        a, b = b, b + a
    yield b
    phrase = list(range(100, 108))
    yield [w for k in range(150) for w in (*phrase, 1000 + k)]  # one phrase after many different words
    yield [w for k in range(60) for w in ([5] * (7 + k % 4) + [200 + k])]


@pytest.mark.parametrize("least", [12, 2, 5])
def test_runs_against_brute_force(least):
    for x in cases():
        ids = np.array(x, np.int64)
        want = brute_runs(x, least)
        assert runs_of_words(ids, least) == want, x
        flagged = may_repeat(ids, np.zeros(len(ids), np.int64), least).tolist()
        assert not want or flagged == [0]


def test_suffixes_and_prefixes():
    for x in cases():
        ids = np.array(x, np.int64)
        if not len(ids):
            continue
        order, rank = suffix_order(ids)
        assert order.tolist() == sorted(range(len(x)), key=lambda i: x[i:])
        lcp = common_prefixes(ids, order, rank).tolist()
        for k in range(1, len(x)):
            a, b = x[order[k - 1]:], x[order[k]:]
            assert a[:lcp[k]] == b[:lcp[k]] and a[:lcp[k] + 1] != b[:lcp[k] + 1]


def test_a_long_document_of_one_word_takes_time_in_proportion():
    assert runs_of_words(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]
    x = np.tile(np.arange(2000), 30)
    assert runs_of_words(x) == [(0, 60_000, 2000)]


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def brute(docs):
    out = []
    for doc_id, text in docs:
        words = planted(doc_id, text)
        runs = brute_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        out.append((doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                    sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone))))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_documents_against_brute_force(spark, rows):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    docs = [(i, t) for i, t in docs if len(t or "") < 12_000]
    want = brute(docs)
    got = {r[0]: r for r in rows(QUERIES["op12_periodic_runs"](spark, folder), *COLUMNS)}
    assert sum(w[1] for w in want) > 10
    assert [got[w[0]] for w in want] == want


def test_odd_texts(spark, rows, tmp_path):
    rng = random.Random(2)
    words = lambda n, m: " ".join(rng.choice(["é", "b b", "C", "c", "　"][:m]) for _ in range(n))
    docs = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a " * 30), (5, "a\tb\n" * 6), (5, "a\tb\n" * 6), (None, "x y " * 9), (7, "ab " * 11), (8, "A a " * 5 + "a A"), (-9, "q " * 40)]
    docs += [(i, words(rng.randrange(90), rng.randrange(1, 6))) for i in range(100, 260)]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id long, text string, runs int, start string").repartition(4)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert rows(QUERIES["op12_periodic_runs"](spark, str(tmp_path)), *COLUMNS) == brute(docs)
    assert collapse_runs(df.limit(0)).collect() == []


def test_collapsed_texts(spark, rows):
    df = spark.createDataFrame([(1, " one  two three " * 5 + "end"), (2, "a  b"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.text) for r in collapse_runs(df).collect()}
    assert got == {1: (16, [(0, 15, 3)], "one two three end"), 2: (2, [], "a b"), 3: (0, [], "")}
