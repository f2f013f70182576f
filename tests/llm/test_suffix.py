"""Removal of repeated byte strings against brute force."""

import hashlib
import random
import sys

import numpy as np
import pytest

from etlkit.llm.common import BASE, BYTE_CODES, CACHED, powers, prefix_hashes, span_hashes, window_hashes
from etlkit.llm.queries import QUERIES
from etlkit.llm.suffix_dedup import REACH, SEED, least_places, remove_repeated_strings

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def brute(docs):
    texts = [(i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, t in texts:
        for s in range(len(t) - 49):
            w = t[s:s + 50]
            if i < first.get(w, 1 << 63):
                first[w] = i
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - 49):
            if first[t[s:s + 50]] < i:
                gone[s:s + 50] = b"\1" * 50
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def test_documents_against_brute_force(spark, rows):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    assert sum(w[2] for w in want)
    assert rows(QUERIES["op8_suffix_array_dedup"](spark, folder), *COLUMNS) == want


def test_odd_texts(spark, rows):
    rng = random.Random(1)
    line = "".join(rng.choice("abcdefgh ") for _ in range(77))
    docs = [(5, None), (6, ""), (7, "x" * 49), (8, "x" * 50), (9, "x" * 51), (10, "x" * 300), (3, "ab" * 60), (4, "ba" * 60), (2, line), (1, "é" * 30), (11, "é" * 31)]
    docs += [(100 + k, "".join(rng.choice("abc") for _ in range(k % 9)) + line[k % 5:60 + k % 18] + "".join(rng.choice("abc") for _ in range(k % 7))) for k in range(60)]
    docs += [(300 + k, line * (1 + k)) for k in range(4)] + [(2, line), (3, "ab" * 60)]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, chunk int").repartition(6)
    assert rows(remove_repeated_strings(df), *COLUMNS) == brute(docs)
    assert remove_repeated_strings(df.limit(0)).collect() == []


@pytest.mark.parametrize("n", [0, 23, 24, 50, 51, 3 * CACHED + 60])
def test_pieces_of_a_chunk_give_what_the_whole_gives(n):
    data = np.random.default_rng(n).integers(97, 99, n).astype(np.uint8)
    prefix = prefix_hashes(data)
    want = [0]
    for b, p in zip(BYTE_CODES[data].tolist(), powers(BASE, n).tolist()):
        want.append((want[-1] + b * p) % 2 ** 64)
    assert prefix.tolist() == want
    seeds, at = window_hashes(prefix, SEED), np.arange(max(0, n - SEED + 1))
    assert seeds.tolist() == span_hashes(prefix, at, at + SEED).tolist()
    high = (seeds >> np.uint64(16)).tolist()
    assert least_places(seeds).tolist() == [min(range(i, i + REACH), key=lambda j: (high[j], j)) for i in range(len(high) - REACH + 1)]


def test_powers_of_nothing_in_a_new_worker(monkeypatch):
    monkeypatch.delitem(sys.modules, "_etlkit_powers", raising=False)
    assert len(powers(BASE, 0)) == 0
