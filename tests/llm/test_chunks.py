"""Answers to chunks move once; words and chains are handled many at a time with the results of one at a time."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from etlkit.llm import passages
from etlkit.llm.chunks import Chunks
from etlkit.llm.common import BASE, BYTE_CODES, CACHED, LOWER, SPACES, mixed, powers, prefix_hashes, span_hashes, words_of


def test_answers_move_once(spark):
    """They were collected in one shuffle and sent to their chunks in a second one, which doubled the disk and an executor's memory."""
    chunks = Chunks(spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string").repartition(5), "moved")
    numbers = [r.chunk for r in chunks.rows.collect()]
    answers = spark.createDataFrame([(c, f"{c}-{i}".encode()) for c in numbers for i in range(3)], "chunk long, data binary")
    asked = chunks.ask(lambda ids, ends, data, got: {0: b"|".join(sorted(got))}, answers, 1)
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "collect_list" not in plan
    assert {r.chunk: bytes(r.data) for r in asked.collect()} == {c: b"|".join(sorted(f"{c}-{i}".encode() for i in range(3))) for c in numbers}
    some = answers.where(f"chunk = {numbers[0]}")
    route = lambda **how: sorted(r.chunk for r in chunks.route(lambda ids, ends, data, got: {int.from_bytes(got[0], "little"): b""}, some, **how).collect())
    assert route() == [numbers[0]] and route(every=True) == sorted(numbers)


def test_answers_to_one_chunk_go_to_several_tasks(spark):
    """What a task held for a chunk that many others refer to grew with their number."""
    chunks = Chunks(spark.createDataFrame([(i, f"text {i}") for i in range(12)], "doc_id long, text string").repartition(4), "spread")
    numbers = sorted(r.chunk for r in chunks.rows.collect())
    answers = spark.createDataFrame([(c, f"{c}-{i}".encode()) for k, c in enumerate(numbers) for i in range(200 if k == 1 else 2)], "chunk long, data binary")
    for most in (1000, 25):
        sent = chunks.spread(lambda ids, ends, data, got: {int.from_bytes(got[0], "little"): b"|".join(got[1:])}, answers, F.lit(1), most).collect()
        groups = {c: [bytes(r.data).split(b"|") for r in sent if r.chunk == c] for c in numbers}
        assert {c: sorted(x for g in gs for x in g) for c, gs in groups.items()} == {c: sorted(bytes(r.data) for r in answers.where(f"chunk = {c}").collect()) for c in numbers}
        assert [len(groups[c]) for c in numbers] == [1, 1 if most > 200 else 8, *[1] * (len(numbers) - 2)]
        assert max(len(g) for gs in groups.values() for g in gs) <= (200 if most > 200 else 2 * most)


@pytest.mark.parametrize("texts", [["a", "b"], ["", "ab", "", "cd e", " x ", ""], [" "], ["Ab" * CACHED, "c " * CACHED, "d"], [""]])
def test_word_hashes_in_pieces(texts):
    raw = [t.encode() for t in texts]
    data, ends = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    hashes, where, start, end = words_of(data, ends)
    assert [raw[k].lower() and bytes(LOWER[data[a:b]]) for k, a, b in zip(where, start, end)] == [w for t in raw for w in t.lower().split()]
    assert where.tolist() == [k for k, t in enumerate(raw) for _ in t.split()]
    assert (hashes == span_hashes(prefix_hashes(LOWER[data]), start, end)).all()
    assert passages._word_counts(data, ends).tolist() == [len(t.split()) for t in raw]
    powers_of = [mixed(np.array([int(sum(int(BYTE_CODES[b]) * int(powers(BASE, len(w))[i]) for i, b in enumerate(w))) % (1 << 64)], np.uint64))[0] for w in (t for t in raw if 0 < len(t) < 9 and not SPACES[list(t)].any())]
    assert set(powers_of) <= set(hashes)


def test_chains_aligned_at_once():
    rng = random.Random(8)
    words, q, r, one = [], [], [], []
    for _ in range(400):
        n, few = rng.randrange(1, 160), rng.choice([2, 9, 5000])
        a = [rng.randrange(2, 2 + few) for _ in range(n)]
        b = [rng.randrange(2, 2 + few) if rng.random() < 0.15 else w for w in a if rng.random() > 0.05] + [rng.randrange(2, 2 + few) for _ in range(rng.randrange(40))]
        q0, r0 = rng.randrange(n), rng.randrange(len(b) + 1)
        q1, r1 = rng.randrange(q0, n + 1), rng.randrange(r0, len(b) + 1)
        if rng.random() < 0.6:  # on the diagonal
            r0, r1 = min(q0, len(b)), min(q1, len(b))
        one.append((span := passages.aligned(np.array(a, np.uint64), q0, q1, np.array(b, np.uint64), r0, r1)) and (span[0] + len(words), span[1] + len(words)))
        q.append((len(words), len(words) + q0, len(words) + q1, len(words) + n))
        words += a
        r.append((len(words), len(words) + r0, len(words) + r1, len(words) + len(b)))
        words += b
    words = np.array(words, np.uint64)
    assert passages.aligned_all(words, np.array(q), np.array(r)) == one and 40 < sum(x is not None for x in one) < 360
    assert passages._aligned(words, q, r) == one and passages._aligned(words, q[:9], r[:9]) == one[:9]
