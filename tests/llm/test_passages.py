"""Chains against brute force, and planted passages."""

import random

import numpy as np

from etlkit.llm import passages
from etlkit.llm.passages import GAP_COST, SEED_WORDS, chain, remove_repeated_passages
from etlkit.llm.suffix_dedup import _raw, _read


def test_best_chain_against_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        pairs = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(rng.randrange(1, 25))})
        q, r = [p[0] for p in pairs], [p[1] for p in pairs]
        best = [SEED_WORDS] * len(q)
        for i in range(len(q)):
            for j in range(i):
                if q[j] < q[i] and r[j] < r[i]:
                    best[i] = max(best[i], best[j] + SEED_WORDS - GAP_COST * (q[i] - q[j] + r[i] - r[j]))
        found = chain(q, r)
        top = found[0]
        score = SEED_WORDS * len(top) - GAP_COST * sum(q[b] - q[a] + r[b] - r[a] for a, b in zip(top, top[1:]))
        assert abs(score - max(best)) < 1e-9
        assert sorted(m for c in found for m in c) == list(range(len(q)))


def test_planted_passages(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    fresh = lambda n: [word() for _ in range(n)]
    passage = fresh(70)
    edited = [word() if i in (18, 40, 58) else w for i, w in enumerate(passage)]
    short = fresh(30)
    docs = {10: fresh(40) + passage + fresh(40), 11: fresh(35) + edited + fresh(9), 12: fresh(30) + passage + short, 13: short + fresh(100),
            14: fresh(200), 20: fresh(20) + passage[:60], 15: fresh(20), 5: fresh(30)}
    docs[30] = docs[14]
    docs[31] = [w.upper() for w in passage]
    rows = [(i, " ".join(w), "x") for i, w in docs.items()] + [(40, None, "x"), (41, "", "x"), (42, "one", "x"), (None, " ".join(passage), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk string").repartition(7)
    got = {r.doc_id: r for r in remove_repeated_passages(df).collect()}
    assert {i: r.n_removed for i, r in got.items() if r.n_removed} == {11: 70, 12: 70, 20: 60, 30: 200, 31: 70, None: 70}
    assert [tuple(s) for s in got[12].spans] == [(30, 99, 10)]
    assert bytes(got[12].text).decode().split() == docs[12][:30] + short
    assert got[13].n_words == 130 and got[40].n_words == 0
    assert remove_repeated_passages(df.limit(0)).collect() == []


def test_hot_passage(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    passage = " ".join(word() for _ in range(55))
    df = spark.createDataFrame([(i, f"{word()} {passage} {word()}") for i in range(400)], "doc_id long, text string").repartition(9)
    got = remove_repeated_passages(df).collect()
    assert sorted(r.n_removed for r in got) == [0] + [55] * 399


def test_random_edits(spark):
    """Passages just above the least length, with words replaced anywhere but at the first and last place."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    fresh = lambda n: [word() for _ in range(n)]
    kinds = [(50, 0.05), (60, 0.1), (60, 0.15), (80, 0.15)]
    rows = []
    for kind, (n, share) in enumerate(kinds):
        for k in range(50):
            passage = fresh(n)
            changed = set(rng.sample(range(1, n - 1), int(share * n)))
            rows.append((1000 * kind + k, " ".join(fresh(40) + passage + fresh(40))))
            rows.append((10_000 + 1000 * kind + k, " ".join(fresh(40) + [word() if i in changed else w for i, w in enumerate(passage)] + fresh(40))))
    got = remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert all(r.n_removed == 0 for r in got if r.doc_id < 10_000)
    found = [sum(r.n_removed >= 50 for r in got if r.doc_id // 1000 == 10 + kind) for kind in range(len(kinds))]
    print("found", found)
    assert min(found) >= 45, found


def test_passages_hidden_behind_other_places(spark):
    """Three documents share a passage whose runs of five words each stand in some other, earlier document too."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    fresh = lambda n: [word() for _ in range(n)]
    rows, passage = [], fresh(80)
    edited = [word() if i % 16 == 8 else w for i, w in enumerate(passage)]
    for i in range(76):
        rows.append((i, " ".join(fresh(15) + passage[i:i + 5] + fresh(15))))
    for i, p in ((1000, passage), (2000, passage), (3000, passage), (4000, edited)):
        rows.append((i, " ".join(fresh(30) + p + fresh(30))))
    for n in (1, 6):  # in one chunk and in several
        got = remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()
        assert {r.doc_id: r.n_removed for r in got if r.n_removed} == {2000: 80, 3000: 80, 4000: 80}


def test_exact_passages_against_brute_force(spark):
    """Small vocabularies, so that seeds recur by chance: every run of 50 words that an earlier document holds goes."""
    rng = random.Random(7)
    docs = {}
    for i in range(60):
        words = [rng.choice("abc") for _ in range(rng.randrange(20, 200))]
        if i > 5 and i % 2:
            other = docs[rng.randrange(i)]
            at = rng.randrange(len(other))
            words[10:10] = other[at:at + rng.randrange(50, 90)]
        docs[i] = words
    got = {r.doc_id: r for r in remove_repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string").repartition(5)).collect()}
    seen: set[tuple] = set()
    planted = 0
    for i, words in docs.items():
        gone = {j for s in got[i].spans for j in range(s.first, s.last + 1)}
        for j in range(len(words) - 49):
            if tuple(words[j:j + 50]) in seen:
                planted += 1
                assert set(range(j, j + 50)) <= gone, (i, j)
        seen.update(tuple(words[j:j + 50]) for j in range(len(words) - 49))
        assert bytes(got[i].text).decode().split() == [w for j, w in enumerate(words) if j not in gone]
    assert planted > 100


def test_rows_that_share_an_id(spark):
    """They do not repeat one another, whichever of them a later document repeats."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    fresh = lambda n: " ".join(word() for _ in range(n))
    passage = fresh(60)
    rows = [(1, "short one"), (1, f"{fresh(70)} {passage}"), (1, passage), (2, f"{fresh(5)} {passage}"), (None, passage), (None, passage)]
    for n in (1, 4):
        got = remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()
        assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 60), (0, 60), (1, 0), (1, 0), (1, 0), (2, 60)]


def test_words_of_a_popular_text_are_sent_once(spark, monkeypatch):
    """Each chain had the words around it sent by themselves, so what a chunk of many first places sent grew with the corpus in one task."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    fresh = lambda n: [word() for _ in range(n)]
    first, sent, real = fresh(400), [], passages._responses
    monkeypatch.setattr(passages, "_responses", lambda *args: sent.append(real(*args)) or sent[-1])
    later = [(i, " ".join(fresh(5) + first[5 * i:5 * i + 60] + fresh(5))) for i in range(1, 61)]
    chunked = lambda *parts: spark.createDataFrame(spark.sparkContext.union([spark.sparkContext.parallelize(p, 1) for p in parts]), "doc_id long, text string")
    got = remove_repeated_passages(chunked([(0, " ".join(first))], later)).collect()
    assert sorted(r.n_removed for r in got) == [0] + [60] * 60
    assert 8 * 300 < sum(len(r.data) for r in sent[0].collect()) <= 8 * len(first) + 100

    monkeypatch.setattr(passages, "WORDS", 1000)  # and chunks that ask for more than that are dealt out to several tasks
    got = remove_repeated_passages(chunked([(0, " ".join(first))], *[[row] for row in later[:30]])).collect()
    assert sorted(r.n_removed for r in got) == [0] + [60] * 30
    assert len(sent[1].collect()) == 30 and "turn" in sent[1]._jdf.queryExecution().toString()


def test_first_places_range_after_range(monkeypatch):
    """A group of hashes is settled in ranges, so that what lies between does not grow with the share of runs that recur."""
    rng = np.random.default_rng(3)
    numbers = np.array([5, 2, 9, 7])
    rows = []
    for n in (900, 0, 1500, 300):
        run = np.unique(rng.integers(1 << 40, (1 << 40) + 2000, n).astype(np.uint64) << np.uint64(20))
        rows.append((run, rng.integers(0, 50, len(run)), rng.integers(0, 1 << 33, len(run))))
    best = {}
    for number, r in zip(numbers.tolist(), rows):
        for run, doc, spot in zip(*(x.tolist() for x in r)):
            best[run] = min(best.get(run, (1 << 60,)), (doc, number, spot))
    expected = sorted((number, run, best[run][0], best[run][2], best[run][1]) for number, r in zip(numbers.tolist(), rows)
                      for run, doc, _ in zip(*(x.tolist() for x in r)) if best[run][0] < doc)
    for most, several in ((1 << 20, False), (200, True)):
        monkeypatch.setattr(passages, "AT_ONCE", most)
        found = [(int(numbers[i]), data) for i, data in passages._places([_raw(*r) for r in rows], numbers)]
        assert (len(found) > len(rows)) == several
        assert sorted((k, *x) for k, data in found for x in zip(*(y.tolist() for y in _read(data, np.uint64, np.int64, np.int64, np.int64)))) == expected
    assert list(passages._places([_raw(*rows[1])], numbers[1:2])) == []
