"""Sharding, quality and packing: laws, odd inputs, held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

from etlkit.llm.packing import CAPACITY, Encoder, best_fit, crossover, evolve, pack
from etlkit.llm.quality import isotonic, score_quality
from etlkit.llm.queries import QUERIES
from etlkit.llm.sharding import find_cuts, shard_by_bytes

FOLDER = "/root/testdata/sf0.01"


def check_shards(docs, got, shards):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    for s in range(shards):
        mine = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - total / shards) <= 2 * largest + 0.01 * total / shards
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_shards_of_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    check_shards(docs, QUERIES["op6_histogram_sharding"](spark, FOLDER).collect(), 40)


def test_a_group_of_equal_texts_spreads(spark, monkeypatch):
    docs = [(i, "same" * 20) for i in range(300)] + [(1000 + i, "x" * (i % 50)) for i in range(400)] + [(None, None), (None, "y"), (5, "same" * 20)]
    df = spark.createDataFrame([(i, t, 3) for i, t in docs], "doc_id long, text string, shard int").repartition(4)
    check_shards(docs, shard_by_bytes(df, 7).collect(), 7)
    monkeypatch.setattr("etlkit.llm.sharding.SLICE_BYTES", 2000)
    check_shards(docs, shard_by_bytes(df, 7).collect(), 7)
    assert shard_by_bytes(df.limit(0)).collect() == []
    assert find_cuts(spark.createDataFrame([], "doc_id long, size long, text_crc32 long"), 4) == []


def test_quality_of_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op3_quality_classifier"](spark, FOLDER).collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()]
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(q, got[i].predicted) for i, q in labels if got[i].held_out]
    assert sum(q == p for q, p in held) >= 0.95 * len(held)


def test_quality_without_labels_and_odd_texts(spark):
    docs = spark.createDataFrame([(1, None, 0.0), (2, "", 0.0), (3, "a b c", 0.0), (3, "!!!", 0.0), (None, "x\n" * 50000, 0.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([(1, None, 1), (9, 1, 1), (2, 7, 1)], "doc_id long, quality int, toxic int")
    assert {r.score for r in score_quality(docs, none).collect()} == {0.5}
    assert score_quality(docs.limit(0), none).collect() == []
    one = spark.createDataFrame([(i, 1) for i in (1, 2, 3)], "doc_id long, quality int")
    assert {r.score for r in score_quality(docs, one).collect()} == {1.0}


def test_isotonic_steps():
    assert isotonic(np.array([1, 0, 1, 2, 1]), np.array([0, 0, 1, 0, 1])).tolist() == pytest.approx([0, 1 / 6, 1 / 3, 1 / 3, 1])


def path():
    public = pytest.importorskip("public_tokenizers")
    return public.path("word_bpe_49k.json")


def check_packing(docs, got):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path())
    want = []
    for i, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for p in range(0, len(ids), CAPACITY):
            part = ids[p:p + CAPACITY]
            want.append((str(i), p // CAPACITY, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    fill = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= CAPACITY
    return len(fill), -(-sum(fill.values()) // CAPACITY)


def test_packing_of_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    used, least = check_packing(docs, QUERIES["op10_best_fit_packing"](spark, FOLDER).collect())
    assert used <= least + 1


def test_packing_over_several_problems(spark, monkeypatch):
    monkeypatch.setattr("etlkit.llm.packing.ISLAND_TOKENS", 60_000)
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").limit(400).collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    used, least = check_packing(docs, pack(df).collect())
    assert used <= 1.03 * least + 1


def test_odd_texts_pack(spark):
    docs = [(1, None), (2, ""), (3, "  \n"), (3, "a b ☃ c <|endoftext|> d e"), (None, "word " * 9000), (4, "Été é it's 12ab\x1cq"), (5, "☃☃")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, piece int")
    check_packing(docs, pack(df).collect())
    assert pack(df.limit(0)).collect() == []


def test_crossover_keeps_every_item_once():
    import random
    rng = random.Random(5)
    lengths = [rng.randrange(1, CAPACITY) for _ in range(200)]
    parents = []
    for k in range(2):
        bins, order = [], list(range(200))
        rng.shuffle(order)
        best_fit(order[:100 * k], lengths, bins, [])
        best_fit(order[100 * k:], lengths, bins, [CAPACITY - sum(lengths[i] for i in b) for b in bins])
        parents.append(bins)
    for packing in (crossover(*parents, lengths, rng), evolve(lengths, [], 1)):
        assert sorted(i for b in packing for i in b) == list(range(200))
        assert all(sum(lengths[i] for i in b) <= CAPACITY for b in packing)


def test_cache_can_be_cleared(monkeypatch):
    monkeypatch.setattr("etlkit.llm.packing.CACHE", 5)
    encode = Encoder(path())
    texts = ["one two three", "four five six seven", "one eight"]
    for t in texts:
        assert encode([t])[0].tolist() == encode.tokenizer.encode(t, add_special_tokens=False).ids + [1]


def test_odd_texts_encode_as_the_tokenizer_does():
    rng = random.Random(3)
    odd = [*"aAéÉößẞİıÿÝ×÷µªº'’s<|>☃ \t\n\x0b\x85.,!?*$&#%1½٣́ńŃж日🙂\x00\xad", "<|endoftext|>", "'s", "'T", "K", "ﬁ", "Straße", "x" * 80]
    texts = ["", " ", *("".join(rng.choices(odd, k=rng.randrange(14))) for _ in range(3000))]
    encode = Encoder(path())
    for part in (texts[:1000], texts[1000:], texts):  # the last time from memory
        expected = encode.tokenizer.encode_batch(part, add_special_tokens=False)
        assert [x.tolist() for x in encode(part)] == [e.ids + [1] for e in expected]
    assert not any(len(p) > 64 for p in encode.known | encode.before)


def test_pieces_asked_for_are_not_forgotten(monkeypatch):
    monkeypatch.setattr("etlkit.llm.packing.CACHE", 40)
    encode = Encoder(path())
    for i in range(30):
        encode([f"common word{i} other{i}x"])
        assert "common" in encode.known or "common" in encode.before
        assert len(encode.known) + len(encode.before) <= 50
