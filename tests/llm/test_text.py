"""Language, lines, leaks and the pipeline."""

import random

import numpy as np
import pytest
from pyspark import cloudpickle

import corpus_pipeline
from etlkit.llm import decontaminate
from etlkit.llm.common import BASE, BASE_INVERSE, powers, table, words_of
from etlkit.llm import decontaminate
from etlkit.llm.decontaminate import Regions, _bits, _may_leak, _sums, common_lengths, find_leaks, item_signs, longest_common, verdicts, word_bits
from etlkit.llm.language import identify_documents, identify_pages, train
from etlkit.llm.line_dedup import drop_repeated_lines
from etlkit.llm.queries import QUERIES, SQL
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), SQL[name]) == []


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute_lines(docs):
    lines = [(i, k, line) for i, t in docs if t is not None for k, line in enumerate(t.split("\n"))]
    lines.sort(key=lambda x: x[:2])
    gone = set()
    for n, (i, k, line) in enumerate(lines):
        if line.strip(" ") and any(other == line or min(len(line), len(other)) >= 16 and abs(len(line) - len(other)) < 2 and edits(line, other) <= 1 for _, _, other in lines[:n]):
            gone.add((i, k))
    return gone


def test_lines_against_brute_force(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    pool = [word(n) for n in (3, 15, 16, 17, 30, 39, 40, 41, 42, 60, 61, 90)]

    def edit(s):
        k = rng.randrange(len(s) + 1)
        return rng.choice([s, s[:k] + rng.choice("xyz") + s[k:], s[:k] + s[k + 1:], s[:k] + "q" + s[k + 1:], edit_twice(s)])

    def edit_twice(s):
        return "zz" + s[2:]

    docs = [(i, "\n".join(edit(rng.choice(pool)) for _ in range(rng.randrange(6)))) for i in range(60)]
    half = word(50)  # many lines with one half in common, most of them one edit apart
    docs += [(100 + i, half + "".join("ab"[i >> k & 1] for k in range(6)) + "c" * 44) for i in range(50)] + [(200, None), (201, ""), (202, "\n \n")]
    df = spark.createDataFrame([(i, t, "k") for i, t in docs], "doc_id long, text string, key string").repartition(5)
    gone = brute_lines(docs)
    got = {r.doc_id: r for r in drop_repeated_lines(df).collect()}
    assert {i: r.n_removed for i, r in got.items() if r.n_removed} == {i: sum(g[0] == i for g in gone) for i, _ in gone}
    for i, t in docs:
        assert got[i].text == (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)) and got[i].key == "k"
    assert drop_repeated_lines(df.limit(0)).collect() == []


def test_rows_of_one_id_are_told_apart(spark):
    """A unique line stays, whatever another row of its id, or another row without one, holds at its place."""
    known, near = "the line that all of them may know", "the line that all of them may knov"
    data = [(1, known), (7, near), (7, "a line that nobody else has anywhere"), (None, known), (None, "another line that nobody has but this"), (None, "x\n" + known), (None, "x")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id if r.doc_id is not None else 99, r.text) for r in drop_repeated_lines(df).collect())
    assert got == [(1, known), (7, ""), (7, data[2][1]), (99, ""), (99, ""), (99, data[4][1]), (99, "x")]


def test_languages(spark):
    docs = table(spark, FOLDER, "documents")
    languages, model = train(docs)
    want = {r.doc_id: r.lang for r in docs.collect()}
    got = identify_documents(docs, languages, model).collect()
    assert sum(r.lang == want[r.doc_id] for r in got) >= 0.99 * len(want)
    odd = spark.createDataFrame([(1, None, None, "x"), (2, "", "s", "x"), (3, "12 + 34", "s", "x"), (None, "the and of with this" * 3000, None, "x"), (5, "the", "s", "x")],
                                "doc_id long, text string, source string, n string")
    assert {(r.doc_id, r.kept, r.lang) for r in identify_documents(odd, languages, model).collect()} == {
        (1, False, "und"), (2, False, "und"), (3, False, "und"), (None, True, "en"), (5, True, "en")}
    assert {r.kept for r in identify_documents(odd, *train(odd.withColumnRenamed("n", "lang").limit(0))).collect()} == {False}
    assert identify_documents(odd.limit(0), languages, model).collect() == []


def test_evidence_besides_the_text(spark):
    docs = table(spark, FOLDER, "documents")
    languages, model = train(docs)
    pages = [(i, f"http://a.one.example/{i}", f"<html lang='fr-FR'><body><script>the the</script><p>{t}</p></body></html>") for i, t in
             enumerate(r.text[:300] for r in docs.where("lang = 'fr'").limit(40).collect())]
    pages += [(100, "http://a.one.example/q", "<html lang=fr><p>on</p>"), (101, "http://a.one.example/q", "<p>on</p>"), (102, None, None), (103, "nothing", "<b></b>")]
    got = {r.page_id: r for r in identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), languages, model).collect()}
    assert got[100].lang == "fr" and got[101].lang == "fr" and got[100].confidence >= got[101].confidence
    assert not got[102].kept and not got[103].kept


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(50):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 20))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert longest_common(a, b) == row[-1]
        masks = np.zeros(5, np.uint64)
        many = np.array([b, b[::-1], [4] * len(b)])
        for item in (a, (a * 70)[:70]):
            assert common_lengths(np.array(item), many, masks).tolist() == [longest_common(item, r) for r in many.tolist()]
        assert not masks.any()


def test_bit_sets_rule_out_no_leak():
    rng, known = np.random.default_rng(11), 1500  # more words than bits, so some share one
    numbers = [rng.integers(0, known, n) for n in (1, 4, 7, 8, 9, 30, 64, 700)]
    texts = []
    for item in numbers * 40:
        edited = np.where(rng.random(len(item)) < rng.random() * 0.8, rng.integers(0, known + 1, len(item)), item)
        texts.append(np.concatenate([rng.integers(0, known + 1, rng.integers(0, 40)), edited, rng.integers(0, known + 1, rng.integers(0, 40))]))
    word, bits, size = np.concatenate(texts), word_bits(known), np.array([len(x) for x in numbers])
    regions, signs, masks = Regions(word, bits, int(size.max()) + 24), item_signs(numbers, bits), np.zeros(known + 1, np.uint64)
    leaks = kept = 0
    for k, item in enumerate(numbers):
        start = rng.integers(0, len(word) - len(item) - 24, 400) if len(item) > 64 else np.arange(len(word) - len(item) - 24)
        rows = word[start[:, None] + np.arange(len(item) + 24)]
        _, _, leak = verdicts(item, rows, masks)
        left = _may_leak(regions, start, start + rows.shape[1], np.full(len(start), k), size, *signs)
        assert np.isin(np.flatnonzero(leak), left).all()
        leaks, kept = leaks + leak.sum(), kept + len(left) / len(start)
    assert leaks > 100 and kept < len(numbers) / 2


def test_sums_of_steps():
    rng = np.random.default_rng(2)
    table, term = rng.normal(size=(50, 3)), rng.integers(0, 50, 200)
    heads = np.array([0, 5, 6, 18, 30, 41, 53, 64, 76, 88, 100, 112, 124, 136, 148, 160, 172, 184, 196])
    assert np.allclose(_sums(table, term, heads, 12), np.add.reduceat(table[term], heads))


def test_short_items_stand_in_one_piece():
    leaks = lambda *regions: verdicts(np.array([1, 2, 3]), np.array(regions), np.zeros(10, np.uint64))[2].tolist()
    assert leaks([9, 1, 2, 3, 9], [1, 2, 3, 9, 9], [1, 9, 2, 8, 3], [1, 2, 9, 9, 9]) == [True, True, False, False]
    assert leaks([1, 2]) == [False]


@pytest.mark.parametrize("replaced", [0.0, 0.3])
def test_items_of_each_length_are_found_in_other_texts(spark, replaced):
    """Items of words of the corpus, put into documents that have nothing to do with them; 0.9 of each length at least.

    With replaced words items of fewer words than an answer are no leak, since those have to stand whole."""
    rng = random.Random(11)
    docs = [(r.doc_id, r.text.split()) for r in table(spark, FOLDER, "documents").where("length(text) > 600").collect()]
    vocabulary = sorted({"".join(c for c in w if c.isalnum()) for _, t in docs for w in t} - {""})
    lengths = [n for n in (4, 6, 8, 10, 12, 16, 20, 24, 40) if n >= 8 or not replaced]
    items, planted = [], {}
    for n in lengths:
        for _ in range(40):
            words = rng.sample(vocabulary, n)
            keep = rng.sample(range(n), int(n * replaced))
            shown = [rng.choice(vocabulary) if i in keep else w for i, w in enumerate(words)]
            doc, text = docs[len(items) % len(docs)]
            at = rng.randrange(len(text))
            text[at:at] = shown
            planted[len(items)] = (doc, n)
            items.append((len(items), " ".join(words)))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string").repartition(8)
    got = {(r.doc_id, r.item_id) for r in find_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    shares = {n: sum((d, k) in got for k, (d, m) in planted.items() if m == n) / 40 for n in lengths}
    assert min(shares.values()) >= 0.9, shares
    assert len(got - {(d, k) for k, (d, _) in planted.items()}) <= 0.01 * len(planted)


def test_leaks(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(3000)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {k: words(n) for k, n in enumerate((15, 25, 40, 56, 30, 20, 5))}
    docs = {i: words(rng.randrange(5, 400)) for i in range(300)}
    leaks = {(10, 0), (11, 1), (12, 2), (13, 3), (14, 4), (15, 2)}
    for i, k in leaks:
        docs[i][3:3] = [w.upper() + "," for w in items[k]]
    docs[15] = [w if n % 9 else rng.choice(vocabulary) for n, w in enumerate(docs[15])]  # some words changed
    docs[20] += items[3][:20]  # a part, without the answer
    rows = [(i, " ".join(w), 0) for i, w in docs.items()] + [(900, None, 0), (901, "", 0), (None, " ".join(items[1]), 0)]
    bench = spark.createDataFrame([(k, " ".join(w), 0) for k, w in items.items()] + [(50, None, 0), (51, "", 0)], "item_id long, text string, cosine int")
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id int").repartition(4)
    assert {(r.doc_id, r.item_id) for r in find_leaks(df, bench).collect()} == leaks | {(None, 1)}
    assert find_leaks(df.limit(0), bench).collect() == [] and find_leaks(df, bench.limit(0)).collect() == []


def test_leaks_of_documents(spark):
    squeeze = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    items = [(r.item_id, squeeze(r.text)) for r in table(spark, FOLDER, "benchmark").collect()]
    want = {(r.doc_id, k) for r in table(spark, FOLDER, "documents").collect() for k, t in items if t in squeeze(r.text or "")}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op5_benchmark_decontamination"](spark, FOLDER).collect()}
    assert len(want & got) >= 0.97 * len(want) and len(got - want) <= 0.05 * len(want)


def test_pipeline(spark):
    docs = table(spark, SMALL, "documents")
    before, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == columns and 0.5 * before <= docs.count() <= before, name
    pieces = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "the and of with this to", "en", "s", 5)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        odd = stage(spark, odd, SMALL).cache()
        odd.count()


def test_functions_sent_to_tasks_take_no_tables_of_powers_along():
    for base in (BASE, BASE_INVERSE):
        assert powers(base, 4).tolist() == [pow(int(base), k, 1 << 64) for k in range(4)]
    sent = cloudpickle.dumps(words_of)  # 34 MB when the tables were globals
    assert len(sent) < 100_000
    data, ends = np.frombuffer(b"one two three", np.uint8), np.array([0, 13])
    assert all((a == b).all() for a, b in zip(words_of(data, ends), cloudpickle.loads(sent)(data, ends)))
    known = powers(BASE, 4)
    assert np.shares_memory(known, cloudpickle.loads(cloudpickle.dumps(powers))(BASE, 4))  # one table per process


def test_bits_are_counted_up_to_full_rows():
    sets = np.random.default_rng(3).integers(0, 1 << 63, (50, 8)).astype(np.uint64)
    sets[0], sets[1] = np.uint64((1 << 64) - 1), 0
    assert _bits(sets).tolist() == [sum(int(x).bit_count() for x in row) for row in sets]
    assert _bits(sets[:0]).tolist() == []


def test_texts_in_many_parts_give_few_matrices(spark, monkeypatch):
    parts, whole = {}, decontaminate.added_up
    monkeypatch.setattr(decontaminate, "added_up", lambda rows, shapes, name, **more: parts.update({name: rows.rdd.getNumPartitions()}) or whole(rows, shapes, name, **more))
    docs = spark.createDataFrame(spark.sparkContext.parallelize([(k, f"some words of text {k} and {k % 7}") for k in range(300)], 100), "doc_id long, text string")
    axes = decontaminate.latent_axes(docs, np.ones(decontaminate.TERMS))
    assert parts["axes"] <= decontaminate.TURNS * spark.sparkContext.defaultParallelism < 100
    assert np.allclose(np.abs(axes), np.abs(decontaminate.latent_axes(docs.coalesce(1), np.ones(decontaminate.TERMS))), atol=1e-3)


def test_near_vectors_in_pieces(monkeypatch):
    rng = np.random.default_rng(6)
    vectors, known = rng.normal(size=(103, 8)).astype(np.float32), rng.normal(size=(7, 8)).astype(np.float32)
    monkeypatch.setattr(decontaminate, "CLOSE", 70)
    cosine, p, q = decontaminate._near(vectors, known, 1.0)
    want = np.argwhere(vectors @ known.T >= 1.0)
    assert [p.tolist(), q.tolist()] == want.T.tolist()
    assert np.allclose(cosine, (vectors @ known.T)[p, q])
