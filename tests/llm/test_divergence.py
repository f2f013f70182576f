"""Transducers against plain lists, the audit against SQL and brute force."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from etlkit.llm import divergence
from etlkit.llm.divergence import audit_divergence, vocabulary_of
from etlkit.llm.queries import QUERIES, SQL
from etlkit.llm.transducer import build, from_bytes, ordinals, term_at, to_bytes
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.01"


def places(machine, terms):
    ends = np.cumsum([0, *map(len, terms)])
    data = np.frombuffer(b"".join(terms) or b"\0", np.uint8)
    return ordinals(machine, data, ends[:-1], ends[1:]).tolist()


def test_transducer_numbers_terms_in_order():
    rng = random.Random(5)
    for n in (1, 2, 10, 500, 3000):
        terms = sorted({bytes(rng.choice(b"abz\xc3\xff" if n < 3000 else range(1, 256)) for _ in range(rng.randrange(0 if n < 3000 else 1, 9))) for _ in range(n)})
        machine = from_bytes(to_bytes(build(terms)))
        assert places(machine, terms) == list(range(len(terms)))
        others = [t for t in {t + b"a" for t in terms} | {t[:-1] for t in terms} | {b"", b"q", b"\x00"} if t not in set(terms)]
        assert set(places(machine, others)) <= {-1}
        assert [term_at(machine, i) for i in range(len(terms))] == terms


def test_transducer_is_minimal():
    """As many states as there are different sets of endings."""
    rng = random.Random(3)
    terms = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(7))) for _ in range(60)})
    prefixes = {t[:i] for t in terms for i in range(len(t) + 1)}
    endings = {frozenset(t[len(p):] for t in terms if t.startswith(p)) for p in prefixes}
    assert len(build(terms)["final"]) == len(endings)
    with pytest.raises(ValueError):
        build([b"b", b"a"])


def brute(docs, least=3, top=200):
    docs = [(t or "", l or "", s or "") for t, l, s in docs]
    words = [([re.sub("[A-Z]", lambda c: c[0].lower(), w) for w in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)], l, s) for t, l, s in docs]
    out = []
    for lang in {l for _, l, _ in docs}:
        mine = [(w, s) for w, l, s in words if l == lang]
        often = Counter(t for w, _ in mine for t in set(w))
        kept = sorted((t for t, n in often.items() if n >= least), key=str.encode)
        counts = {s: Counter(t for w, x in mine if x == s for t in w) for s in {s for _, s in mine}}
        whole = sum(counts.values(), Counter())

        def share(c):
            total = sum(c[t] for t in kept)
            return [1 + 10 ** 9 * (c[t] + 1) // (total + len(kept)) for t in kept]

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in counts:
            pairs = [(o, sum((x - y) ** 2 // y for x, y in zip(p[s], p[o]))) for o in counts if o != s]
            told = [(t, (x - y) ** 2 // y) for t, x, y in zip(kept, p[s], q) if counts[s][t] and x > y]
            for part, items, most in (("pair", pairs, None), ("term", told, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r + 1) for r, (i, v) in enumerate(items[:most])]
    return sorted(out, key=repr)


COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def made_up(rng, n, sources):
    vocabulary = ["".join(rng.choice("abéZ𝒳") for _ in range(rng.randrange(1, 5))) for _ in range(80)]
    glue = [" ", "\n", "1", "-", "@", "[", "`", "{", "\x7f"]
    text = lambda: "".join(rng.choice(vocabulary[: rng.choice((10, 80))]) + rng.choice(glue) for _ in range(rng.randrange(60)))
    return [(text(), rng.choice(["x", "y"]), f"s{rng.randrange(sources)}") for _ in range(n)]


def frame(spark, docs, parts=4):
    return spark.createDataFrame([(1, *d, "clash", 5) for d in docs], "doc_id long, text string, lang string, source string, term string, n long").repartition(parts)


@pytest.mark.parametrize("sent_bytes", [1 << 30, 0])
def test_audit_against_brute_force(spark, rows, monkeypatch, sent_bytes):
    """By both ways of recounting; with several shards, blocks of terms and of sources, and tasks that hold few counts."""
    for name, value in (("SHARD_TERMS", 7), ("BLOCK_TERMS", 5), ("BLOCK_SOURCES", 3), ("HELD_ROWS", 20)):
        monkeypatch.setattr(divergence, name, value)
    rng = random.Random(8)
    docs = made_up(rng, 120, 8) + [(None, "x", "s1"), ("", None, None), (None, "", "only"), ("alone " * 5, "z", "one"), ("few words", "v", "a"), ("few words", "v", "b"), ("other", "v", "c")]
    docs += [("ab " * 2000, "x", "s0")] * 40
    got = audit_divergence(frame(spark, docs), sent_bytes=sent_bytes)
    assert rows(got, *COLUMNS) == brute(docs)


def test_ties_stand_in_byte_order(spark, rows):
    docs = [("z é Z a 𝒳 ｚ", "x", "s0")] * 3 + [("b", "x", "s1")] * 3
    got = rows(audit_divergence(frame(spark, docs), top=4), *COLUMNS)
    assert got == brute(docs, top=4)
    assert [r[3] for r in got if r[1] == "s0" and r[2] == "term"] and len([r for r in got if r[2] == "term"]) == 5


def test_empty_table(spark):
    assert audit_divergence(frame(spark, [("a", "x", "s")]).limit(0)).collect() == []


def test_vocabulary_is_numbered_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_TERMS", 9)
    docs = made_up(random.Random(1), 60, 2)
    found = vocabulary_of(frame(spark, docs).select("lang", "text"), 2).collect()
    assert len({r.shard for r in found}) > 3
    for lang, many in itertools.groupby(sorted(found, key=lambda r: (r.lang, r.ordinal)), key=lambda r: r.lang):
        many = list(many)
        assert [r.ordinal for r in many] == list(range(len(many)))
        assert [r.term.encode() for r in many] == sorted(r.term.encode() for r in many)


def test_documents_against_sql(spark):
    assert differences(QUERIES["op13_source_divergence_audit"](spark, FOLDER), connect(FOLDER), SQL["op13_source_divergence_audit"]) == []
