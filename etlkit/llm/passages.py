"""Fuzzy repeated passages: shared word seeds are chained in order with gap costs, and chains aligned."""

from __future__ import annotations

from bisect import bisect_right
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.llm.chunks import LAST, Chunks, answered, parts_for
from etlkit.llm.common import BASE, SPACES, discard, mixed, runs_of, staged, words_of
from etlkit.llm.decontaminate import longest_common
from etlkit.llm.suffix_dedup import _listed, _raw, _read

SEED_WORDS = 5
LENGTHS = (10, 20)  # words of longer runs that are joined; each twice the one before, beginning with SEED_WORDS; the last is PIECE
GAP_COST = 0.05  # per word between two seeds of a chain, on either side
WIDEN = 24  # words beyond an end of a chain that are aligned at once
BAND = 8  # words by which the sides may shift there
PAIRS, FEW = 1 << 11, 100  # pairs aligned at once; so few are aligned one by one
PIECE = 20  # least words of a chain that is aligned
PASSAGE = 50  # least words of a removed passage
JOIN = 3  # words between aligned pieces that are taken along
MARKS = 20  # upper bits of a seed that are looked at first
AT_ONCE = 1 << 19  # runs of a range of hashes that are settled at once
WORDS = 2 << 20  # words that a task looks up in a chunk for others
ALIKE = 0.8  # least share of words in common order


class Words:
    """Words of a chunk's texts, and where runs of SEED_WORDS begin and what they hash to."""

    def __init__(self, ids, ends, data):
        self.ids, self.ends = ids, ends
        self.hashes, self.where, self.start, self.end = words_of(data, ends)
        self.first = np.searchsorted(self.where, np.arange(len(ids) + 1))
        seeds = runs_of(self.hashes, SEED_WORDS)
        inside = self.where[:len(seeds)] == self.where[SEED_WORDS - 1:] if len(seeds) else np.zeros(0, bool)
        self.at = np.flatnonzero(inside)
        self.seeds = seeds[self.at]
        self.runs = seeds

    def distinct(self):
        """The distinct seeds, sorted, and which of them occur more than once here."""
        order = np.sort(self.seeds)
        head = np.ones(len(order), bool)
        head[1:] = order[1:] != order[:-1]
        at = np.flatnonzero(head)
        return order[at], np.diff(at, append=len(order)) > 1

    def repeated(self, flags: list[bytes], parts: int):
        """Seeds that occur elsewhere too (hash, first word), and for each word whether such a seed begins there."""
        seeds, often = self.distinct()
        cuts = _cuts(seeds, parts)
        for f in flags:
            p = int.from_bytes(f[:4], "little")
            n = cuts[p + 1] - cuts[p]
            often[cuts[p]:cuts[p + 1]] |= np.unpackbits(np.frombuffer(f, np.uint8, offset=4), count=n).astype(bool)
        known = seeds[often]
        begins = np.zeros(len(self.hashes), bool)
        if len(known):
            short = np.zeros(1 << MARKS, bool)  # by the upper bits of a seed: whether a known one has them
            short[known >> np.uint64(64 - MARKS)] = True
            maybe = np.flatnonzero(short[self.seeds >> np.uint64(64 - MARKS)])
            found = np.minimum(np.searchsorted(known, self.seeds[maybe]), len(known) - 1)
            begins[self.at[maybe[known[found] == self.seeds[maybe]]]] = True
        at = np.flatnonzero(begins)
        return self.runs[at], at, begins

    def open_runs(self, begins: np.ndarray, found):
        """Runs of 10 and 20 words (LENGTHS) all of whose seeds occur elsewhere too, but not known to stand whole in an earlier
        document, as the seeds' matches would on one diagonal: hash, first word, length.

        The first document that holds such a run cannot know it from an earlier one, so it always puts the run out."""
        before = np.concatenate([[0], np.cumsum(begins)])
        order, head, tail = _diagonals(found, 1)
        text, q = found[0][order], found[1][order]
        place = self.first[text] + q
        out, runs, length = [], self.runs, SEED_WORDS
        for k in LENGTHS:
            half = max(0, len(runs) - length)  # two runs of half the length, one after the other
            runs, length = mixed(runs[:half] * BASE + runs[length:length + half] + np.uint64(k)), k
            need = k - SEED_WORDS + 1
            wide = tail - head + 1 >= need
            known = np.zeros(len(self.hashes) + 1, np.int64)
            np.add.at(known, place[head[wide]], 1)
            np.add.at(known, place[tail[wide]] - need + 2, -1)
            at = np.flatnonzero((before[need:len(runs) + need] - before[:len(runs)] == need) & (np.cumsum(known)[:len(runs)] == 0))
            out.append((runs[at], at, np.full(len(at), k)))
        return [np.concatenate(x) for x in zip(*out)]

    def spot(self, at: np.ndarray) -> np.ndarray:
        """Text number and place in the text of words, in one number."""
        text = self.where[at].astype(np.int64) if len(at) else np.zeros(0, np.int64)
        return text << 32 | (at - self.first[text])

    def earliest(self, runs: np.ndarray, at: np.ndarray):
        """First document and place of each distinct run: runs, documents, spots."""
        spot = self.spot(at)
        doc = self.ids[spot >> 32]
        order = np.lexsort((spot, doc, runs))
        head = np.ones(len(order), bool)
        head[1:] = runs[order][1:] != runs[order][:-1]
        order = order[head]
        return runs[order], doc[order], spot[order]


def _cuts(runs: np.ndarray, parts: int) -> np.ndarray:
    """Where sorted hashes fall into `parts` equal ranges."""
    bounds = np.array([(p << 64) // parts for p in range(parts)], np.uint64)
    return np.append(np.searchsorted(runs, bounds), len(runs))


def _prints(parts):
    """To each range of hashes: the low halves of a chunk's distinct seeds."""
    def ask(ids, ends, data, _):
        seeds, _ = Words(ids, ends, data).distinct()
        cuts, low = _cuts(seeds, parts), seeds.astype(np.uint32)
        return {p: p.to_bytes(4, "little") + low[a:b].tobytes() for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a}
    return ask


def _met(blobs):
    """To each chunk: which of its seeds another chunk has too, as bits. Equal halves of unequal seeds only add a few."""
    prints = [np.frombuffer(b, np.uint32, offset=4) for b in blobs]
    order = np.concatenate(prints)
    order.sort()
    often = np.unique(order[1:][order[1:] == order[:-1]])
    del order
    for i, mine in enumerate(prints if len(often) else []):
        hit = often[np.minimum(np.searchsorted(often, mine), len(often) - 1)] == mine
        if hit.any():
            yield i, bytes(blobs[i][:4]) + np.packbits(hit).tobytes()


def _dealt(w: Words, runs, at, parts):
    runs, doc, spot = w.earliest(runs, at)
    cuts = _cuts(runs, parts)
    return {p: _raw(runs[a:b], doc[a:b], spot[a:b]) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a}


def _seeds(parts):
    def ask(ids, ends, data, flags):
        w = Words(ids, ends, data)
        return _dealt(w, *w.repeated(flags, parts)[:2], parts)
    return ask


def _longer(parts):
    def ask(ids, ends, data, got):
        w = Words(ids, ends, data)
        runs, at, begins = w.repeated(_tagged(got, b"1"), parts)
        return _dealt(w, *w.open_runs(begins, _matches(w, runs, at, _tagged(got, b"2"))[0])[:2], parts)
    return ask


def _places(blobs, numbers):
    """To each chunk, for its runs that an earlier document of another chunk has: run, document, spot and chunk of the first place.

    Each blob is sorted by run, so the group is settled AT_ONCE rows at a time, range after range of runs: how many runs recur
    in a chunk grows with the corpus, up to all of them."""
    rows = [_read(b, np.uint64, np.int64, np.int64) for b in blobs]
    turns = max(1, -(-sum(len(r[0]) for r in rows) // AT_ONCE))
    low, high = min((int(r[0][0]) for r in rows if len(r[0])), default=0), max((int(r[0][-1]) for r in rows if len(r[0])), default=0)
    bounds = [low + (high - low + 1) * t // turns for t in range(1, turns)]
    cuts = [[0, *np.searchsorted(r[0], np.array(bounds, np.uint64)).tolist(), len(r[0])] for r in rows]
    for t in range(turns):
        yield from _first([[x[c[t]:c[t + 1]] for x in r] for r, c in zip(rows, cuts)], numbers)


def _first(rows, numbers):
    run, doc, spot = (np.concatenate([r[i] for r in rows]) for i in range(3))
    chunk = np.repeat(numbers, [len(r[0]) for r in rows])
    order = np.lexsort((spot, chunk, doc, run))
    new = np.ones(len(order), bool)
    new[1:] = run[order][1:] != run[order][:-1]
    lead = np.empty(len(order), np.int64)
    lead[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    del order, new
    at = 0
    for k, r in enumerate(rows):
        mine = np.arange(at, at + len(r[0]))
        mine = mine[doc[lead[mine]] < doc[mine]]
        i = lead[mine]
        if len(mine):
            yield k, _raw(run[mine], doc[i], spot[i], chunk[i])
        at += len(r[0])


def chain(q: list[int], r: list[int]) -> list[list[int]]:
    """Disjoint chains of matches (q, r), increasing in both, best first: indices into the lists, which are in q order.

    A match adds SEED_WORDS; each word of distance to its predecessor costs GAP_COST on either side. As this cost is a
    sum, the best predecessor is a maximum over smaller r, which a Fenwick tree over the ranks of r keeps.
    """
    rank = {v: k + 1 for k, v in enumerate(sorted(set(r)))}
    n = len(rank)
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (n + 1)
    score, back = [0.0] * len(q), [-1] * len(q)
    i = 0
    while i < len(q):
        same = i
        while same < len(q) and q[same] == q[i]:  # matches of one q do not follow one another
            k, best = rank[r[same]] - 1, (-1e18, -1)
            while k:
                if tree[k] > best:
                    best = tree[k]
                k -= k & -k
            linked = best[0] - GAP_COST * (q[same] + r[same])
            score[same] = SEED_WORDS + max(0.0, linked)
            back[same] = best[1] if linked > 0 else -1
            same += 1
        for m in range(i, same):
            k, value = rank[r[m]], (score[m] + GAP_COST * (q[m] + r[m]), m)
            while k <= n:
                if value > tree[k]:
                    tree[k] = value
                k += k & -k
        i = same
    used, out = [False] * len(q), []
    for m in sorted(range(len(q)), key=lambda m: (-score[m], m)):
        found = []
        while m >= 0 and not used[m]:
            used[m] = True
            found.append(m)
            m = back[m]
        if found:
            out.append(found[::-1])
    return out


def _matches(w: Words, runs, at, answers: list[bytes]):
    """text, q, r, document there, text there and its chunk (-1: this one) of the runs whose first place is in an earlier
    document. One that many documents share gives one match per occurrence and no pairs among them."""
    known, doc, spot = w.earliest(runs, at)
    chunk = np.full(len(known), -1, np.int64)
    far = _listed(answers, np.uint64, np.int64, np.int64, np.int64)
    to = np.searchsorted(known, far[0])
    doc[to], spot[to], chunk[to] = far[1:]
    match = np.searchsorted(known, runs)
    here = w.spot(at)
    mine = np.flatnonzero(doc[match] < w.ids[here >> 32])
    match, here, low = match[mine], here[mine], (1 << 32) - 1
    return [here >> 32, here & low, spot[match] & low, doc[match], spot[match] >> 32, chunk[match]], mine


def _diagonals(found, step: int):
    """Order of matches by diagonal, and there the first and last of each stretch that goes on by `step` words at most."""
    text, q, r, _, k, chunk = found
    order = np.lexsort((q, q - r, k, chunk, text))
    apart = np.ones(len(order), bool)
    if len(order):
        apart[1:] = np.diff(q[order]) > step
        for x in (text, q - r, k, chunk):
            apart[1:] |= np.diff(x[order]) != 0
    head = np.flatnonzero(apart)
    return order, head, np.append(head[1:], len(order))[:len(head)] - 1


def chains_of(w: Words, flags: list[bytes], places: list[bytes], longer: list[bytes], parts: int):
    """(text, chunk referred to or -1 if this one, text there, document there, q from, q to, r from, r to) of chains of two
    matches or more, and of equal pieces.

    A passage can hide behind other places of its seeds, but not behind those of its runs of 20 words: their first place
    shares a whole piece. In chains a longer run stands for the seeds at its ends.
    """
    runs, at, begins = w.repeated(flags, parts)
    found, _ = _matches(w, runs, at, places)
    runs, at, length = w.open_runs(begins, found)
    far, mine = _matches(w, runs, at, longer)
    whole = [x[length[mine] == PIECE] for x in far]
    for some, words in ((found, SEED_WORDS), (whole, PIECE)):
        order, head, tail = _diagonals(some, 1)
        text, q, r, doc, k, chunk = (x[order] for x in some)
        long = q[tail] + words - q[head] >= PIECE
        for a, b in zip(head[long].tolist(), tail[long].tolist()):
            yield int(text[a]), int(chunk[a]), int(k[a]), int(doc[a]), int(q[a]), int(q[b]) + words, int(r[a]), int(r[b]) + words
    ends = [x + (length[mine] - SEED_WORDS) if i in (1, 2) else x for i, x in enumerate(far)]
    text, q, r, doc, k, chunk = (np.concatenate(x) for x in zip(found, far, ends))
    order = np.lexsort((r, q, k, chunk, text))
    text, q, r, k, chunk, doc = (x[order] for x in (text, q, r, k, chunk, doc))
    group, same = np.ones(len(text), bool), np.zeros(len(text), bool)
    group[1:] = (text[1:] != text[:-1]) | (chunk[1:] != chunk[:-1]) | (k[1:] != k[:-1])
    same[1:] = ~group[1:] & (q[1:] == q[:-1]) & (r[1:] == r[:-1])
    text, q, r, k, chunk, doc, group = (x[~same] for x in (text, q, r, k, chunk, doc, group))
    cut = np.flatnonzero(group)
    to = np.append(cut[1:], len(text))[:len(cut)]
    several = to - cut > 1
    for a, b in zip(cut[several].tolist(), to[several].tolist()):
        qs, rs = q[a:b], r[a:b]
        if (rs - qs == rs[0] - qs[0]).all() and np.diff(qs).max() * 2 * GAP_COST < SEED_WORDS:  # one chain, whatever the costs
            spans = [(int(qs[0]), int(qs[-1]), int(rs[0]), int(rs[-1]))]
        else:
            qs, rs = qs.tolist(), rs.tolist()
            spans = [(qs[c[0]], qs[c[-1]], rs[c[0]], rs[c[-1]]) for c in chain(qs, rs) if len(c) > 1]
        for q0, q1, r0, r1 in spans:
            yield int(text[a]), int(chunk[a]), int(k[a]), int(doc[a]), q0, q1 + SEED_WORDS, r0, r1 + SEED_WORDS


PAD = 2 * WIDEN


def _around(chains) -> dict[tuple[int, int, int], int]:
    """Where the words begin that are needed for chains that refer to other chunks (chunk, text there, first word), and where they end."""
    out: dict[tuple[int, int, int], int] = {}
    for _, chunk, k, _, _, _, r0, r1 in chains:
        if chunk >= 0:
            x = chunk, k, max(0, r0 - PAD)
            out[x] = max(out.get(x, 0), r1 + PAD)
    return out


def _requests(chunks: Chunks, answers: DataFrame, parts: int) -> DataFrame:
    """(chunk, chains, wanted): to each chunk its own chains (tag 3), and to those referred to which words are wanted by whom (tag 4, how
    many), in columns that are read by themselves. Words that several chains need are asked for once, so two chunks exchange no more than
    the words of one."""
    def ask(ids, ends, data, got):
        number = int.from_bytes(got[0], "little")
        w = Words(ids, ends, data)
        chains = sorted(set(chains_of(w, *(_tagged(got[1:], tag) for tag in (b"1", b"2", b"6")), parts)))
        wanted: dict[int, list] = {}
        for (chunk, k, x), y in sorted(_around(chains).items()):
            spans = wanted.setdefault(chunk, [])
            if spans and spans[-1][1] == k and x <= spans[-1][3]:
                spans[-1][3] = max(spans[-1][3], y)
            else:
                spans.append([number, k, x, y])
        out = {c: b"4" + sum(s[3] - s[2] for s in spans).to_bytes(8, "big") + _raw(*np.array(spans, np.int64).T) for c, spans in wanted.items()}
        return out | ({number: b"3" + _raw(*[np.array(x, np.int64) for x in zip(*chains)])} if chains else {})
    tagged = lambda tag: F.when(F.substring("data", 1, 1) == F.lit(tag), F.col("data"))
    return chunks.route(ask, answers, every=True).select("chunk", tagged(b"3").alias("chains"), tagged(b"4").alias("wanted"))


def _some(numbers, ids, ends, data) -> Words:
    """Words of the texts with these numbers."""
    numbers = np.asarray(numbers, np.int64)
    sub = np.concatenate([[0], np.cumsum(ends[numbers + 1] - ends[numbers])]).astype(np.int64)
    return Words(ids[numbers], sub, np.concatenate([data[ends[k]:ends[k + 1]] for k in numbers.tolist()]))


def _responses(chunks: Chunks, requests: DataFrame) -> DataFrame:
    def ask(ids, ends, data, got):
        asker, k, r0, r1 = _listed([g[9:] for g in got[1:]], *[np.int64] * 4)
        numbers, row = np.unique(k, return_inverse=True)
        w = _some(numbers, ids, ends, data)
        out: dict[int, list[bytes]] = {}
        for a, i, t, x, y in zip(asker.tolist(), row.tolist(), k.tolist(), r0.tolist(), r1.tolist()):
            words = w.hashes[w.first[i] + x:min(w.first[i] + y, w.first[i + 1])]
            out.setdefault(a, []).append(got[0] + np.array([t, x, len(words)], np.int64).tobytes() + words.tobytes())
        return {a: b"5" + b"".join(x) for a, x in out.items()}
    words = F.conv(F.hex(F.substring("data", 2, 8)), 16, 10).cast("long")
    return chunks.spread(ask, requests.where("wanted IS NOT NULL").select("chunk", F.col("wanted").alias("data")), words, WORDS)


def _tagged(answers: list[bytes], tag: bytes) -> list[bytes]:
    return [a[1:] for a in answers if a[:1] == tag]


def _texts(answers: list[bytes]) -> dict[tuple[int, int, int], np.ndarray]:
    """Words by the chunk they came from, the text there and the place of the first one."""
    out = {}
    for data in answers:
        at = 0
        while at < len(data):
            c, k, x, n = np.frombuffer(data, np.int64, 4, at).tolist()
            out[c, k, x] = np.frombuffer(data, np.uint64, n, at + 32)
            at += 32 + 8 * n
    return out


def widened(q: list[int], r: list[int]) -> tuple[int, int]:
    """How many first words of q and r go together: an alignment scores 1 for a word in common and -1 for an edit; it
    ends where the score is highest, as far out as that is, but with a word in common."""
    best, end, n = 0, (0, 0), len(r)
    if set(q).isdisjoint(r):
        return end
    above = [-j if j <= BAND else -99 for j in range(n + 1)]
    for i, word in enumerate(q, 1):
        row, left, top = [-99] * (n + 1), -99, -99
        for j in range(max(0, i - BAND), min(n, i + BAND) + 1):
            score = (above[j] if above[j] > left else left) - 1
            if j:
                same = word == r[j - 1]
                both = above[j - 1] + (1 if same else -1)
                if both > score:
                    score = both
                if same and score >= best:
                    best, end = score, (i, j)
            row[j] = left = score
            if score > top:
                top = score
        if top < best - 2 * BAND:
            break
        above = row
    return end


def aligned(q: np.ndarray, q0: int, q1: int, r: np.ndarray, r0: int, r1: int) -> tuple[int, int] | None:
    """The span of q, widened over equal words and edits among them, if it has ALIKE of its words in common order with
    r's span; otherwise the span widened over equal words only, if that has."""
    def over_equal(q0, q1, r0, r1):
        while q0 and r0 and q[q0 - 1] == r[r0 - 1]:
            q0, r0 = q0 - 1, r0 - 1
        while q1 < len(q) and r1 < len(r) and q[q1] == r[r1]:
            q1, r1 = q1 + 1, r1 + 1
        return q0, q1, r0, r1

    narrow = wide = over_equal(q0, q1, r0, r1)
    while True:
        q0, q1, r0, r1 = wide
        i, j = widened(q[max(0, q0 - WIDEN):q0][::-1].tolist(), r[max(0, r0 - WIDEN):r0][::-1].tolist())
        k, m = widened(q[q1:q1 + WIDEN].tolist(), r[r1:r1 + WIDEN].tolist())
        if not (i or k):
            break
        wide = over_equal(q0 - i, q1 + k, r0 - j, r1 + m)
    return _alike(q, r, wide, narrow)


def widened_all(q: np.ndarray, r: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`widened` of many pairs at once: rows of WIDEN words, of which `room` are there in r; those that are not are not equal to any."""
    n = len(room)
    best, active = np.zeros(n, np.int16), np.ones(n, bool)
    end_q, end_r = np.zeros(n, np.int64), np.zeros(n, np.int64)
    above = np.full((WIDEN + 1, n), -99, np.int16)
    above[:BAND + 1] = -np.arange(BAND + 1)[:, None]
    q, r = np.ascontiguousarray(q.T), np.ascontiguousarray(r.T)
    for i in range(1, WIDEN + 1):
        row = np.full((WIDEN + 1, n), -99, np.int16)
        left = top = np.full(n, -99, np.int16)
        for j in range(max(0, i - BAND), min(WIDEN, i + BAND) + 1):
            score = np.maximum(above[j], left, out=row[j])
            score -= 1
            if j:
                same = q[i - 1] == r[j - 1]
                np.maximum(score, above[j - 1] + (2 * same.view(np.int8) - 1), out=score)
                same &= score >= best
                same &= active
                hit = np.flatnonzero(same)
                best[hit], end_q[hit], end_r[hit] = score[hit], i, j
            left, top = score, np.maximum(top, np.where(j <= room, score, -99))
        active &= top >= best - 2 * BAND
        if not active.any():
            break
        above = row
    return end_q, end_r


def _beside(words: np.ndarray, at: np.ndarray, room: np.ndarray, step: int, none: int) -> np.ndarray:
    """Rows of the WIDEN words from `at` on (step 1) or before `at` backwards (step -1), `none` where there is no room for them."""
    by = np.arange(WIDEN)
    place = at[:, None] + (by if step > 0 else -1 - by)
    there = by < room[:, None]
    return np.where(there, words[np.where(there, place, 0)], np.uint64(none))


def aligned_all(words: np.ndarray, q: np.ndarray, r: np.ndarray) -> list[tuple[int, int] | None]:
    """`aligned` of many pairs at once. Rows of q and r: where in `words` the text begins, its span begins, its span ends and it ends."""
    def run(a, b, room, step):
        """How many words from a and b on (step 1) or before them (step -1) are equal, at most `room`."""
        out, left = np.zeros(len(a), np.int64), np.arange(len(a))
        while len(left):
            done = out[left]
            x, y = (_beside(words, p[left] + step * done, room[left] - done, step, none) for none, p in enumerate((a, b)))
            n = np.argmin(np.append(x == y, np.zeros((len(left), 1), bool), axis=1), axis=1)
            n = np.minimum(n, room[left] - done)
            out[left] += n
            left = left[n == WIDEN]
        return out

    def over_equal(q0, q1, r0, r1, of):
        before = run(q0, r0, np.minimum(q0 - q[of, 0], r0 - r[of, 0]), -1)
        after = run(q1, r1, np.minimum(q[of, 3] - q1, r[of, 3] - r1), 1)
        return np.stack([q0 - before, q1 + after, r0 - before, r1 + after])

    narrow = over_equal(q[:, 1], q[:, 2], r[:, 1], r[:, 2], np.arange(len(q)))
    wide, left = narrow.copy(), np.arange(len(q))
    while len(left):
        q0, q1, r0, r1 = wide[:, left]
        sides = ((q0, r0, q0 - q[left, 0], r0 - r[left, 0], -1), (q1, r1, q[left, 3] - q1, r[left, 3] - r1, 1))
        x, y = (np.concatenate([_beside(words, side[of], side[of + 2], side[4], of) for side in sides]) for of in (0, 1))
        n = len(left)
        if n > FEW:
            (i, k), (j, m) = (np.split(x, 2) for x in widened_all(x, y, np.concatenate([side[3] for side in sides])))
        else:
            ends = np.array([widened(a, b[:room]) for a, b, room in zip(x.tolist(), y.tolist(), np.concatenate([side[3] for side in sides]).tolist())])
            (i, j), (k, m) = ends[:n].T, ends[n:].T
        more = np.flatnonzero((i > 0) | (k > 0))
        left = left[more]
        wide[:, left] = over_equal(*(x[more] for x in (q0 - i, q1 + k, r0 - j, r1 + m)), left)
    return [_alike(words, words, *spans) for spans in zip(zip(*wide.tolist()), zip(*narrow.tolist()))]


def _alike(q: np.ndarray, r: np.ndarray, wide: tuple, narrow: tuple) -> tuple[int, int] | None:
    """The first of the two pairs of spans that has ALIKE of its words in common order: the one in q."""
    for q0, q1, r0, r1 in dict.fromkeys((wide, narrow)):
        if q1 - q0 < PIECE:
            continue
        a, b = q[q0:q1], r[r0:r1]
        if len(a) == len(b) and (a == b).all() or longest_common(a.tolist(), b.tolist()) >= ALIKE * max(len(a), len(b)):
            return q0, q1
    return None


def _word_counts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inside = np.frombuffer(data.tobytes().translate((~SPACES).tobytes()), bool)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = ends[1:-1][ends[1:-1] < len(data)]  # a word that goes on over the border of two texts
    first[cut] |= inside[cut]
    return np.diff(np.searchsorted(np.flatnonzero(first), ends))


SCHEMA = "doc_id long, n_words long, n_removed long, spans array<struct<first:long,last:long,other:long>>, text binary"


def _pieces(w: Words, row: dict[int, int], chains: list[tuple], texts: dict) -> dict[int, list]:
    """The aligned spans of each text and the document that each refers to. `row`: which text of w has a number."""
    words = np.concatenate([w.hashes, *texts.values()])
    bounds = w.first.tolist()
    inside = {k: (bounds[i], bounds[i + 1]) for k, i in row.items()}  # where a text's words are
    far: dict[tuple[int, int], list] = {}  # what is known of a text of another chunk: from which word on, and where that is
    for (c, k, x), a, b in zip(texts, *(np.cumsum([len(w.hashes), *map(len, texts.values())])[i:len(texts) + i].tolist() for i in (0, 1))):
        far.setdefault((c, k), []).append((x, a, b))
    for known in far.values():
        known.sort()
    around = _around(chains)
    waiting: dict[tuple, list] = {}
    for c in sorted(chains, key=lambda c: (c[4] - c[5], c), reverse=True):
        waiting.setdefault(c[:3], []).append(c)
    found: dict[tuple, list] = {x: [] for x in waiting}
    pieces: dict[int, list] = {}
    while waiting:  # of each text and document referred to, the longest chain that is left
        turn, q, r = [], [], []
        for x, left in list(waiting.items()):
            spans = found[x]
            while left:
                c = left.pop()
                if not any(a <= c[4] and c[5] <= b for a, b in spans):  # else a longer chain over these words has been aligned with this document
                    (q_first, q_end), shift = inside[x[0]], 0 if x[1] < 0 else max(0, c[6] - PAD)
                    if x[1] < 0:
                        r_first, r_end = inside[x[2]]
                    else:
                        known = far[x[1], x[2]]
                        start, a, b = known[bisect_right(known, shift, key=itemgetter(0)) - 1]
                        r_first, r_end = a + shift - start, min(a + around[x[1], x[2], shift] - start, b)
                    turn.append(c)
                    q.append((q_first, q_first + c[4], q_first + c[5], q_end))
                    r.append((r_first, r_first + c[6] - shift, r_first + c[7] - shift, r_end))
                    break
            else:
                del waiting[x]
        for i in range(0, len(turn), PAIRS):
            for c, (q_first, *_), span in zip(turn[i:i + PAIRS], q[i:i + PAIRS], _aligned(words, q[i:i + PAIRS], r[i:i + PAIRS])):
                if span:
                    found[c[:3]].append((span[0] - q_first, span[1] - q_first))
                    pieces.setdefault(c[0], []).append((span[0] - q_first, span[1] - q_first, c[3]))
    return pieces


def _aligned(words: np.ndarray, q: list[tuple], r: list[tuple]) -> list[tuple[int, int] | None]:
    """`aligned_all`, or one after the other if they are few."""
    if len(q) > FEW:
        return aligned_all(words, np.array(q), np.array(r))
    out = []
    for (a, q0, q1, b), (c, r0, r1, d) in zip(q, r):
        span = aligned(words[a:b], q0 - a, q1 - a, words[c:d], r0 - c, r1 - c)
        out.append(span and (span[0] + a, span[1] + a))
    return out


def _result(ids, ends, data, tagged):
    chains = list(zip(*[x.tolist() for x in _listed(_tagged(tagged, b"3"), *[np.int64] * 8)]))
    texts = _texts(_tagged(tagged, b"5"))
    numbers = sorted({c[0] for c in chains} | {c[2] for c in chains if c[1] < 0})
    w = _some(numbers, ids, ends, data) if numbers else None
    row = {k: i for i, k in enumerate(numbers)}
    pieces = _pieces(w, row, chains, texts) if numbers else {}
    spans, removed, kept = [], [], []
    for k in range(len(ids)):
        out: list[list[int]] = []
        for a, b, doc in sorted(pieces.get(k, [])):
            if out and a <= out[-1][1] + JOIN:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b, doc])
        out = [s for s in out if s[1] - s[0] >= PASSAGE]
        gone = np.zeros(ends[k + 1] - ends[k], bool)
        for a, b, _ in out:
            gone[w.start[w.first[row[k]] + a] - w.ends[row[k]]:w.end[w.first[row[k]] + b - 1] - w.ends[row[k]]] = True
        spans.append([{"first": a, "last": b - 1, "other": doc} for a, b, doc in out])
        removed.append(sum(b - a for a, b, _ in out))
        kept.append(data[ends[k]:ends[k + 1]][~gone].tobytes())
    return pa.RecordBatch.from_arrays([
        pa.array(ids, mask=ids == LAST), pa.array(_word_counts(data, ends)), pa.array(removed, pa.int64()),
        pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("other", pa.int64())]))), pa.array(kept, pa.binary())],
        ["doc_id", "n_words", "n_removed", "spans", "text"])


def remove_repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, spans (first and last word, document it repeats), text (what stays, UTF-8 bytes).

    A passage of PASSAGE words or more goes if documents with smaller ids hold it, up to a fifth of its words. Seeds, and runs
    of 10 and 20 words, that occur more than once are joined with places of theirs in earlier documents (see `chains_of`),
    chained per document and document referred to, and chains are
    aligned with that document's words; pieces that follow one another count together. Words stand between white
    space, A-Z in lower case. NULL texts count as empty, NULL ids stand after all others; rows that share an id do not
    repeat each other; an empty table gives no rows; other columns are ignored.
    """
    chunks = Chunks(docs, "passages")
    parts = parts_for(chunks.count, 2 << 20)
    tag = lambda df, k: df.select("chunk", F.concat(F.lit(k).cast("binary"), F.col("data")).alias("data"))
    flags = staged(answered(chunks.ask(_prints(parts), None, parts), _met), "flags")
    places = staged(answered(chunks.ask(_seeds(parts), flags, parts), _places, numbered=True), "places")
    told = tag(flags, "1").union(tag(places, "2"))
    longer = staged(answered(chunks.ask(_longer(parts), told, parts), _places, numbered=True), "longer")
    requests = staged(_requests(chunks, told.union(tag(longer, "6")), parts), "requests")
    discard(flags, places, longer)
    own = requests.where("chains IS NOT NULL").select("chunk", F.col("chains").alias("data"))
    return chunks.finish(_result, SCHEMA, own.union(_responses(chunks, requests)))
