"""Periodic runs of words: maximal pairs out of the LCP-interval tree of a document's suffixes."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.llm.common import BASE, SPACES, columns_of, mixed, runs_of, slices
from etlkit.llm.spans import packed, spans

LEAST = 12  # words of the shortest run
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


# ---- one document ------------------------------------------------------------------------------------------

def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in lexicographic order, rank of each), by doubling the compared length; a suffix's end sorts first."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    h = 1
    while h < n and rank.max() < n - 1:
        key = rank * (n + 1)
        key[:n - h] += rank[h:] + 1
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        h *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, rank


def common_prefixes(ids: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Entry k: length of the common prefix of the suffixes at places k-1 and k; from one suffix to the next it falls by 1 at most."""
    n = len(ids)
    out = np.zeros(n + 1, np.int64)
    x, at, place, lcp = memoryview(np.ascontiguousarray(ids, np.int64)), memoryview(order), memoryview(rank), memoryview(out)
    h = 0
    for i in range(n):
        k = place[i]
        if not k:
            h = 0
            continue
        j = at[k - 1]
        most = n - (i if i > j else j)
        while h < most and x[i + h] == x[j + h]:
            h += 1
        lcp[k] = h
        if h:
            h -= 1
    return out


class Node:
    """The positions below an LCP interval: all in order, and by the word to their left."""

    __slots__ = ("all", "left")

    def __init__(self, position: int, word: int):
        self.all = [position]
        self.left = {word: [position]}

    def pairs(self, other: Node, depth: int) -> Iterator[tuple[int, int]]:
        """Positions of the two nodes at most `depth` apart whose left words differ; `other` is the smaller node.

        A position looks into the classes of other words, or, if fewer positions than classes lie near, at those.
        """
        if len(self.left) == 1 == len(other.left) and self.left.keys() == other.left.keys():
            return
        for word, positions in other.left.items():
            for p in positions:
                lo, hi = bisect_left(self.all, p - depth), bisect_right(self.all, p + depth)
                if hi - lo <= len(self.left):
                    own = self.left.get(word, ())
                    for q in self.all[lo:hi]:
                        k = bisect_left(own, q)
                        if k == len(own) or own[k] != q:
                            yield p, q
                    continue
                for others, at in self.left.items():
                    if others != word:
                        for q in at[bisect_left(at, p - depth):bisect_right(at, p + depth)]:
                            yield p, q

    def take(self, other: Node) -> None:
        """Join the smaller node `other`: lists are merged in order, class by class."""
        for mine, more in ((self.all, other.all), *((self.left.setdefault(w, []), p) for w, p in other.left.items())):
            if len(more) == 1:
                insort(mine, more[0])
            else:
                mine += more
                mine.sort()  # two ordered stretches: merged in one pass


def maximal_pairs(ids: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, length): equal stretches at i < j that neither side can widen, not longer apart than they are long, of together
    `least` words or more.

    Intervals are closed bottom-up on a stack. Where two children of an interval meet, their words to the right differ, so
    pairs whose words to the left differ too are maximal; the smaller child's positions are looked up in the larger one.
    Intervals of fewer than half of `least` words hold no such pair and are passed over.
    """
    order, rank = suffix_order(ids)
    lcp = common_prefixes(ids, order, rank)
    shortest = -(-least // 2)
    stack: list[tuple[int, Node]] = []

    def meet(a: Node, b: Node, depth: int) -> Iterator[tuple[int, int, int]]:
        for p, q in a.pairs(b, depth):
            if depth + abs(p - q) >= least:
                yield min(p, q), max(p, q), depth
        a.take(b)

    def joined(a: Node, b: Node) -> tuple[Node, Node]:
        return (a, b) if len(a.all) >= len(b.all) else (b, a)

    for k, position in enumerate(order.tolist()):
        behind = int(lcp[k + 1])
        if not stack and behind < shortest:
            continue
        node = Node(position, int(ids[position - 1]) if position else -1)
        while stack and stack[-1][0] > behind:
            depth, open_node = stack.pop()
            large, small = joined(open_node, node)
            yield from meet(large, small, depth)
            node = large
        if behind < shortest:
            continue  # nothing is open any more
        if stack and stack[-1][0] == behind:
            large, small = joined(stack[-1][1], node)
            yield from meet(large, small, behind)
            stack[-1] = (behind, large)
        else:
            stack.append((behind, node))


def runs_of_words(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period.

    A run of smallest period q is the maximal pair of its start and the place q further on. Pairs at a multiple of q span
    the same run, so of pairs with one span the nearest is kept.
    """
    found: dict[tuple[int, int], int] = {}
    for i, j, length in maximal_pairs(ids, least):
        span = (i, length + j - i)
        found[span] = min(found.get(span, j - i), j - i)
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda r: (r[0], r[2]))


# ---- batches of documents ----------------------------------------------------------------------------------

def may_repeat(ids: np.ndarray, where: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Numbers of the texts that may hold a run; the others hold none.

    In a run of period q, as many successive places as its equal stretch has words, less k - 1, begin a string of k words
    that stands again q places on, with k half of `least`. So the stretch of places whose strings recur has to reach over
    the nearest recurrence of its first one. Strings are compared by hash: a collision only sends a text on.
    """
    k = -(-least // 2)
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    strings = mixed(runs_of(mixed(ids.astype(np.uint64) + np.uint64(1)), k) * BASE + where[:n].astype(np.uint64))
    order = np.argsort(strings, kind="stable")
    again = strings[order[1:]] == strings[order[:-1]]
    gap = np.full(n, n + 1)
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    recurs = (gap <= n) & (where[k - 1:] == where[:n])
    stop = np.minimum.accumulate(np.where(recurs, n, np.arange(n))[::-1])[::-1]
    reach = stop - np.arange(n) + k - 1
    return np.unique(where[:n][recurs & (gap <= reach)])


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, where: np.ndarray, keep: np.ndarray, inside: np.ndarray, texts: int) -> pa.Array:
    """The kept words of each text with one space between them."""
    lengths = end - start
    kept = data[inside[data]][np.repeat(keep, lengths)]
    lengths, where = lengths[keep], where[keep]
    space = np.zeros(len(where), np.int64)
    space[:-1] = where[1:] == where[:-1]
    ahead = np.cumsum(space) - space
    out = np.full(len(kept) + int(space.sum()), 32, np.uint8)
    out[np.arange(len(kept)) + np.repeat(ahead, lengths)] = kept
    ends = np.zeros(texts + 1, np.int64)
    np.cumsum(np.bincount(where, lengths + space, texts).astype(np.int64), out=ends[1:])
    return pa.Array.from_buffers(pa.large_string(), texts, [None, pa.py_buffer(ends), pa.py_buffer(out)]).cast(pa.string())


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), text: what is left, words joined by one space.

    Words stand between ASCII white space, as they are. A run is a stretch of consecutive words with smallest period q, of at
    least `least` and 2 q words, that no neighbouring word extends; a word is dropped if a run holds it after that run's first q
    words. Each row is a document of its own, also if others share its doc_id; NULL and empty texts have no words and an
    empty text; an empty table gives no rows; other columns are ignored.

    A document is worked on by one task, in memory of some 150 bytes per word if it may hold runs, else of a few times its
    text. Nothing is shuffled, and words are compared by exact numbers.
    """
    inside = ~SPACES

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, ends in slices(batches):
            start, end, where = spans(data, ends, inside)
            ids = packed(data, start, end, inside).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            keep = np.ones(len(ids), bool)
            found: list[list] = [[] for _ in range(rows.num_rows)]
            bounds = np.searchsorted(where, np.arange(rows.num_rows + 1))
            for t in may_repeat(ids, where, least).tolist():
                a, b = int(bounds[t]), int(bounds[t + 1])
                found[t] = [{"start": s, "length": n, "period": q} for s, n, q in runs_of_words(ids[a:b], least)]
                for run in found[t]:
                    keep[a + run["start"] + run["period"]:a + run["start"] + run["length"]] = False
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(bounds)), pa.array(found, _RUN_TYPE), _joined(data, start, end, where, keep, inside, rows.num_rows)],
                ["doc_id", "n_words", "runs", "text"])

    return columns_of(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        find, f"doc_id bigint, n_words bigint, runs {RUNS}, text string")
