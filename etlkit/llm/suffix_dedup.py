"""Removal of byte strings that an earlier document holds: sampled suffixes sorted by hashes, in rounds over chunks."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.llm.chunks import LAST, Chunks, answered, parts_for
from etlkit.llm.common import CACHED, prefix_hashes, span_hashes, staged, window_hashes

LENGTH = 50  # bytes
SEED = 24  # a window of LENGTH bytes is looked up by the seed of SEED bytes with the least hash in it
REACH = LENGTH - SEED + 1


class Windows:
    """The windows of LENGTH bytes of a chunk's texts, and the seed each is looked up by."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, data: np.ndarray):
        self.ids, self.ends, self.data = ids, ends, data
        self.prefix = prefix_hashes(data)
        seeds = window_hashes(self.prefix, SEED)
        least = least_places(seeds)
        size = np.maximum(np.diff(ends) - LENGTH + 1, 0)
        self.of = np.repeat(np.arange(len(ids)), size)
        self.start = np.arange(len(self.of)) + np.repeat(ends[:-1] - np.cumsum(size) + size, size)
        place = least[self.start]
        # Successive windows of one text with one seed form a block: they cover one string around the seed.
        head = np.ones(len(place), bool)
        head[1:] = (place[1:] != place[:-1]) | (self.of[1:] != self.of[:-1])
        first = np.flatnonzero(head)
        self.first, self.windows = first, np.diff(np.append(first, len(place)))
        self.seed = seeds[place[first]] if len(first) else np.zeros(0, np.uint64)
        self.block_of = self.of[first]
        self.block = span_hashes(self.prefix, self.start[first], self.start[first] + self.windows - 1 + LENGTH) if len(first) else np.zeros(0, np.uint64)

    def hashes(self, windows: np.ndarray) -> np.ndarray:
        return span_hashes(self.prefix, self.start[windows], self.start[windows] + LENGTH)

    def of_blocks(self, blocks: np.ndarray) -> np.ndarray:
        """Numbers of the windows of the given blocks."""
        n = self.windows[blocks]
        return np.repeat(self.first[blocks] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(blocks) else np.zeros(0, np.int64)


def least_places(seeds: np.ndarray) -> np.ndarray:
    """Place of the least seed among each REACH successive ones. Seeds are compared by their upper 48 bits; the first counts on ties,
    so equal strings have it at the same place in them."""
    n, low = max(0, len(seeds) - REACH + 1), np.uint64(0xFFFF)
    out, place = np.empty(n, np.int64), np.arange(CACHED + REACH - 1, dtype=np.uint64)
    for i in range(0, n, CACHED):
        least = seeds[i:i + CACHED + REACH - 1] & ~low
        least |= place[:len(least)]
        width = 1
        while width < REACH:  # the least of `width` seeds, then of twice as many
            step = min(width, REACH - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        least &= low
        out[i:i + CACHED] = least
        out[i:i + CACHED] += i
    return out


def earliest(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the least document of each, and the position of every row's key among them."""
    unique, where = np.unique(keys, return_inverse=True)
    low = np.full(len(unique), LAST, np.int64)
    np.minimum.at(low, where, docs)
    return unique, low, where


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted array `known`."""
    at = np.searchsorted(known, values)
    return known[np.minimum(at, len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)


def dealt(keys: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    part = (keys % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    return [(p, order[a:b]) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]


def _raw(*arrays: np.ndarray) -> bytes:
    return len(arrays[0]).to_bytes(8, "little") + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _read(data: bytes, *kinds) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _listed(answers: list[bytes], *kinds) -> list[np.ndarray]:
    read = [_read(a, *kinds) for a in answers]
    return [np.concatenate([r[i] for r in read]) if read else np.zeros(0, k) for i, k in enumerate(kinds)]


# ---- round 1: which seeds occur in several documents -------------------------------------------------------

def _seeds(parts):
    def ask(ids, ends, data, _):
        w = Windows(ids, ends, data)
        seeds, low, where = earliest(w.seed, ids[w.block_of])
        several = np.zeros(len(seeds), np.uint8)
        several[where[ids[w.block_of] != low[where]]] = 1
        return {p: _raw((seeds[i] >> np.uint64(24)).astype(np.uint32), (seeds[i] >> np.uint64(56)).astype(np.uint8), several[i]) for p, i in dealt(seeds, parts)}
    return ask


def _same_seeds(blobs):
    rows = [_read(b, np.uint32, np.uint8, np.uint8) for b in blobs]
    keys = [lo.astype(np.uint64) | hi.astype(np.uint64) << np.uint64(32) for lo, hi, _ in rows]
    unique, n = np.unique(np.concatenate(keys), return_counts=True)
    repeated = np.union1d(unique[n > 1], np.concatenate([k[r[2] > 0] for k, r in zip(keys, rows)]))
    return ((i, _raw(k[among(k, repeated)])) for i, k in enumerate(keys))


def _short(seeds: np.ndarray) -> np.ndarray:
    return seeds >> np.uint64(24)


# ---- round 2: blocks around these seeds --------------------------------------------------------------------

def _candidates(w: Windows, answers: list[bytes]):
    """Blocks whose seed is repeated: numbers, and the first of equal blocks in the chunk with its document."""
    (repeated,) = _listed(answers, np.uint64)
    blocks = np.flatnonzero(among(_short(w.seed), np.sort(repeated)))
    unique, low, where = earliest(w.block[blocks], w.ids[w.block_of[blocks]])
    return blocks, unique, low, where


def _blocks(parts):
    def ask(ids, ends, data, answers):
        w = Windows(ids, ends, data)
        blocks, unique, low, where = _candidates(w, answers)
        seed = np.zeros(len(unique), np.uint64)
        seed[where] = _short(w.seed[blocks])
        return {p: _raw(seed[i], unique[i], low[i]) for p, i in dealt(seed, parts)}
    return ask


COVERED, OPEN = 1, 2


def _same_blocks(blobs):
    """For each chunk's blocks: COVERED if an earlier document has the same, OPEN if its first and the seed has other blocks."""
    rows = [_read(b, np.uint64, np.uint64, np.int64) for b in blobs]
    seed, block, doc = (np.concatenate([r[i] for r in rows]) for i in range(3))
    unique, low, where = earliest(block, doc)
    of_seed = np.zeros(len(unique), np.uint64)
    of_seed[where] = seed
    seeds, kinds = np.unique(of_seed, return_counts=True)
    various = kinds[np.searchsorted(seeds, seed)] > 1
    code = np.where(doc > low[where], COVERED, np.where(various, OPEN, 0)).astype(np.uint8)
    at = 0
    for i, r in enumerate(rows):
        mine = code[at:at + len(r[0])]
        if mine.any():
            yield i, _raw(r[1][mine > 0], mine[mine > 0])
        at += len(r[0])


# ---- round 3: windows of blocks that differ ----------------------------------------------------------------

def _opened(w: Windows, block: np.ndarray, code: np.ndarray):
    """Numbers of the windows to ask for: those of the first occurrence, in the chunk, of each open block."""
    wanted = block[code == OPEN]
    unique, low, where = earliest(w.block, w.ids[w.block_of])
    first = np.flatnonzero(among(w.block, np.sort(wanted)) & (w.ids[w.block_of] == low[where]))
    return w.of_blocks(first)


def _strings(parts):
    def ask(ids, ends, data, answers):
        w = Windows(ids, ends, data)
        windows = _opened(w, *_listed(answers, np.uint64, np.uint8))
        unique, low, _ = earliest(w.hashes(windows), ids[w.of[windows]])
        return {p: _raw(unique[i], low[i]) for p, i in dealt(unique, parts)}
    return ask


def _same_strings(blobs):
    rows = [_read(b, np.uint64, np.int64) for b in blobs]
    unique, low, where = earliest(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]))
    at = 0
    for i, (key, doc) in enumerate(rows):
        first = low[where[at:at + len(key)]]
        if (doc > first).any():
            yield i, _raw(key[doc > first], first[doc > first])
        at += len(key)


# ---- result ------------------------------------------------------------------------------------------------

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text binary"


def removed_bytes(w: Windows, tagged: list[bytes]) -> np.ndarray:
    """Which bytes of the chunk are covered by a window that an earlier document has."""
    repeated = _listed([a[1:] for a in tagged if a[:1] == b"1"], np.uint64)
    blocks, code = _listed([a[1:] for a in tagged if a[:1] == b"2"], np.uint64, np.uint8)
    strings, _ = _listed([a[1:] for a in tagged if a[:1] == b"3"], np.uint64, np.int64)
    found = np.flatnonzero(among(_short(w.seed), np.sort(repeated[0])))
    unique, low, where = earliest(w.block[found], w.ids[w.block_of[found]])
    later = w.ids[w.block_of[found]] > low[where]
    covered = found[later | among(w.block[found], np.sort(blocks[code == COVERED]))]
    windows = [w.of_blocks(covered)]
    opened = _opened(w, blocks, code)
    # The same strings in the chunk itself, and in other chunks.
    keys = w.hashes(opened)
    if len(keys):
        _, first, at = earliest(keys, w.ids[w.of[opened]])
        windows.append(opened[(w.ids[w.of[opened]] > first[at]) | among(keys, np.sort(strings))])
    marks = np.zeros(len(w.data) + 1, np.int64)
    starts = w.start[np.concatenate(windows).astype(np.int64)]
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + LENGTH, -1)
    return np.cumsum(marks[:-1]) > 0


def _result(ids, ends, data, tagged):
    gone = removed_bytes(Windows(ids, ends, data), tagged)
    head = gone.copy()
    head[1:] &= ~gone[:-1]
    starts = ends[:-1][ends[:-1] < len(data)]
    head[starts] = gone[starts]
    total, heads = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(head)])
    kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(ends, ends[1:])]
    return pa.RecordBatch.from_arrays([
        pa.array(ids, mask=ids == LAST), pa.array(np.diff(ends)), pa.array(total[ends[1:]] - total[ends[:-1]]), pa.array(heads[ends[1:]] - heads[ends[:-1]]),
        pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])


def remove_repeated_strings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (remaining bytes).

    A byte goes if a string of LENGTH bytes that covers it also starts in a document with a smaller id. Any two equal
    strings share their least seed, so: chunks first learn which seeds several documents have, then compare the blocks
    of windows around these seeds, and last, where the blocks of a seed differ, single windows. Strings are compared
    by 64-bit hashes; equal strings of a chunk are reduced to their first before they are sent, so a string that a
    third of all documents has arrives once per chunk. NULL texts count as empty, NULL ids stand after all others;
    rows that share an id never remove each other's bytes; an empty table gives no rows; other columns are ignored.
    """
    chunks = Chunks(docs, "suffixes")
    parts = parts_for(chunks.count, 1 << 20)
    tag = lambda df, k: df.select("chunk", F.concat(F.lit(k).cast("binary"), F.col("data")).alias("data"))
    seeds = staged(answered(chunks.ask(_seeds(parts), None, parts), _same_seeds), "seeds")
    blocks = staged(answered(chunks.ask(_blocks(parts), seeds, parts), _same_blocks), "blocks")
    strings = staged(answered(chunks.ask(_strings(parts), blocks, parts), _same_strings), "strings")
    return chunks.finish(_result, SCHEMA, tag(seeds, "1").union(tag(blocks, "2")).union(tag(strings, "3")))
