"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands."""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from etlkit.llm.common import SPACES, columns_of, slices, staged, text_arrays
from etlkit.llm.spans import packed, spans

CAPACITY = 4096
END_ID = 1
ISLAND_TOKENS = 2_000_000  # a problem of one group of islands: about 500 sequences
ISLANDS = 2  # populations that work on one problem and exchange their best
ROUNDS = 2
CACHE = 1_200_000  # pieces of text whose ids a worker remembers, each of at most LONGEST characters
LONGEST = 64
TEXT_BYTES = 4 << 20  # text encoded at once, or one document if it is longer
KEPT_FILL = 0.995  # sequences filled less than this are dissolved and packed again across problems


# ---- tokens ------------------------------------------------------------------------------------------------

_TAIL = ".,;:!?*$&#%|"
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")  # single letters in every form: composed, and their lower case is one letter


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte that has no visible Latin-1 character as the next free one from 256 on."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


def _parts(chunk: str) -> tuple[str, ...]:
    """Parts whose ids, one after the other, are those of the chunk, and which many chunks share: punctuation after a
    letter begins a token of its own, and the vocabulary has lower case only."""
    stem = chunk.rstrip(_TAIL)
    if not stem or not stem[-1].isalpha() or len(stem[-1].lower()) > 1:  # a letter whose lower case ends in a mark
        return (chunk,)
    tail = chunk[len(stem):]
    if _LETTERS.fullmatch(stem) or stem.isascii() and "<" not in stem:  # else lower case may differ, or a special token be meant
        stem = stem.lower()
    return (stem, tail) if tail else (stem,)


class Encoder:
    """Token ids of whole texts. White space ends every token of the vocabulary and is dropped, so a text is encoded
    as its chunks between ASCII white space, each different one of a call once. Ids of chunks and parts are remembered: those
    not asked for while CACHE / 2 others came are forgotten. Words of Latin letters alone need no splitting and go to the
    tokenizer's model as they are; other new chunks are encoded many at a time, with a mark between them."""

    MARK = "\u2603"

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer, self.known, self.before = Tokenizer.from_file(path), {}, {}
        self.model, self.visible = self.tokenizer.model, _byte_letters()
        self.mark = self._ids(self.MARK)
        self.raw = [np.uint32(i).tobytes() for i in range(self.tokenizer.get_vocab_size())]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.visible)
        return b"".join([self.raw[t.id] for t in self.model.tokenize(word)])

    def _encode(self, chunks: list[str]) -> dict[str, bytes]:
        found = {c: self._word(c) for c in chunks if _LETTERS.fullmatch(c) and c.islower()}
        plain = [c for c in chunks if c not in found and self.MARK not in c]
        found.update((c, self._ids(c).tobytes()) for c in chunks if self.MARK in c)
        for i in range(0, len(plain), 5_000):
            part = plain[i:i + 5_000]
            ids = self._ids(f" {self.MARK} ".join(part))
            at = np.flatnonzero(ids == self.mark[0])
            for j in range(1, len(self.mark)):
                at = at[ids[np.minimum(at + j, len(ids) - 1)] == self.mark[j]]
            if len(at) != len(part) - 1:  # a chunk gave the ids of the mark
                found.update((c, self._ids(c).tobytes()) for c in part)
                continue
            raw, width = ids.tobytes(), len(self.mark)
            starts, ends = [0, *((at + width) * 4).tolist()], [*(at * 4).tolist(), len(raw)]
            found.update((c, raw[x:y]) for c, x, y in zip(part, starts, ends))
        return found

    def _recall(self, pieces) -> tuple[dict[str, bytes], list[str]]:
        """Ids of the pieces that are remembered, and the other pieces."""
        known, found, older, new = self.known.get, {}, {}, []
        for p in pieces:
            ids = known(p)
            if ids is not None:
                found[p] = ids
            elif p in self.before:
                older[p] = self.before[p]
            else:
                new.append(p)
        found.update(older)
        self._remember(older)
        return found, new

    def _remember(self, more: dict[str, bytes]) -> None:
        self.known.update((p, ids) for p, ids in more.items() if len(p) <= LONGEST)
        if len(self.known) > CACHE // 2:
            self.known, self.before = {}, self.known

    def chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk, as the bytes of 32-bit numbers."""
        found, new = self._recall(chunks)
        if new:
            parts = [_parts(c) for c in new]
            of_part, missing = self._recall({x for p in parts for x in p})
            learnt = self._encode(missing)
            self._remember(learnt)
            of_part.update(learnt)
            whole = {c: b"".join([of_part[x] for x in p]) for c, p in zip(new, parts)}
            self._remember(whole)
            found.update(whole)
        return [found[c] for c in chunks]

    def texts(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by END_ID, one after the other, and where each begins."""
        start, end, where = spans(data, ends, ~SPACES)
        words = packed(data, start, end, ~SPACES).dictionary_encode()
        raw = self.chunks(words.dictionary.cast(pa.large_string()).to_pylist())
        size = np.array([len(x) // 4 for x in raw], np.int64)
        ids, index = np.frombuffer(b"".join(raw), np.uint32), words.indices.to_numpy(zero_copy_only=False)
        first, n = (np.cumsum(size) - size)[index], size[index]
        before = np.cumsum(n) - n
        ids = ids[np.repeat(first - before, n) + np.arange(int(n.sum()))] if len(ids) else ids
        closes = np.cumsum(np.bincount(where, n, len(ends) - 1).astype(np.int64))
        return np.insert(ids, closes, END_ID), np.concatenate([[0], closes + np.arange(1, len(ends))])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        ids, starts = self.texts(*text_arrays(pa.array(texts, pa.large_string())))
        return [ids[a:b] for a, b in zip(starts, starts[1:])]


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker: later tasks find what earlier ones have learnt."""
    import tokenizers
    kept = vars(tokenizers).setdefault("_etlkit_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def pieces_of(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and END_ID, cut only where over CAPACITY."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        encode = encoder(tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))
        for rows, data, ends in slices(batches, size=TEXT_BYTES):
            ids, starts = encode.texts(data, ends)
            n = np.diff(starts)
            pieces = -(-n // CAPACITY)
            of = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            length = np.minimum(n[of] - piece * CAPACITY, CAPACITY)
            raw, at = memoryview(ids.astype("<u4").tobytes()), (starts[of] + piece * CAPACITY) * 4
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + length * 4).tolist())]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(piece * CAPACITY),
                                              pa.array(length), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return columns_of(docs, "doc_id", "text").mapInArrow(each, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


# ---- packing -----------------------------------------------------------------------------------------------

def best_fit(items, lengths, bins: list[list[int]], room: list[int]) -> None:
    """Put each item, longest first, where it leaves least room; `bins` and `room` change in place."""
    free = sorted((r, b) for b, r in enumerate(room))
    for i in sorted(items, key=lambda i: -lengths[i]):
        at = bisect_left(free, (lengths[i], -1))
        if at == len(free):
            bins.append([i])
            room.append(CAPACITY - lengths[i])
            b = len(bins) - 1
        else:
            _, b = free.pop(at)
            bins[b].append(i)
            room[b] -= lengths[i]
        if room[b]:
            insort(free, (room[b], b))


def fitness(bins, lengths) -> float:
    """Mean squared fill: few sequences, and full ones beside emptier ones, are worth more."""
    return sum((sum(lengths[i] for i in b) / CAPACITY) ** 2 for b in bins) / max(1, len(bins))


def crossover(mother, father, lengths, rng) -> list[list[int]]:
    """Whole well-filled sequences of one parent enter the other; what they duplicate goes, what that displaces is best-fitted."""
    filled = sorted(father, key=lambda b: -sum(lengths[i] for i in b))
    some = [b for b in filled[:max(1, len(filled) // 2)] if rng.random() < 0.5]
    inside = {i for b in some for i in b}
    kept = [b for b in mother if inside.isdisjoint(b)]
    displaced = [i for b in mother if not inside.isdisjoint(b) for i in b if i not in inside]
    return repacked(kept + some, displaced, lengths, rng)


def repacked(bins, displaced, lengths, rng, share: float = 0.04):
    """Also dissolve a few of the worst-filled sequences before items without a place are best-fitted."""
    order = sorted(bins, key=lambda b: sum(lengths[i] for i in b))
    n = min(len(order), 1 + int(len(order) * share * rng.random()))
    out = [list(b) for b in order[n:]]
    loose = displaced + [i for b in order[:n] for i in b]
    best_fit(loose, lengths, out, [CAPACITY - sum(lengths[i] for i in b) for b in out])
    return out


def evolve(lengths: list[int], start: list[list[list[int]]], seed: int, size: int = 4, generations: int = 6) -> list[list[int]]:
    """The best packing a population reaches; stops early at the least number of sequences there can be."""
    rng = random.Random(seed)
    least = -(-sum(lengths) // CAPACITY)
    people = list(start)
    while len(people) < size:
        bins: list[list[int]] = []
        order = list(range(len(lengths)))
        if people:  # others start from a part packed at random
            rng.shuffle(order)
            head = order[:len(order) // 4]
            for i in head:
                if bins and rng.random() < 0.9 and sum(lengths[j] for j in bins[-1]) + lengths[i] <= CAPACITY:
                    bins[-1].append(i)
                else:
                    bins.append([i])
            order = order[len(head):]
        best_fit(order, lengths, bins, [CAPACITY - sum(lengths[i] for i in b) for b in bins])
        people.append(bins)
        if len(bins) <= least:
            break
    worth = [fitness(p, lengths) for p in people]
    for _ in range(generations):
        best = max(range(len(people)), key=worth.__getitem__)
        if len(people[best]) <= least or len(people) < 2:
            break
        father = people[rng.randrange(len(people))]
        child = crossover(people[best], father, lengths, rng)
        w = fitness(child, lengths)
        worst = min(range(len(people)), key=worth.__getitem__)
        if w > worth[worst]:
            people[worst], worth[worst] = child, w
    return people[max(range(len(people)), key=worth.__getitem__)]


def _pack_problem(rows: pd.DataFrame, seed: int) -> list[list[int]]:
    """The packing of one island in one round: its own best so far and its neighbour's elite are the first people."""
    lengths = rows["length"].tolist()
    start = []
    for column in ("mine", "elite"):
        if column in rows and (rows[column] >= 0).all():
            groups: dict[int, list[int]] = {}
            for i, b in enumerate(rows[column].tolist()):
                groups.setdefault(b, []).append(i)
            start.append(list(groups.values()))
    return evolve(lengths, start, seed)


def _bins_of(packing, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for b, items in enumerate(packing):
        out[items] = b
    return out


def _solve(pieces: DataFrame, problems: int, name: str) -> DataFrame:
    """pieces (key, length) with problem and bin. Each problem is packed by ISLANDS islands; after a round each
    passes its packing on to the next island (elite migration), and the best of the last round counts."""
    keyed = pieces.withColumn("problem", F.pmod(F.xxhash64(F.col("key"), F.lit(name)), F.lit(problems)))
    out = "key long, length long, problem long, island int, bin long, worth double"

    def island_round(seed):
        def each(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("key", ignore_index=True)
            island = int(rows["island"].iloc[0])
            packing = _pack_problem(rows, seed * 1000 + island)
            lengths = rows["length"].tolist()
            return rows[["key", "length", "problem", "island"]].assign(bin=_bins_of(packing, len(rows)), worth=fitness(packing, lengths) - len(packing) * 1e3)
        return each

    state = keyed.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    for r in range(ROUNDS):
        state = staged(state.groupBy("problem", "island").applyInPandas(island_round(r), out), f"{name}-islands")
        if r + 1 < ROUNDS:
            passed = state.select("key", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), F.col("bin").alias("elite"))
            state = state.join(passed, ["key", "island"]).select("key", "length", "problem", "island", F.col("bin").alias("mine"), "elite")
    best = state.groupBy("problem").agg(F.max_by("island", F.struct("worth", -F.col("island"))).alias("island"))
    return state.join(best, ["problem", "island"]).select("key", "length", "problem", "bin")


def pack(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (gapless from 0 within a sequence).

    Pieces are dealt by hash to problems of about ISLAND_TOKENS tokens, and each problem is packed by its islands. The
    sequences that stay filled below KEPT_FILL, a few per problem, are dissolved, and their pieces are dealt to
    fewer problems and packed again; this repeats until the rest is one problem's worth. NULL texts count as empty
    and hold END_ID alone; repeated documents are packed once each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = staged(pieces_of(docs, tokenizer_path).withColumn("key", F.monotonically_increasing_id()), "pieces")
    left, placed, level = pieces.select("key", "length"), [], 0
    while True:
        tokens = left.agg(F.sum("length")).first()[0] or 0
        problems = max(1, round(tokens / ISLAND_TOKENS))
        solved = staged(_solve(left, problems, f"pack-{level}"), "solved").withColumn("level", F.lit(level))
        if problems == 1 or level == 6:
            placed.append(solved)
            break
        fill = solved.groupBy("problem", "bin").agg(F.sum("length").alias("fill"))
        full = fill.where(F.col("fill") >= KEPT_FILL * CAPACITY).select("problem", "bin")
        placed.append(solved.join(full, ["problem", "bin"]))
        left = staged(solved.join(full, ["problem", "bin"], "left_anti").select("key", "length"), "left")
        level += 1
    where = placed[0]
    for more in placed[1:]:
        where = where.unionByName(more)
    sequence = (F.col("level").cast("long") * (1 << 56) + F.col("problem") * (1 << 20) + F.col("bin")).alias("sequence_id")
    inside = Window.partitionBy("sequence_id").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    offsets = where.select("key", "length", sequence).select("key", "sequence_id", F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))
    return pieces.join(offsets, "key").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
