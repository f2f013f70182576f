"""Benchmark decontamination: latent semantic retrieval of passages, then common subsequences and answers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.llm.common import added_up, array_rows, columns_of, released, slices, staged, words_of

TERMS = 1 << 14  # hashed words
RANK = 64
STEP = 12  # words; a passage is two successive steps
COSINE = 0.45
# Steps of passages and their least cosine: items that would be a small part of a passage are compared with shorter ones.
KINDS = {"long": (STEP, COSINE), "short": (6, 0.35), "tiny": (3, 0.35)}
LCS_ALONE, LCS_WITH_ANSWER, ANSWER_SHARE = 0.7, 0.5, 0.75
ANSWER = 8  # last words of an item
SIGNS, BLOCK = 8, 8  # 64-bit words of a bit set, words of a block that has one
PRODUCTS = 1 << 21  # cosines whose hits are judged at once
CLOSE = 1 << 18  # cosines held at once
ROWS = 256  # steps summed at once
UPPER = 18  # bits of a hash by which its word is looked up
TURNS = 4  # tasks a core in the pass that puts out a matrix per task
ITEMS = 5000  # benchmark items that are sent to all tasks at once

_BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _terms(data, ends):
    hashes, where, _, _ = words_of(data, ends, between=_BETWEEN)
    return hashes, (hashes >> np.uint64(50)).astype(np.int64), where


def _steps(where: np.ndarray, n: int, words: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """First word of each step of `words` words, and the text of each step. The last step of a text may be shorter."""
    first = np.searchsorted(where, np.arange(n))
    place = np.arange(len(where)) - first[where]
    heads = np.flatnonzero(place % words == 0)
    return heads, where[heads]


def _closed(table: np.ndarray) -> np.ndarray:
    """The table with a row of zeros behind it."""
    return np.concatenate([table, np.zeros((1, table.shape[1]), table.dtype)])


def _sums(table: np.ndarray, term: np.ndarray, heads: np.ndarray, words: int) -> np.ndarray:
    """Sums of the rows of `table` over each step: `heads` are the first words of steps of at most `words` words."""
    return _closed_sums(_closed(table), term, heads, words)


def _closed_sums(table: np.ndarray, term: np.ndarray, heads: np.ndarray, words: int) -> np.ndarray:
    """`_sums` of a closed table, which is closed once for many texts. ROWS steps at a time stay in a core's cache."""
    end = np.append(heads[1:], len(term))
    out, rows = np.empty((len(heads), table.shape[1]), table.dtype), np.empty((min(ROWS, len(heads)), table.shape[1]), table.dtype)
    for lo in range(0, len(heads), ROWS):
        part, at, to = out[lo:lo + ROWS], heads[lo:lo + ROWS], end[lo:lo + ROWS]
        np.take(table, term[at], axis=0, out=part, mode="clip")
        for j in range(1, words):
            places = np.where(at + j < to, term[np.minimum(at + j, len(term) - 1)], len(table) - 1)
            part += np.take(table, places, axis=0, out=rows[:len(part)], mode="clip")
    return out


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """log((1 + steps) / (1 + steps with the term)), counted over all texts."""
    def each(batches):
        counts, steps = np.zeros(TERMS), 0
        for rows, data, ends in slices(batches):
            _, term, where = _terms(data, ends)
            heads, _ = _steps(where, rows.num_rows)
            place = np.arange(len(term)) - np.repeat(heads, np.diff(heads, append=len(term)))  # within its step
            term, fresh = term.astype(np.int32), np.ones(len(term), bool)
            for j in range(1, STEP):
                fresh[j:] &= (term[j:] != term[:-j]) | (place[j:] < j)
            counts += np.bincount(term[fresh], minlength=TERMS)
            steps += len(heads)
        yield array_rows({0: counts, 1: np.array([steps])})

    counts, (steps,) = added_up(docs.mapInArrow(each, "part int, data binary"), [(TERMS,), (1,)], "terms")
    return np.log((1 + steps) / (1 + counts)) + 1e-3


def latent_axes(docs: DataFrame, idf: np.ndarray, seed: int = 5) -> np.ndarray:
    """TERMS x RANK matrix that takes TF-IDF vectors to whitened coordinates on the main right singular vectors.

    Randomised SVD in one pass: with A the passages' TF-IDF rows and random R, tasks add up their part of A'(A R), a
    matrix of fixed size; the driver completes the Nystrom factorisation of A'A from it. Texts in many small files are read by no
    more than TURNS tasks a core, so the matrices do not outgrow the texts.
    """
    random = np.random.default_rng(seed).normal(size=(TERMS, RANK))
    shared = docs.sparkSession.sparkContext.broadcast((idf[:, None] * random).astype(np.float32))

    def each(batches):
        weighted, total = _closed(shared.value), np.zeros((RANK, TERMS))
        for rows, data, ends in slices(batches):
            _, term, where = _terms(data, ends)
            if not len(term):
                continue
            heads, _ = _steps(where, rows.num_rows)
            projected = _closed_sums(weighted, term, heads, STEP).T.astype(np.float64, order="C")
            step = np.repeat(np.arange(len(heads)), np.diff(heads, append=len(term)))
            weights = np.empty(len(step))
            for k in range(RANK):
                total[k] += np.bincount(term, np.take(projected[k], step, out=weights, mode="clip"), TERMS)
        yield array_rows({0: (total.T * idf[:, None]).astype(np.float32)})

    (product,) = added_up(docs.coalesce(TURNS * docs.sparkSession.sparkContext.defaultParallelism).mapInArrow(each, "part int, data binary"), [(TERMS, RANK)], "axes", single=True)
    core = random.T @ product
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(), 0) * 1e-9
    if not good.any():
        return np.zeros((TERMS, RANK))
    left, singular, _ = np.linalg.svd(product @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return left / np.maximum(singular, singular.max() * 1e-6)


def longest_common(item: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence, by bits."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    whole = state = (1 << len(item)) - 1
    for w in words:
        u = state & masks.get(w, 0)
        state = ((state + u) | (state - u)) & whole
    return len(item) - state.bit_count()


def _passages(vectors: np.ndarray, of: np.ndarray):
    """Sums of two successive steps of one text (or its only step), of length 1, and the first step of each."""
    last = np.ones(len(of), bool)
    last[:-1] = of[1:] != of[:-1]
    first = np.ones(len(of), bool)
    first[1:] = of[1:] != of[:-1]
    at = np.flatnonzero(~last | first)
    out = np.empty((len(at), vectors.shape[1]), vectors.dtype)
    for lo in range(0, len(at), ROWS):
        here = at[lo:lo + ROWS]
        two = np.take(vectors, here, axis=0)
        more = np.take(vectors, here + 1, axis=0, mode="clip")
        more[last[here]] = 0
        two += more
        norm = np.sqrt((two ** 2).sum(1, keepdims=True))
        np.divide(two, np.maximum(norm, 1e-30), out=out[lo:lo + ROWS])
    return out, at


def word_bits(known: int) -> np.ndarray:
    """Sets of word numbers below `known` are bit sets, in which words may share a bit. A row for each word, the last for none."""
    bits = np.zeros((known + 1, SIGNS), np.uint64)
    at = np.arange(known) % (64 * SIGNS)
    bits[np.arange(known), at // 64] = np.uint64(1) << (at % 64).astype(np.uint64)
    return bits


def item_signs(numbers: list[np.ndarray], bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the whole items and for their answers: a bit set, and the words that have no bit of their own in it."""
    signs, slack = np.zeros((2, len(numbers), SIGNS), np.uint64), np.zeros((2, len(numbers)), np.int64)
    for k, item in enumerate(numbers):
        for part, words in enumerate((item, item[-ANSWER:])):
            signs[part, k] = np.bitwise_or.reduce(bits[words], axis=0)
            slack[part, k] = len(words) - np.bitwise_count(signs[part, k]).sum()
    return signs, slack


class Vocabulary:
    """Numbers of words by their hashes: places in the sorted array `known`, or its length for others."""

    def __init__(self, known: np.ndarray):
        self.known = np.append(known, np.uint64(0))
        self.n, self.shift = len(known), np.uint64(64 - UPPER)
        self.first = np.searchsorted(known >> self.shift, np.arange((1 << UPPER) + 1, dtype=np.uint64)).astype(np.int32)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        upper = (hashes >> self.shift).astype(np.int64)
        out = np.take(self.first, upper).astype(np.int64)
        other = np.flatnonzero(np.take(self.known, out) != hashes)
        several = np.take(self.first, upper[other] + 1) - out[other] > 1  # known words with the same upper bits
        out[other] = self.n
        other = other[several]
        at = np.searchsorted(self.known[:-1], hashes[other])
        out[other] = np.where(self.known[at] == hashes[other], at, self.n)
        return out


class Regions:
    """Bit sets of the words of any stretch of the texts: those of blocks of BLOCK words, and of 2, 4, 8, ... such blocks."""

    def __init__(self, word: np.ndarray, bits: np.ndarray, widest: int):
        rows = np.append(word, np.full(-len(word) % BLOCK, len(bits) - 1)).reshape(-1, BLOCK)
        level = bits[rows[:, 0]]
        for j in range(1, BLOCK):
            level |= bits[rows[:, j]]
        self.levels = [level]
        while 1 << len(self.levels) <= widest // BLOCK + 2:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            level = last.copy()
            level[:-half] |= last[half:]
            self.levels.append(level)
        self.n = len(level)
        self.flat = np.concatenate(self.levels)
        self.level_of = np.frexp(np.arange(1 << len(self.levels)).astype(np.float64))[1] - 1  # by the number of blocks

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Bit sets of the words from `start` up to `end`, and of some around them."""
        a, b = start // BLOCK, np.maximum(end - 1, start) // BLOCK + 1
        level = self.level_of[b - a]
        return self.flat[level * self.n + a] | self.flat[level * self.n + b - (1 << level)]


def item_block(ids: list, texts: list[str], axes: np.ndarray) -> dict:
    """A block of benchmark items as plain arrays: their words, and the vectors of their passages.

    Passages begin at each half step, so that one of them fits the steps of any text. Items that do not fill a long passage are
    `short`, those with fewer words than an answer `tiny`.
    """
    raw = [(t or "").encode() for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    hashes, term, where = _terms(np.frombuffer(b"".join(raw), np.uint8), ends)
    bounds = np.searchsorted(where, np.arange(len(ids) + 1))
    words = [hashes[a:b] for a, b in zip(bounds, bounds[1:])]
    out = {"ids": ids, "words": words, "vocabulary": np.unique(hashes)}
    kinds = ["long" if len(w) >= 2 * STEP else "short" if len(w) >= ANSWER else "tiny" if len(w) else None for w in words]
    for name, (step, _) in KINDS.items():
        starts = [(k, s) for k, w in enumerate(words) if kinds[k] == name for s in range(0, max(1, len(w) - 2 * step + step // 2), step // 2)]
        vectors = np.array([axes[term[bounds[k] + s:min(bounds[k] + s + 2 * step, bounds[k + 1])]].sum(0) for k, s in starts]).reshape(-1, axes.shape[1])
        out[name] = ((vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-30)).astype(np.float32),
                     np.array([k for k, _ in starts], np.int64), np.array([s for _, s in starts], np.int64))
    return out


def common_lengths(item: np.ndarray, regions: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """`longest_common` of one item with many regions at once: rows of word numbers, the last number for no word of the item.

    Item and regions hold numbers below len(masks); `masks` is all zero and is left so. Items of more than 64 words are
    taken one region at a time.
    """
    if len(item) > 64:
        words = item.tolist()
        return np.array([longest_common(words, r) for r in regions.tolist()], np.int64)
    np.bitwise_or.at(masks, item, np.uint64(1) << np.arange(len(item), dtype=np.uint64))
    bits = masks[regions]
    masks[item] = 0
    whole = np.uint64((1 << len(item)) - 1)
    state = np.full(len(regions), whole)
    for column in bits.T:
        u = state & column
        state = ((state + u) | (state - u)) & whole
    return len(item) - np.bitwise_count(state).astype(np.int64)


def verdicts(item: np.ndarray, regions: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each region: share of the item's words in common order, share of its answer (last words), and whether that is a leak."""
    share = common_lengths(item, regions, masks) / len(item)
    told, leak = np.zeros(len(regions)), np.zeros(len(regions), bool)
    some = np.flatnonzero(share >= LCS_WITH_ANSWER)
    answer = item[-ANSWER:]
    told[some] = common_lengths(answer, regions[some], masks) / len(answer)
    if len(item) < ANSWER:
        whole = np.flatnonzero(share == 1)
        if len(whole) and regions.shape[1] >= len(item):
            runs = np.lib.stride_tricks.sliding_window_view(regions[whole], len(item), axis=1)
            leak[whole] = (runs == item).all(2).any(1)
    else:
        leak[some] = (share[some] >= LCS_ALONE) | (told[some] >= ANSWER_SHARE)
    return share, told, leak


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, lcs_share, answer_share: documents that hold a benchmark item, also in other words.

    Words are runs of letters and digits, A-Z in lower case. Passages of 2 * STEP words, every STEP words, of all texts
    are compared in the latent space with all passages of the items; items of fewer words than that, which would be a small
    part of a passage, with shorter passages (KINDS). From a least cosine on the item's longest common
    subsequence with the words around the passage decides, alone or together with the answer. Items of fewer words
    than an answer must occur whole, word after word. Benchmark items go to the tasks in blocks of at most ITEMS, as many passes as it
    takes. NULL and empty texts and items give nothing; rows that share an id are searched like others; without
    documents or items there are no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    docs, benchmark = columns_of(docs, "doc_id", "text"), columns_of(benchmark, "item_id", "text")
    idf = inverse_frequencies(docs)
    axes = idf[:, None] * latent_axes(docs, idf)
    released(spark)
    schema = f"doc_id {kind}, item_id {item_kind}, cosine double, lcs_share double, answer_share double"
    found = spark.createDataFrame([], schema)
    blocks = -(-benchmark.count() // ITEMS)
    for block in range(blocks):
        rows = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast((axes.astype(np.float32), item_block([r[0] for r in rows], [r[1] for r in rows], axes)))
        found = found.unionByName(staged(docs.mapInArrow(_search(shared), schema), "leaks"))
    return found


def _search(shared):
    def each(batches):
        axes, items = shared.value
        axes = _closed(axes)
        vocabulary = items["vocabulary"]
        known_words = Vocabulary(vocabulary)
        masks = np.zeros(len(vocabulary) + 1, np.uint64)
        numbers = [np.searchsorted(vocabulary, w) for w in items["words"]]
        bits, size = word_bits(len(vocabulary)), np.array([len(x) for x in numbers])
        signs = item_signs(numbers, bits)
        for rows, data, ends in slices(batches):
            hashes, term, where = _terms(data, ends)
            if not len(term) or not len(vocabulary):
                continue
            word = np.append(known_words(hashes), len(vocabulary))  # a place outside every text
            bounds = np.searchsorted(where, np.arange(rows.num_rows + 1))
            regions = Regions(word, bits, int(size.max()) + 2 * STEP)
            best: dict = {}
            sums: dict = {}
            for kind, (step, least) in sorted(KINDS.items(), key=lambda x: x[1]):
                known, of_item, at_item = items[kind]
                if not len(known):
                    continue
                heads, of = _steps(where, rows.num_rows, step)
                if step // 2 in sums:  # two steps of half the length, or one where the text ends
                    half, half_heads = sums[step // 2]
                    at = np.searchsorted(half_heads, heads)
                    sums[step] = half[at], heads
                    two = np.diff(at, append=len(half)) > 1
                    sums[step][0][two] += half[at[two] + 1]
                else:
                    sums[step] = _closed_sums(axes, term, heads, step), heads
                vectors, at = _passages(sums[step][0], of)
                at_once = max(1, PRODUCTS // len(known))
                for lo in range(0, len(vectors), at_once):
                    cosine, p, q = _near(vectors[lo:lo + at_once], known, least)
                    place, item, text = heads[at[p + lo]] - at_item[q], of_item[q], of[at[p + lo]]
                    kept = _may_leak(regions, np.maximum(place - STEP, bounds[text]), np.minimum(place + size[item] + STEP, bounds[text + 1]), item, size, *signs)
                    _compare(best, cosine[kept], item[kept], text[kept], place[kept], bounds, word, numbers, masks)
            if best:
                pairs = list(best)
                found = np.array([best[x] for x in pairs])
                ids = pa.array([items["ids"][k] for _, k in pairs])
                yield pa.RecordBatch.from_arrays([rows.column("doc_id").take(pa.array([t for t, _ in pairs])), ids,
                                                  *[pa.array(found[:, c]) for c in range(3)]], ["doc_id", "item_id", "cosine", "lcs_share", "answer_share"])
    return each


def _near(vectors: np.ndarray, known: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a vector and a known one from a least cosine on: cosines, and the numbers of both."""
    found, at_once = [], max(1, CLOSE // len(known))
    products = np.empty((min(at_once, len(vectors)), len(known)), np.result_type(vectors, known))  # the same place again and again
    high = np.empty(-(-products.size // 8) * 8, bool)
    for lo in range(0, len(vectors), at_once):
        some = vectors[lo:lo + at_once]
        near = np.matmul(some, known.T, out=products[:len(some)]).ravel()
        np.greater_equal(near, least, out=high[:len(near)])
        high[len(near):] = False
        eights = high.view(np.uint64)  # few are high: eight at a time are passed over
        some = np.flatnonzero(eights)
        at = np.flatnonzero(eights[some].view(bool))
        hit = some[at >> 3] * 8 + (at & 7)
        found.append((near[hit], hit + lo * len(known)))
    cosine, hit = (np.concatenate(x) for x in zip(*found))
    return cosine, *np.divmod(hit, len(known))


def _may_leak(regions: Regions, start: np.ndarray, end: np.ndarray, item: np.ndarray, size: np.ndarray, signs: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """The candidates whose region holds words enough of their item and its answer, in any order: no other can be a leak."""
    held, n = regions(start, end), size[item]
    most = _bits(held & signs[0][item]) + slack[0][item]
    some = np.flatnonzero(most >= np.where(n < ANSWER, n, LCS_WITH_ANSWER * n))
    held, item, n, most = held[some], item[some], n[some], most[some]
    told = _bits(held & signs[1][item]) + slack[1][item] >= ANSWER_SHARE * np.minimum(n, ANSWER)
    return some[(n < ANSWER) | (most >= LCS_ALONE * n) | told]


def _bits(sets: np.ndarray) -> np.ndarray:
    """How many bits are set in each row of SIGNS numbers: eight counts of a byte each, added up in four lanes of 16 bits."""
    counts, lanes = np.ascontiguousarray(np.bitwise_count(sets)).view(np.uint64), np.uint64(0x00FF00FF00FF00FF)
    counts = (counts & lanes) + (counts >> np.uint64(8) & lanes)
    return (counts * np.uint64(0x0001000100010001) >> np.uint64(48)).astype(np.int64).sum(1)


def _compare(best: dict, cosine: np.ndarray, item: np.ndarray, text: np.ndarray, place: np.ndarray, bounds: np.ndarray, word: np.ndarray, numbers: list, masks: np.ndarray) -> None:
    """Judge candidates (item, text, word where the item would begin), all of an item at once; `best` keeps the best leak of each pair."""
    order = np.lexsort((-cosine, place, text, item))
    cosine, item, text, place = cosine[order], item[order], text[order], place[order]
    fresh = np.ones(len(item), bool)  # one candidate per region, with its best cosine
    fresh[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (place[1:] != place[:-1])
    cosine, item, text, place = cosine[fresh], item[fresh], text[fresh], place[fresh]
    cuts = np.flatnonzero(np.diff(item, prepend=-1))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(item)]):
        k = int(item[a])
        width = len(numbers[k]) + 2 * STEP
        for lo in range(a, b, 20_000):
            hi = min(b, lo + 20_000)
            at = place[lo:hi, None] - STEP + np.arange(width)
            outside = (at < bounds[text[lo:hi]][:, None]) | (at >= bounds[text[lo:hi] + 1][:, None])
            at[outside] = len(word) - 1
            share, told, leak = verdicts(numbers[k], word[at], masks)
            for i in np.flatnonzero(leak).tolist():
                pair = int(text[lo + i]), k
                if share[i] > best.get(pair, (0, 0))[1]:
                    best[pair] = float(cosine[lo + i]), share[i], told[i]
