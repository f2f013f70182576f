"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.llm.common import added_up, array_rows, columns_of, slices, staged, words_of

COMPONENTS = 256
RIDGE = 1e-3  # per row
BANDWIDTH = 4.0
BINS = 2000  # of raw scores, for the calibration
LOW, HIGH = -0.5, 1.5

_GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n", b".,;:?'\"-()", b"!", b"#$%&*@~^+=",
           b"|/\\<>[]{}_`"]
_CLASS = np.full(256, len(_GROUPS) + 1, np.int64)
_CLASS[:128] = len(_GROUPS)
for _k, _g in enumerate(_GROUPS):
    _CLASS[list(_g)] = _k
CLASSES = len(_GROUPS) + 2
STATISTICS = CLASSES + 11


def statistics(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of STATISTICS numbers per text; zeros for an empty one."""
    n = len(ends) - 1
    of = np.repeat(np.arange(n), np.diff(ends))
    size = np.diff(ends).astype(float)
    some = np.maximum(size, 1)
    out = np.zeros((n, STATISTICS))
    out[:, :CLASSES] = np.bincount(of * CLASSES + _CLASS[data], minlength=n * CLASSES).reshape(n, CLASSES) / some[:, None]
    # Capitals outside ASCII: second byte of Latin-1 letters.
    accents = np.zeros(len(data), bool)
    accents[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0x9F)
    hashes, where, start, end = words_of(data, ends, lower=False)
    words = np.bincount(where, minlength=n)
    length = end - start
    _, first = np.unique(hashes ^ (where.astype(np.uint64) << np.uint64(40)), return_index=True)
    line_start = np.unique(np.concatenate([ends[:-1][size > 0], np.flatnonzero(data == 10) + 1]))
    line_start = line_start[line_start < len(data)]
    line_of = np.searchsorted(ends, line_start, "right") - 1
    lines = np.bincount(line_of, minlength=n)
    heads = np.flatnonzero(np.diff(np.searchsorted(line_start, start, "right"), prepend=-1))  # first word of each line
    _, lead = np.unique(hashes[heads] ^ (where[heads].astype(np.uint64) << np.uint64(40)), return_index=True)
    some_words, some_lines = np.maximum(words, 1), np.maximum(lines, 1)
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    odd = (_CLASS[last] >= 6) & (_CLASS[last] <= 8)
    mean = np.bincount(where, length, n) / some_words
    out[:, CLASSES:] = np.stack([
        np.log1p(size), np.bincount(of, accents, n) / some, np.log1p(words), mean,
        np.sqrt(np.maximum(np.bincount(where, length.astype(float) ** 2, n) / some_words - mean ** 2, 0)),
        np.bincount(where[first], minlength=n) / some_words, np.bincount(where, odd, n) / some_words,
        np.log1p(lines), np.log1p(words / some_lines), np.bincount(where[heads[lead]], minlength=n) / some_lines,
        np.bincount(where, length > 25, n) / some_words], axis=1)
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    def each(batches):
        for rows, data, ends in slices(batches):
            x = statistics(data, ends)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), STATISTICS).cast(pa.list_(pa.float64()))], ["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return columns_of(docs, "doc_id", "text").mapInArrow(each, f"doc_id {kind}, x array<double>")


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, STATISTICS)


class Model:
    """Fitted numbers of fixed size: scaling, random directions, weights, calibration steps."""

    def __init__(self, mean, scale, weights=None, steps=None, seed=7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale, self.weights, self.steps = mean, scale, weights, steps
        self.directions = rng.normal(0, 1 / BANDWIDTH, (STATISTICS, COMPONENTS))
        self.phases = rng.uniform(0, 2 * np.pi, COMPONENTS)

    def features(self, x):
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.ones((len(x), 1)), np.sqrt(2 / COMPONENTS) * np.cos(z @ self.directions + self.phases)])

    def raw(self, x):
        return self.features(x) @ self.weights

    def score(self, x):
        if self.weights is None:
            return np.full(len(x), self.steps[0])
        return self.steps[bins(self.raw(x))]


def bins(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)


def isotonic(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The nondecreasing step function nearest to total / count; empty bins take values between their neighbours."""
    blocks = []
    for i in np.flatnonzero(count):
        blocks.append([total[i], count[i], i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            t, c, _ = blocks.pop()
            blocks[-1][0] += t
            blocks[-1][1] += c
    starts = [b[2] for b in blocks] + [len(count)]
    fitted = np.full(len(count), np.nan)
    for (t, c, i), to in zip(blocks, starts[1:]):
        seen = np.flatnonzero(count[i:to]) + i
        fitted[seen] = t / c
    at = np.flatnonzero(~np.isnan(fitted))
    return np.clip(np.interp(np.arange(len(count)), at, fitted[at]), 0, 1)


def fit(training: DataFrame) -> Model:
    """From rows (x, y): moments, normal equations and calibration counts are summed per task and then over tasks;
    the driver solves systems of fixed size. Without labels of both kinds the score is a constant: the share of
    label 1, or 0.5 without labels."""
    schema = "part int, data binary"

    def gather(of):
        def each(batches):
            sums = None
            for batch in batches:
                if batch.num_rows:
                    new = of(_matrix(batch.column("x")), np.asarray(batch.column("y"), float))
                    sums = new if sums is None else [a + b for a, b in zip(sums, new)]
            if sums is not None:
                yield array_rows(dict(enumerate(sums)))
        return training.mapInArrow(each, schema)

    (n,), sx, sxx, (sy,) = added_up(gather(lambda x, y: [np.array([len(y)]), x.sum(0), (x ** 2).sum(0), np.array([y.sum()])]),
                                    [(1,), (STATISTICS,), (STATISTICS,), (1,)], "moments")
    if n == 0 or sy in (0, n):
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS), None, np.full(BINS, 0.5 if n == 0 else sy / n))
    mean = sx / n
    model = Model(mean, np.sqrt(np.maximum(sxx / n - mean ** 2, 1e-9)) + 1e-6)

    def equations(x, y):
        z = model.features(x)
        return [z.T @ z, z.T @ y]

    gram, right = added_up(gather(equations), [(COMPONENTS + 1, COMPONENTS + 1), (COMPONENTS + 1,)], "equations")
    model.weights = np.linalg.solve(gram + RIDGE * n * np.eye(COMPONENTS + 1), right)

    def calibration(x, y):
        b = bins(model.raw(x))
        return [np.bincount(b, minlength=BINS), np.bincount(b, y, BINS)]

    model.steps = isotonic(*added_up(gather(calibration), [(BINS,), (BINS,)], "calibration"))
    return model


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Learns from labels (doc_id, quality) of documents outside the held-out third only; the text alone is an input
    of a score. NULL texts count as empty, and empty ones get the score of their statistics, all zero; labels that
    are NULL or not 0 or 1 are ignored; a document that repeats is scored once per row; other columns are ignored.
    """
    stats = staged(document_statistics(docs), "statistics")
    known = columns_of(labels, "doc_id", "quality").where("quality IN (0, 1)").where(~held_out(F.col("doc_id")))
    training = staged(stats.join(known, "doc_id").select("x", F.col("quality").cast("double").alias("y")), "training")
    model = fit(training)

    def score(batches):
        for batch in batches:
            s = model.score(_matrix(batch.column("x"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = stats.mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
