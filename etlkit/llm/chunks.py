"""Texts in packed chunks, and rounds in which chunks ask about short strings and get answers."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.llm.common import SMALL_KEYS, columns_of, staged, text_arrays, tidy
from etlkit.session import drop_scratch, scratch_path

CHUNK_BYTES = 2 << 20
CHUNKS_PER_TASK = 8
LAST = (1 << 63) - 1  # stands for a NULL id: after all others
BATCH_BYTES = 4 << 20  # answers put out at once


def packed(value) -> bytes:
    raw = pickle.dumps(value, 5)
    return pa.compress(raw, "zstd", asbytes=True) + len(raw).to_bytes(8, "little")


def unpacked(data):
    data = memoryview(data)
    return pickle.loads(pa.decompress(data[:-8], int.from_bytes(data[-8:], "little"), "zstd"))


class Chunks:
    """Documents in chunks of about CHUNK_BYTES (or one longer document), stored bucketed by their number, so that
    answers can be joined to them round after round without moving the texts again."""

    def __init__(self, docs: DataFrame, name: str):
        spark = docs.sparkSession
        docs = columns_of(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), "text")

        def each(batches):
            from pyspark import TaskContext
            part, n, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

            def row():
                ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
                return pa.RecordBatch.from_arrays([pa.array([part << 32 | n], pa.int64()), pa.array([packed((np.array(ids, np.int64), ends, b"".join(texts)))], pa.binary())], ["chunk", "data"])

            for batch in batches:
                data, ends = text_arrays(batch.column("text"))
                raw = data.tobytes()
                for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                    if size and size + ends[i + 1] - ends[i] > CHUNK_BYTES:
                        yield row()
                        n, ids, texts, size = n + 1, [], [], 0
                    ids.append(doc)
                    texts.append(raw[ends[i]:ends[i + 1]])
                    size += len(texts[-1])
            if ids:
                yield row()

        path = scratch_path(spark, name)
        docs.mapInArrow(each, "chunk long, data binary").write.option("compression", "none").parquet(path)
        stored = spark.read.schema("chunk long, data binary").parquet(path)
        self.count = stored.count()
        self.tasks = max(1, -(-self.count // CHUNKS_PER_TASK))
        table = f"{name}_{uuid.uuid4().hex}"
        with tidy(spark):
            stored.repartition(self.tasks, "chunk").write.bucketBy(self.tasks, "chunk").option("path", scratch_path(spark, f"{name}-bucketed")).option(
                "compression", "none").saveAsTable(table)
        self.rows = spark.table(table)
        drop_scratch(spark, path)

    def ask(self, questions, answers: DataFrame | None, keys: int) -> DataFrame:
        """(part, chunk, data): what `questions(chunk, ids, ends, data, answers)` returns by part, 0 <= part < keys."""
        def each(chunk, texts, got):
            found = questions(*texts, got)
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([chunk] * len(found), pa.int64()), pa.array(list(found.values()), pa.binary())], ["part", "chunk", "data"])
        return self._with(answers, each, "part int, chunk long, data binary")

    def route(self, questions, answers: DataFrame, number: bool = True, every: bool = False) -> DataFrame:
        """(chunk, data): what `questions(ids, ends, data, answers)` returns by the chunk it is for. Chunks without
        answers are asked only with `every`; with `number` the first of the answers is the chunk's own number."""
        return self._with(answers, self._routed(questions, number, every), "chunk long, data binary")

    def spread(self, questions, answers: DataFrame, size: Column, most: int, number: bool = True) -> DataFrame:
        """`route`, but where the answers to a chunk come to more than `most` by the column `size`, they are dealt out to several
        tasks, each with the chunk's texts. Many chunks may refer to one, and what they ask of it then grows with the corpus."""
        many = answers.groupBy("chunk").agg(F.ceil(F.sum(size) / most).cast("int").alias("n")).where("n > 1")
        many = staged(many, "many")
        count = many.count()
        each = self._routed(questions, number, False)
        if not count:
            return self._with(answers, each, "chunk long, data binary")
        many = F.broadcast(many) if count <= SMALL_KEYS else many
        rows = self.rows.join(many, "chunk").select("chunk", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("turn"), "data")
        dealt = answers.join(many, "chunk").select("chunk", F.pmod(F.xxhash64("data"), "n").cast("int").alias("turn"), "data")
        return self._with(answers.join(many, "chunk", "left_anti"), each, "chunk long, data binary").union(
            self._with(dealt, each, "chunk long, data binary", rows))

    def _routed(self, questions, number: bool, every: bool):
        def each(chunk, texts, got):
            found = questions(*texts, [chunk.to_bytes(8, "little")] * number + got) if got or every else {}
            return _rows(list(found), list(found.values()))
        return each

    def finish(self, result, schema: str, answers: DataFrame | None) -> DataFrame:
        """Rows that `result(ids, ends, data, answers)` gives as a record batch per chunk."""
        return self._with(answers, lambda _, texts, got: result(*texts, got), schema)

    def _with(self, answers: DataFrame | None, each, schema: str, rows: DataFrame | None = None) -> DataFrame:
        """The record batches that `each(chunk, (ids, ends, data), answers)` gives. Only the answers move, once, to where their chunks are, and
        a task holds those of one chunk at a time. With `rows`, copies of chunks, they meet by chunk and turn."""
        if answers is None:
            return self.rows.mapInArrow(lambda batches: (each(c.as_py(), _texts(d), []) for batch in batches for c, d in zip(*batch.columns)), schema)

        rows, keys = (self.rows, ["chunk"]) if rows is None else (rows, ["chunk", "turn"])

        def together(rows, got):
            return pa.Table.from_batches([each(rows.column("chunk")[0].as_py(), _texts(rows.column("data")[0]), [x.as_py() for x in got.column("data")])])
        return rows.groupBy(*keys).cogroup(answers.select(*keys, "data").groupBy(*keys)).applyInArrow(together, schema)


def _texts(data: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, ends, raw = unpacked(data.as_buffer())
    return ids, ends, np.frombuffer(raw, np.uint8)


def answered(questions: DataFrame, answer, numbered: bool = False) -> DataFrame:
    """(chunk, data): per part, `answer([data of each chunk])` gives pairs of a place in that list and a value, in any order and number. With
    `numbered` it also gets the chunks' numbers. Data are views of what has arrived, and values go on as they come."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(batch.column("chunk").to_numpy(), [memoryview(x.as_buffer()) for x in batch.column("data")]) for batch in batches]
        numbers, blobs = np.concatenate([n for n, _ in held]), [b for _, more in held for b in more]
        chunks, data, size = [], [], 0
        for i, value in answer(blobs, numbers) if numbered else answer(blobs):
            chunks.append(numbers[i])
            data.append(value)
            size += len(value)
            if size >= BATCH_BYTES:
                yield _rows(chunks, data)
                chunks, data, size = [], [], 0
        yield _rows(chunks, data)
    return questions.groupBy("part").applyInArrow(each, "chunk long, data binary")


def _rows(chunks: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(data, pa.binary())], ["chunk", "data"])


def parts_for(chunks: int, bytes_per_chunk: int, target: int = 24 << 20) -> int:
    return max(16, -(-chunks * bytes_per_chunk // target))
