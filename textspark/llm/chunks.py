"""Tables of chunks: a few megabytes of text as one row, with a dictionary of the keys that occur in it.

A corpus-wide count then moves one row for each distinct key of a chunk, not one for each occurrence: `requests` are
grouped by key anywhere, and what a key gets is joined back and handed to its chunk by `answered`. Both are shuffles of
small rows. No key has more rows than there are chunks, and no task holds more than one chunk with its answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.llm.storage import SLICE_BYTES, slices

#: Bytes of text in one chunk; a chunk has whole documents, so one longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20


def chunk_ids() -> Iterator[int]:
    """Numbers that no other task of the stage gives; a task that runs again gives the same."""
    part = TaskContext.get().partitionId()
    yield from range(part << 32, (part + 1) << 32)


def in_chunks(batches: Iterator[pa.RecordBatch], text: str, most: int = CHUNK_BYTES) -> Iterator[list[pa.RecordBatch]]:
    """Lists of bounded slices that make up one chunk each."""
    part, size = [], 0
    for batch in batches:
        for piece in slices(batch, text, min(most, SLICE_BYTES)):
            more = piece.column(piece.schema.get_field_index(text)).nbytes
            if part and size + more > most:
                yield part
                part, size = [], 0
            part.append(piece)
            size += more
    if part:
        yield part


def unpacked(blob: bytes | None, kind: str) -> np.ndarray:
    return np.frombuffer(blob or b"", kind)


def requests(chunks: DataFrame, keys: str = "keys", counts: str = "counts") -> DataFrame:
    """(chunk, key, n): the dictionary of each chunk, packed as little-endian int64, as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, key, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                key, n = unpacked(key, "<i8"), unpacked(n, "<i8")
                if len(key):
                    yield pa.record_batch([pa.array(np.full(len(key), chunk)), pa.array(key), pa.array(n)], ["chunk", "key", "n"])

    return chunks.select("chunk", keys, counts).mapInArrow(run, "chunk long, key long, n long")


def answered(chunks: DataFrame, answers: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """`fn(row of the chunk, its answers)` for every chunk; answers have a column `chunk`."""


    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(fn, schema)


def totals(asked: DataFrame) -> DataFrame:
    """(key, total, owner): the sum over all chunks, and the first of the chunks that have the key."""
    return asked.groupBy("key").agg(F.sum("n").alias("total"), F.min("chunk").alias("owner"))
