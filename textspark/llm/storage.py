"""Intermediate tables in the shared folder, and slices of Arrow batches small enough for numpy."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textspark.plans.lineage import shared_dir

#: Rows of one Arrow batch, and bytes of text handled at once in a task (one longer text is handled alone).
BATCH_ROWS = 1024
SLICE_BYTES = 1 << 20


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings for the steps that run inside the block; the caller's own come back after it."""
    values = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def kept(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS, row_group: int = 0, group_rows: int = 0) -> DataFrame:
    """The same rows, written once as Parquet beside the checkpoints and read back.

    `batch_rows` bounds the Arrow batches of the step: small where rows are long. `row_group` bounds
    the bytes that a writer gathers before it writes, where the writers of an executor would fill its heap.
    A writer looks at its bytes after a hundred rows only, and a reader holds a row group's rows at once: where a row
    has megabytes, `group_rows` bounds both.
    Survives lost executors, cuts the lineage, and lets the shuffle files of the step go when it is over.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    with settings(
        spark,
        spark__sql__classic__shuffleDependency__fileCleanup__enabled="true",
        spark__sql__execution__arrow__maxRecordsPerBatch=str(batch_rows),
        spark__sql__unionOutputPartitioning="false",
    ):
        writer = df.write.option("compression", "zstd")
        if row_group:
            writer = writer.option("parquet.block.size", str(row_group))
        if group_rows:
            writer = writer.option("parquet.block.row.count.limit", str(group_rows))
        writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def kept_once(df: DataFrame, name: str, row_group: int = 0) -> DataFrame:
    """`df` itself if it comes straight from `kept`, else kept."""
    return df if getattr(df, "kept_at", None) else kept(df, name, row_group=row_group)


class Shared:
    """A broadcast value of this package's own classes, which executors need not be able to import."""

    def __init__(self, spark: SparkSession, value):
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if "_value" not in self.__dict__:
            self._value = cloudpickle.loads(self.packed.value)
        return self._value

    def __getstate__(self):
        return {"packed": self.packed}


def free_name(taken: list[str], name: str) -> str:
    """A column name like `name` that none of `taken` has."""
    lower = {t.lower() for t in taken}
    while f"_{name}".lower() in lower:
        name += "_"
    return f"_{name}"


def dropped(*frames: DataFrame) -> None:
    """Deletes tables made by `kept` that nothing reads any more. Names of files come from the plan, not from rows."""
    for frame in frames:
        spark = frame.sparkSession
        files = frame.select("_metadata.file_path").limit(1).collect()
        if files:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(files[0][0]).getParent()
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key written as text, modulo `modulus`: the fold of a row."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def python_remainder(key: int, modulus: int) -> int:
    return zlib.crc32(str(key).encode()) % modulus


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each piece holds about `most` bytes of text at most, or a single row."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.asarray(pa.compute.binary_length(column.cast(pa.large_binary())).fill_null(0), dtype=np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def by_slices(
    fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], text: str = "text", most: int = SLICE_BYTES
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that applies `fn` to each bounded slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text, most):
                out = fn(piece)
                if out is not None and out.num_rows:
                    yield out

    return run


def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the end of each row's share of them."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
