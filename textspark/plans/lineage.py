"""Cutting lineage with reliable checkpoints in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the session's own setting, or a temporary one in local mode only."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="textspark-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path beside the checkpoints, for tables written by a running job."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of a step go when it is over, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP_KEY)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_KEY, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once as Parquet beside the checkpoints: smaller than a checkpoint, read by column."""
    path = shared_dir(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_at = path
    _note(out)
    return out


def durable(df: DataFrame) -> DataFrame:
    """The same rows, materialised once and readable after the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    context = df.sparkSession.sparkContext._jsc.sc()
    first = context.newShuffleId()
    out = df.checkpoint(eager=True)
    # Spark's setting does not reach checkpoints. Should another thread's shuffle be among these, Spark makes it again.
    if context.cleaner().isDefined():
        for number in range(first + 1, context.newShuffleId()):
            context.cleaner().get().doCleanupShuffle(number, False)
    _note(out)
    return out


#: What `stored` and `durable` wrote, by the calls of `settled` that run.
_written: list[list[DataFrame]] = []


def _note(df: DataFrame) -> None:
    if _written:
        _written[-1].append(df)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """`stored` rows of what `make` returns; tables that it wrote on the way go when the rows are there."""
    _written.append([])
    try:
        out = stored(make(), name)
    finally:
        written = _written.pop()
    discarded(*(df for df in written if df is not out))
    _note(out)
    return out


def discarded(*frames: DataFrame) -> None:
    """Deletes what `stored` or `durable` wrote for frames that no later step reads."""
    for df in frames:
        # A checkpoint's folder is known to its plan.
        path = getattr(df, "kept_at", None) or df._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
        context = df.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
