"""Restartable ingest: every micro-batch stores the posts whose ids the table does not hold yet."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from textspark.plans.ranking import top_k_per_group
from textspark.sources.posts import read_ledger


def unseen(candidates: DataFrame, ledger: DataFrame, key: str = "topic_id") -> DataFrame:
    return candidates.join(ledger.select(key), key, "left_anti")


def first_seen(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row of every id by `order`.

    A partial minimum per map task keeps copies of a hot id from meeting in one place.
    """
    names = df.columns
    row = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*names).alias("_row"))
    return df.groupBy(key).agg(F.min(row).alias("_first")).select("_first._row.*")


def first_seen_stream(stream: DataFrame, key: str, event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Streaming first sight. With an event time the state is dropped after `delay`; without, it never is."""
    if event_time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def ingest_batch(
    batch: DataFrame,
    posts_path: str,
    key: str,
    order: Sequence[Column],
    clean: Callable[[DataFrame], DataFrame] | None = None,
    batch_id: int | None = None,
) -> None:
    """One step: first sight inside the batch, drop known ids, clean, append.

    The posts table is the ledger. It is partitioned by batch and a batch overwrites its own partition only,
    so a step that is run again after a crash leaves the same rows behind.
    """
    spark = batch.sparkSession
    ledger = read_ledger(spark, posts_path, key=key)
    if batch_id is not None and "batch_id" in _columns(spark, posts_path):
        ledger = spark.read.parquet(posts_path).filter(F.col("batch_id") != batch_id).select(key)
    fresh = unseen(first_seen(batch, key, order), ledger, key)
    rows = clean(fresh) if clean else fresh
    (
        rows.withColumn("batch_id", F.lit(-1 if batch_id is None else batch_id).cast("bigint"))
        .write.mode("overwrite" if batch_id is not None else "append")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(posts_path)
    )


def _columns(spark: SparkSession, path: str) -> list[str]:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path).columns
    except AnalysisException:
        return []


def ingest_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    posts_path: str,
    checkpoint: str,
    key: str,
    order: Sequence[Column],
    clean: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int = 100,
    file_format: str = "parquet",
) -> list[dict]:
    """Drains the files waiting in `source_dir` in micro-batches and returns size and duration of each.

    A listener collects every batch; the query itself only remembers its newest ones.
    """
    stream = (
        spark.readStream.schema(schema)
        .format(file_format)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source_dir)
    )
    batches = _Batches()
    spark.streams.addListener(batches)
    try:
        query = (
            stream.writeStream.foreachBatch(
                lambda batch, batch_id: ingest_batch(batch, posts_path, key, order, clean, batch_id)
            )
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        # Events arrive in order and a little later than the query ends.
        if str(query.id) not in batches.ended and not batches.wait(str(query.id)):
            raise TimeoutError("the report of the ended stream did not arrive")
    finally:
        spark.streams.removeListener(batches)
    return sorted(batches.of.get(str(query.id), []), key=lambda b: b["batch_id"])


class _Batches(StreamingQueryListener):
    """Size and duration of every batch of the streams that run meanwhile, by query id."""

    def __init__(self) -> None:
        self.of: dict[str, list[dict]] = {}
        self.ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        entry = {"batch_id": p.batchId, "rows": p.numInputRows, "millis": p.batchDuration}
        self.of.setdefault(str(p.id), []).append(entry)

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self.ended.add(str(event.id))
            self._changed.notify_all()

    def wait(self, query_id: str, seconds: float = 120.0) -> bool:
        with self._changed:
            return self._changed.wait_for(lambda: query_id in self.ended, seconds)


def ingest_once(
    candidates: DataFrame, ledger: DataFrame, key: str, order: Sequence[Column],
    group: str | None = None, quota: int | None = None,
) -> DataFrame:
    """Batch twin of the stream: first sight, known ids dropped, optionally at most `quota` new rows per group."""
    fresh = unseen(first_seen(candidates, key, order), ledger, key)
    if group is None or quota is None:
        return fresh
    return top_k_per_group(fresh, [group], order, quota).drop("rank")
