"""Nearest vectors for a table of queries of any size, as a blocked matrix product.

Both tables are packed into blocks of rows. A task holds one block of queries and streams blocks of words past it; it
keeps the k best of every query and nothing else. Products are made for a few queries at a time. The words are cut into strips where query blocks alone would not
occupy the cluster, and the best of the strips are merged. No vector reaches the driver and nothing is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.functions.arrays import norm2, unit
from textspark.plans.lineage import durable
from textspark.plans.ranking import row_index, top_k_per_group
from textspark.plans.union import union_rows

#: Every block of words passes every block of queries, so queries are in large blocks, compared STEP_ROWS at a time.
QUERY_ROWS, WORD_ROWS, STEP_ROWS = 16384, 4096, 512
#: Similarities are compared after rounding to this many places; ties go to the smaller word.
PLACES = 12
_SLOT_BITS = 13


def _packed(rows: DataFrame, key: str, value: str, size: int) -> DataFrame:
    """(block, keys, values): unit vectors in key order, `size` a block. Vectors null, zero or not finite are left out."""
    vector = F.transform(value, lambda x: x.cast("double"))
    usable = rows.select(F.col(key).alias("key"), vector.alias("v")).withColumn("len", norm2(F.col("v")))
    usable = usable.filter((F.col("len") > 0) & (F.col("len") < float("inf")) & ~F.isnan("len") & F.col("key").isNotNull())
    placed = row_index(usable.select("key", unit(F.col("v")).alias("v")), [F.col("key")], "_i")
    blocks = placed.groupBy(F.floor(F.col("_i") / size).alias("block")).agg(F.array_sort(F.collect_list(F.struct("_i", "key", "v"))).alias("r"))
    return durable(blocks.select("block", F.transform("r", lambda r: r["key"]).alias("keys"), F.flatten(F.transform("r", lambda r: r["v"])).alias("values")))


def _better(best: tuple, products: np.ndarray, words: np.ndarray, k: int) -> tuple:
    """The k best of each query among those so far, which come first in word order, and a new block."""
    found, named = best
    found = np.concatenate([found, products], axis=1)
    named = np.concatenate([named, np.broadcast_to(words, (len(found), len(words)))], axis=1)
    n = found.shape[1]
    if n > k:
        # One whole number a candidate: the rounded similarity, then the place, smaller places first. All differ.
        score = (np.rint(found * 10.0**PLACES).astype(np.int64) << _SLOT_BITS) + (n - 1 - np.arange(n))
        kept = np.sort(np.argpartition(score, n - k, axis=1)[:, n - k :], axis=1)
        found, named = np.take_along_axis(found, kept, 1), np.take_along_axis(named, kept, 1)
    return found, named


def nearest(embeddings: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(qid, word, similarity, rank): the k words of (word, embedding) closest by cosine to each row of (qid, vec).

    Ranks start at 1; similarities are equal if they are so after 12 places, and ties go to the smaller word. Queries
    without a usable vector have no rows; with fewer than k words all are given. All vectors must be of one length.
    """
    if not 0 < k <= WORD_ROWS:
        raise ValueError(f"k must be between 1 and {WORD_ROWS}")
    asked, words = _packed(queries, "qid", "vec", QUERY_ROWS), _packed(embeddings, "word", "embedding", WORD_ROWS)
    blocks = asked.count()
    parts = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    strips = max(1, min(words.count(), -(-parts // max(blocks, 1))))
    kind = queries.schema["qid"].dataType.simpleString()
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1)))
    none = F.lit(None)
    units = asked.withColumn("strip", each(strips)).select(
        (F.col("block") * strips + F.col("strip")).cast("int").alias("unit"), F.lit(-1).cast("long").alias("block"),
        F.col("keys").alias("qids"), none.cast("array<string>").alias("words"), "values",
    )
    passing = words.withColumn("at", each(blocks)).select(
        (F.col("at") * strips + F.col("block") % strips).cast("int").alias("unit"), "block",
        none.cast(f"array<{kind}>").alias("qids"), F.col("keys").alias("words"), "values",
    )
    rows = union_rows(units, passing).repartitionById(max(1, blocks * strips), F.col("unit")).sortWithinPartitions("unit", "block")

    def matrix(values: pa.ListScalar, n: int) -> np.ndarray:
        return values.values.to_numpy(zero_copy_only=False).reshape(n, -1)

    def answers(qids: pa.Array, best: list[tuple]) -> Iterator[pa.RecordBatch]:
        for step, (found, named) in enumerate(best):
            for low in range(0, len(found), 128):
                some = found[low : low + 128]
                at = np.repeat(np.arange(low, low + len(some)) + step * STEP_ROWS, some.shape[1])
                named_here = pa.array(named[low : low + 128].ravel().tolist(), pa.string())
                yield pa.record_batch([qids.take(pa.array(at)), named_here, pa.array(some.ravel())], ["qid", "word", "similarity"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, qids, vectors, best = None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("unit")[i].as_py() != now:
                    if qids is not None:
                        yield from answers(qids, best)
                    now, qids = batch.column("unit")[i].as_py(), None
                values = batch.column("values")[i]
                if batch.column("block")[i].as_py() < 0:
                    qids = batch.column("qids")[i].values
                    vectors = matrix(values, len(qids))
                    steps = [vectors[low : low + STEP_ROWS] for low in range(0, len(qids), STEP_ROWS)]
                    best = [(np.zeros((len(v), 0)), np.zeros((len(v), 0), object)) for v in steps]
                elif qids is not None:
                    named = np.array(batch.column("words")[i].as_py(), object)
                    turned = matrix(values, len(named)).T
                    best = [_better(b, np.clip(v @ turned, -1.0, 1.0), named, k) for b, v in zip(best, steps)]
        if qids is not None:
            yield from answers(qids, best)

    found = durable(rows.mapInArrow(run, f"qid {kind}, word string, similarity double"))
    return top_k_per_group(found, ["qid"], [F.desc(F.round("similarity", PLACES)), F.col("word")], k)


def most_similar(embeddings: DataFrame, words: DataFrame, k: int = 10) -> DataFrame:
    """(query, word, similarity, rank): the k nearest words of every word of a table (word), itself excluded."""
    picked = embeddings.join(words.select("word").distinct(), "word", "left_semi")
    # One more than k is kept, then the query word is dropped and the rest re-ranked.
    ranked = nearest(embeddings, picked.select(F.col("word").alias("qid"), F.col("embedding").alias("vec")), k + 1)
    others = ranked.filter("word <> qid").drop("rank")
    return top_k_per_group(others, ["qid"], [F.desc(F.round("similarity", PLACES)), F.col("word")], k).withColumnRenamed("qid", "query")


def neighbourhoods(embeddings: DataFrame, seeds: DataFrame, k: int = 50) -> DataFrame:
    """(grp, word, rank, similarity, found): every seed of (grp, word) at rank 0 and its k neighbours.

    A seed without a vector is reported with found = false and has no neighbours; a seed in several groups has them in each.
    """
    known = embeddings.select("word", F.lit(True).alias("_known"))
    listed = durable(seeds.select("grp", "word").distinct().join(known, "word", "left"))
    own = listed.select(
        "grp", "word", F.lit(0).alias("rank"), F.lit(None).cast("double").alias("similarity"), F.coalesce("_known", F.lit(False)).alias("found")
    )
    near = most_similar(embeddings, listed.filter("_known"), k).withColumnRenamed("query", "_seed")
    grouped = listed.select("grp", F.col("word").alias("_seed")).join(near, "_seed")
    return union_rows(own, grouped.select("grp", "word", "rank", "similarity", F.lit(True).alias("found")))
