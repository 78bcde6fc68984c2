"""Benchmark items inside documents: size-partitioned MinHash containment search, then exact shingle containment.

Containment is the share of an item's distinct five-word shingles that a document holds. A short item in a long document
has a tiny Jaccard similarity, so sizes are partitioned on both sides: items fall in classes by powers of two (u/2, u],
and for each class documents are read as overlapping windows of 3u/2 shingles, u/2 apart, so every run of u shingles
lies within one window. A contained share of `THRESHOLD` = 0.5 then means a similarity of at least 1/7 with some window,
and one equal coordinate of 64 makes a candidate (an item at the very edge is missed with a chance of 5e-5, a whole one
practically never). Candidates are confirmed on whole sets, so every reported figure is exact.

The items are broadcast in portions of at most `PORTION` shingles, each with its own pass over the documents; documents
are never shuffled. Defined results: null, empty and blank texts on either side match nothing; an item of fewer than
five words is one shingle, its whole sequence, and is found only as a whole text; repeated rows each get their matches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.llm.near import COORDINATES, SHINGLE, _MULTIPLIERS, _SHIFTS, signatures
from textspark.llm.storage import Shared, by_slices, free_name, kept
from textspark.llm.words import shingle_sets, span_hashes, split_words

THRESHOLD = 0.5
PORTION = 4_000_000
_MATCH = "array<struct<item:long,n_item:long,n_shared:long>>"


@dataclass
class _Class:
    block: int
    items: np.ndarray  # positions in the portion
    values: np.ndarray  # coordinate x item, sorted per coordinate
    order: np.ndarray
    seen: np.ndarray  # coordinate x 65,536: low bits that occur


@dataclass
class _Portion:
    ids: np.ndarray
    values: np.ndarray
    ends: np.ndarray
    classes: list[_Class]


def _portion(table: pa.Table) -> _Portion:
    ids = table.column("item").to_numpy()
    column = table.column("shingles").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    values = np.asarray(column.flatten()).view(np.uint64)
    sizes = np.asarray(pa.compute.list_value_length(column)).astype(np.int64)
    ends = np.cumsum(sizes)
    minima = signatures(values, ends)
    upper = np.maximum(2, 1 << np.ceil(np.log2(sizes)).astype(np.int64))
    classes = []
    for u in np.unique(upper):
        mine = np.flatnonzero(upper == u)
        order = np.argsort(minima[mine], axis=0, kind="stable").T
        values_of = np.take_along_axis(minima[mine].T, order, axis=1)
        seen = np.zeros((COORDINATES, 1 << 16), bool)
        for i in range(COORDINATES):
            seen[i, values_of[i] & 0xFFFF] = True
        classes.append(_Class(int(u) // 2, mine, values_of, order, seen))
    return _Portion(ids, values, ends, classes)


def _candidates(portion: _Portion, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Distinct (text, item) pairs that share a coordinate of some window."""
    ends = np.cumsum(sizes)
    plans = []
    for c in portion.classes:
        blocks = -(-sizes // c.block)
        owner = np.repeat(np.arange(len(sizes)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        plans.append((c, owner, (ends - sizes)[owner] + nth * c.block))
    found = []
    for i in range(COORDINATES):
        hashed = ((hashes * _MULTIPLIERS[i] + _SHIFTS[i]) >> np.uint64(32)).astype(np.uint32)
        for c, owner, starts in plans:
            low = np.minimum.reduceat(hashed, starts)
            window = low.copy()
            for d in (1, 2):
                inside = owner[d:] == owner[:-d]
                window[:-d] = np.where(inside, np.minimum(window[:-d], low[d:]), window[:-d])
            hit = np.flatnonzero(c.seen[i, window & 0xFFFF])
            left = np.searchsorted(c.values[i], window[hit], "left")
            count = np.searchsorted(c.values[i], window[hit], "right") - left
            if count.any():
                at = np.repeat(left - (np.cumsum(count) - count), count) + np.arange(count.sum())
                found.append(np.stack([np.repeat(owner[hit], count), c.items[c.order[i, at]]]))
    return np.unique(np.concatenate(found, axis=1), axis=1).T if found else np.zeros((0, 2), np.int64)


def _matches(portion: _Portion, texts: pa.Array, threshold: float) -> list[list[dict]]:
    words = split_words(texts)
    counts = np.diff(words.first)
    hashes, inside = words.runs(SHINGLE)
    hashes, sizes = hashes[inside], np.maximum(counts - SHINGLE + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        whole = span_hashes(words.hash, words.first[short], words.first[short + 1])
        hashes = np.insert(hashes, np.cumsum(sizes)[short], whole)
        sizes[short] = 1
    out: list[list[dict]] = [[] for _ in counts]
    if not len(hashes):
        return out
    ends = np.cumsum(sizes)
    for text, item in _candidates(portion, hashes, sizes).tolist():
        own = portion.values[(portion.ends[item - 1] if item else 0) : portion.ends[item]]
        shared = int(np.isin(own, hashes[ends[text] - sizes[text] : ends[text]]).sum())
        if shared >= threshold * len(own):
            out[text].append({"item": int(portion.ids[item]), "n_item": len(own), "n_shared": shared})
    return out


def item_shingles(items: DataFrame) -> DataFrame:
    """(item, shingles) of the items that have words."""

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = shingle_sets(split_words(batch.column(1)), SHINGLE)
        offsets = pa.array(np.concatenate([[0], found.ends]).astype(np.int32))
        values = pa.ListArray.from_arrays(offsets, pa.array(found.values.view(np.int64)))
        return pa.record_batch([batch.column(0), values], ["item", "shingles"])

    named = items.select(F.col("item_id").cast("long").alias("item"), F.col("text").cast("string"))
    made = named.filter("item IS NOT NULL").mapInArrow(by_slices(sets), "item long, shingles array<long>")
    return kept(made.filter(F.size("shingles") > 0), "items")


def with_matches(docs: DataFrame, items: DataFrame, name: str = "_matches", threshold: float = THRESHOLD, portion: int = PORTION) -> DataFrame:
    """`docs` with an array column of the items each text holds: item, n_item, n_shared (shingles)."""
    spark = docs.sparkSession
    known = item_shingles(items)
    total = known.agg(F.sum(F.size("shingles"))).first()[0]
    portions = -(-(total or 0) // portion)
    docs = docs.withColumn(name, F.array().cast(_MATCH))
    read, new = free_name(docs.columns, "text_read"), free_name(docs.columns, "new")
    for k in range(portions):
        mine = known.filter(F.pmod(F.xxhash64("item"), F.lit(portions)) == k)
        table = mine.toArrow()
        if not table.num_rows:
            continue
        shared = Shared(spark, _portion(table))

        def find(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            at = batch.schema.get_field_index(read)
            found = pa.array(_matches(shared.value, batch.column(at), threshold), batch.schema.field(new).type)
            return batch.set_column(batch.schema.get_field_index(new), new, found)

        named = docs.withColumn(read, F.col("text").cast("string")).withColumn(new, F.array().cast(_MATCH))
        docs = named.mapInArrow(by_slices(find, read), named.schema).withColumn(name, F.concat(name, new)).drop(read, new)
    return docs


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment): every item and document with containment of at least `threshold`."""
    found = with_matches(docs.select("doc_id", "text"), items, threshold=threshold).select("doc_id", F.explode("_matches").alias("m"))
    return kept(
        found.select("doc_id", F.col("m.item").alias("item_id"), "m.n_item", "m.n_shared").withColumn(
            "containment", F.col("n_shared") / F.col("n_item")
        ),
        "contaminated",
    )
