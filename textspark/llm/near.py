"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

A document's set is its distinct five-word shingles (`words.shingle_sets`). Every set gets `COORDINATES` minima; each
(coordinate, value) is a list of the documents posted under it. Two sets of similarity 0.75 agree in 48 of 64
coordinates on average, and in fewer than `MATCHES` = 30 with a chance of 2e-7. So documents are compared that agree in
at least 30, and links are confirmed on the whole sets.

Prefix: of its 64 lists a document is looked for only in the 64 - 30 + 1 = 35 shortest, since two documents that agree
in 30 meet in one of those. Skip: the longest lists, made by passages that a crowd of documents shares, are never
merged; they only count when two signatures are laid side by side. Exact copies are one node from the start. Each list
is first linked to its hub, the document with the longest lists of all, then each document of a long list to its best
partner in another component. What still lies in different components is compared in blocks, so a list of any length is
merged whole, no task holds more than two blocks of it, and a pair is taken up in the first list it shares only.

Defined results: null, empty and blank texts have an empty set and link with nothing; a document of one to four words
has its whole sequence as its one shingle; rows of one doc_id share their links; a null doc_id gets a null component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.llm.storage import by_slices, dropped, kept, lists
from textspark.llm.words import first_of_runs, mix, shingle_sets, split_words
from textspark.operators.components import components

SHINGLE = 5
COORDINATES = 64
MATCHES = 30
WIDE = 256
WIDE_MATCHES = 156
BLOCK = 1000
SMALL = 32
# A signature is 64 whole minima and 192 single bytes, four to a number.
PACKED = COORDINATES + (WIDE - COORDINATES) // 4

_MULTIPLIERS = mix(np.arange(1, WIDE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SHIFTS = mix(np.arange(1001, WIDE + 1001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signatures(values: np.ndarray, ends: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The minima of each set under every coordinate's hash (32 bits); sets must not be empty."""
    starts = np.concatenate([[0], ends[:-1]])
    out = np.empty((len(ends), coordinates), np.uint32)
    for i in range(coordinates):
        hashed = ((values * _MULTIPLIERS[i] + _SHIFTS[i]) >> np.uint64(32)).astype(np.uint32)
        out[:, i] = np.minimum.reduceat(hashed, starts)
    return out


def _profiles(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(split_words(batch.column(1)), SHINGLE)
    sizes = np.diff(np.concatenate([[0], sets.ends]))
    some = np.flatnonzero(sizes)
    sums = np.zeros((2, len(sizes)), np.uint64)
    packed = np.zeros((0, PACKED), np.int32)
    if len(some):
        starts = (sets.ends - sizes)[some]
        sums[0, some] = np.add.reduceat(mix(sets.values), starts)
        sums[1, some] = np.add.reduceat(mix(sets.values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
        minima = signatures(sets.values, sets.ends[some], WIDE)
        narrow = np.ascontiguousarray(minima[:, COORDINATES:].astype(np.uint8)).view(np.int32)
        packed = np.concatenate([minima[:, :COORDINATES].view(np.int32), narrow], axis=1)
    filled = np.zeros(len(sizes), np.int64)
    filled[some] = PACKED
    return pa.record_batch(
        [
            batch.column(0),
            pa.array(sizes, pa.int64()),
            pa.array(sums[0].view(np.int64)),
            pa.array(sums[1].view(np.int64)),
            lists(packed.ravel(), np.cumsum(filled), pa.int32()),
        ],
        ["doc_id", "n_shingles", "set_a", "set_b", "signature"],
    )


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(split_words(batch.column(1)), SHINGLE)
    return pa.record_batch([batch.column(0), lists(sets.values.view(np.int64), sets.ends, pa.int64())], ["doc", "shingles"])


def profiles(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, signature): size, two 64-bit sums that identify the set, and its minima."""
    return kept(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
            by_slices(_profiles),
            "doc_id long, n_shingles long, set_a long, set_b long, signature array<int>",
        ),
        "profiles",
    )


def _agree(sig: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal coordinates of the signatures a and b, of all `WIDE`; a may be one row for all b."""
    whole = (sig[a, :COORDINATES] == sig[b, :COORDINATES]).sum(axis=-1)
    narrow = sig.view(np.uint8)[:, 4 * COORDINATES :]
    return whole + (narrow[a] == narrow[b]).sum(axis=-1)


def _merged(unit, coordinate, doc, part, comp, mask, one_block, sig, best: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of pairs in one unit that lie in different components and agree in enough coordinates.

    Long units give each row outside the largest component either its best partner (`best`) or all of them.
    """
    found = []

    def take(a, b):
        enough = _agree(sig, a, b) >= WIDE_MATCHES
        a, b = a[enough], b[enough]
        # Only in the first list that both have in their prefixes.
        shared = (sig[a, :COORDINATES] == sig[b, :COORDINATES]) & ((mask[a] & mask[b])[:, None] >> np.arange(COORDINATES, dtype=np.uint64) & np.uint64(1)).astype(bool)
        here = shared.argmax(axis=1) == coordinate[a]
        found.append((a[here], b[here]))

    edges = np.flatnonzero(np.concatenate([first_of_runs(unit), [True]]))
    sizes = np.diff(edges)
    at = np.repeat(np.arange(len(sizes)), sizes)
    small = sizes[at] <= SMALL
    for d in range(1, int(min(SMALL, sizes.max(initial=0)))):
        a = np.flatnonzero(small[:-d] & (at[:-d] == at[d:]) & (comp[:-d] != comp[d:]) & (one_block[:-d] | (part[:-d] != part[d:])))
        take(a, a + d)
    for g in np.flatnonzero(sizes > SMALL):
        rows = np.arange(edges[g], edges[g + 1])
        values, counts = np.unique(comp[rows], return_counts=True)
        done = np.zeros(len(unit), bool)
        for i in rows[comp[rows] != values[counts.argmax()]]:
            done[i] = True
            other = rows[(comp[rows] != comp[i]) & (one_block[i] | (part[rows] != part[i])) & ~done[rows]]
            if best and len(other):
                agreed = _agree(sig, np.array([i]), other)
                j = int(agreed.argmax())
                if agreed[j] >= WIDE_MATCHES:
                    found.append((np.array([i]), other[j : j + 1]))
            elif len(other):
                take(np.full(len(other), i), other)
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))


def _by_unit(fn):
    """For mapInArrow over rows sorted by their first column: applies `fn` to batches of whole units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            joined = pa.Table.from_batches([*rest, batch]).combine_chunks().to_batches()[0]
            unit = np.asarray(joined.column(0))
            earlier = np.flatnonzero(unit != unit[-1])
            last = int(earlier[-1]) + 1 if len(earlier) else 0
            if last:
                yield fn(joined.slice(0, last))
            rest = [joined.slice(last)]
        if rest and rest[0].num_rows:
            yield fn(rest[0])

    return run


def _candidates(batch: pa.RecordBatch, best: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    unit, coordinate, doc, part, comp, mask, same = (np.asarray(batch.column(i)) for i in range(7))
    sig = np.ascontiguousarray(np.asarray(batch.column(7).flatten()).reshape(-1, PACKED))
    return unit, doc, comp, *_merged(unit, coordinate, doc, part, comp, mask.view(np.uint64), same.astype(bool), sig, best)


def _best_pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
    _, doc, _, a, b = _candidates(batch, True)
    both = np.unique(np.stack([np.minimum(doc[a], doc[b]), np.maximum(doc[a], doc[b])], axis=1), axis=0)
    return pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _concerned(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The documents of each unit that have a candidate in it."""
    unit, doc, _, a, b = _candidates(batch, False)
    rows = np.unique(np.concatenate([a, b]))
    return pa.record_batch([pa.array(unit[rows]), pa.array(doc[rows])], ["unit", "doc"])


def _links(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Confirmed links of each unit, one for two components."""
    _, doc, comp, a, b = _candidates(batch, False)
    sets = batch.column(8)
    values = np.asarray(sets.flatten())
    sizes = np.asarray(pa.compute.list_value_length(sets)).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    linked = np.zeros(len(a), bool)
    for lo, hi in zip(np.searchsorted(a, np.unique(a), "left"), np.searchsorted(a, np.unique(a), "right")):
        one, others = a[lo], b[lo:hi]
        own = values[starts[one] : starts[one] + sizes[one]]
        step = np.cumsum(sizes[others])
        at = np.arange(step[-1]) + np.repeat(starts[others] - (step - sizes[others]), sizes[others])
        found = np.concatenate([[0], np.cumsum(np.isin(values[at], own))])
        shared = found[step] - found[step - sizes[others]]
        linked[lo:hi] = 100 * shared >= 75 * (sizes[one] + sizes[others] - shared)
    a, b = a[linked], b[linked]
    pair = np.stack([np.minimum(comp[a], comp[b]), np.maximum(comp[a], comp[b])], axis=1)
    _, first = np.unique(pair, axis=0, return_index=True)
    return pa.record_batch([pa.array(doc[a[first]]), pa.array(doc[b[first]])], ["a", "b"])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that hold 100 * intersection >= 75 * union on their whole sets."""
    one = sets.toDF("a", "_in_a")
    two = sets.toDF("b", "_in_b")
    shared = F.size(F.array_intersect("_in_a", "_in_b"))
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .select("a", "b", shared.alias("_shared"), (F.size("_in_a") + F.size("_in_b")).alias("_sum"))
        .filter(100 * F.col("_shared") >= 75 * (F.col("_sum") - F.col("_shared")))
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`; component_id is the smallest doc_id reachable.

    One shuffle of 64 small rows a document counts the lists; texts move once, and only those of documents that have a
    possible partner.
    """
    spark = docs.sparkSession
    profile = profiles(docs)
    known = profile.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = kept(
        known.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("doc"), F.min("signature").alias("signature")), "classes"
    )
    posts = classes.select("doc", F.posexplode(F.slice("signature", 1, COORDINATES)).alias("_i", "_v")).select(
        "doc", F.shiftleft(F.col("_i").cast("long"), 32).bitwiseOR(F.col("_v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("key")
    )
    sizes = posts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    ranked = (
        posts.join(sizes, "key")
        .groupBy("doc")
        .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("_lists"), F.sum("n").alias("weight"))
        .withColumn("_take", F.size("_lists") - F.lit(MATCHES - 1))
        .filter("_take > 0")
        .select("doc", "weight", F.transform(F.slice("_lists", F.lit(1), F.col("_take")), lambda x: x["key"]).alias("prefix"))
    )
    open_docs = kept(ranked.join(classes.select("doc", "signature"), "doc"), "open")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string"))
    sets = kept(
        texts.join(open_docs.select("doc"), "doc", "left_semi").mapInArrow(by_slices(_sets), "doc long, shingles array<long>"), "sets"
    )
    lists_of = open_docs.select("doc", "weight", F.explode("prefix").alias("key"))
    hubs = lists_of.groupBy("key").agg(F.max(F.struct("weight", (-F.col("doc")).alias("doc"))).alias("_hub"))
    stars = (
        lists_of.join(hubs.select("key", (-F.col("_hub.doc")).alias("hub")), "key")
        .filter("doc <> hub")
        .select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b"))
        .distinct()
    )
    near_hub = stars.join(open_docs.select(F.col("doc").alias("a"), F.col("signature").alias("_sa")), "a").join(
        open_docs.select(F.col("doc").alias("b"), F.col("signature").alias("_sb")), "b"
    )
    whole = [F.slice(side, 1, COORDINATES) for side in ("_sa", "_sb")]
    agreed = F.aggregate(F.zip_with(*whole, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x)
    links = kept(_confirmed(near_hub.filter(agreed >= MATCHES).select("a", "b"), sets), "hub-links")
    grouped = _grouped(open_docs.select("doc"), links)
    for find in (_best_links, _other_links):
        found = find(open_docs, grouped, sets)
        if not found.isEmpty():
            links = links.unionByName(found)
            grouped = _grouped(open_docs.select("doc"), links)
    moved = grouped.filter("comp <> doc").toDF("_class", "_comp")
    members = classes.select("set_a", "set_b", "n_shingles", F.col("doc").alias("_class"))
    placed_classes = members.join(moved, "_class", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("_comp", "_class").alias("_to")
    )
    result = profile.drop("signature").join(placed_classes, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_to", "doc_id"))
    out = kept(
        result.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
            "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
        ),
        "components",
    )
    dropped(profile, classes, open_docs, sets)
    return out


def _blocks(open_docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """The lists that still hold several components, cut in blocks of bounded size: one row for each unit of two blocks."""
    placed = open_docs.join(grouped, "doc").select(
        "doc",
        "comp",
        "signature",
        F.expr("aggregate(prefix, 0L, (m, x) -> m | shiftleft(1L, cast(shiftright(x, 32) AS int)))").alias("mask"),
        F.explode("prefix").alias("key"),
    )
    unsettled = (
        placed.groupBy("key")
        .agg(F.min("comp").alias("_low"), F.max("comp").alias("_high"), F.count("*").alias("_n"))
        .filter("_low < _high")
        .select("key", F.ceil(F.col("_n") / BLOCK).cast("int").alias("blocks"))
    )
    return (
        placed.join(unsettled, "key")
        .withColumn("part", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("key", F.least("part", "_other"), F.greatest("part", "_other")).alias("unit"),
            F.shiftright("key", 32).cast("int").alias("coordinate"),
            "doc",
            "part",
            "comp",
            "mask",
            (F.col("part") == F.col("_other")).cast("int").alias("same"),
            "signature",
        )
    )


def _together(rows: DataFrame) -> DataFrame:
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "unit").sortWithinPartitions("unit")


def _best_links(open_docs: DataFrame, grouped: DataFrame, sets: DataFrame) -> DataFrame:
    found = _together(_blocks(open_docs, grouped)).mapInArrow(_by_unit(_best_pairs), "a long, b long")
    return kept(_confirmed(kept(found.distinct(), "best"), sets), "links")


def _other_links(open_docs: DataFrame, grouped: DataFrame, sets: DataFrame) -> DataFrame:
    blocks = _blocks(open_docs, grouped)
    concerned = kept(_together(blocks).mapInArrow(_by_unit(_concerned), "unit long, doc long").distinct(), "concerned")
    rows = blocks.join(concerned, ["unit", "doc"]).join(sets, "doc").select(*blocks.columns, "shingles")
    return kept(_together(rows).mapInArrow(_by_unit(_links), "a long, b long"), "links")


def _grouped(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(doc, comp) for all nodes; only linked ones go through the component rounds."""
    linked = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    found = components(linked, links).toDF("doc", "_comp")
    return nodes.join(found, "doc", "left").select("doc", F.coalesce("_comp", "doc").alias("comp"))
