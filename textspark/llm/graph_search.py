"""Approximate nearest neighbours by robust-pruned directed graphs, one for each shard of the vectors.

Rows are dealt to shards of about `SHARD` vectors by a hash of their id, so no group of alike vectors makes a shard
large. In a shard each vector is inserted with a greedy search from fixed starts; what the search saw is pruned: the
nearest candidate stays and drops all that lie closer to it, by the factor `RELAX`, than to the new vector, and so on to
`DEGREE` edges. Back edges are added and pruned alike. A query keeps a beam of the nearest found and expands it until
nothing is left to expand; its distances are then taken on the original vectors in double precision. Equal vectors of a
shard are one node with all their ids, so they neither fill the edges nor hide each other.

Queries are packed in blocks of about `BLOCK`; each block meets each shard once. Neither side is broadcast or collected:
the join is one by shuffle whatever Spark thinks of the sizes.

Defined results: vectors that are null, all zero, or hold a null or non-finite component take no part, nor do rows with
a null id; vectors of different lengths are not compared; rows that repeat an id and its vector count once; ties go to
the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.llm.storage import dropped, kept
from textspark.llm.words import first_of_runs
from textspark.plans.ranking import top_k_per_group

SHARD = 4096
BLOCK = 512
DEGREE = 28
BEAM = 64
RELAX = 1.2
STARTS = 16
_BATCH = 256
_EXPAND = 4
#: Graphs that a writer or a reader of them holds at once; each has a few megabytes.
_GRAPHS = 2


def beam_search(x: np.ndarray, edges: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest nodes found for each query and their squared distances, nearest first; -1 where there are fewer."""
    n_queries = len(queries)
    row = np.arange(n_queries)[:, None]
    ids = np.full((n_queries, beam), -1, np.int64)
    far = np.full((n_queries, beam), np.inf, np.float32)
    open_ = np.zeros((n_queries, beam), bool)
    seen = np.zeros((n_queries, len(x)), bool)

    def add(new: np.ndarray) -> None:
        nonlocal ids, far, open_
        fresh = (new >= 0) & ~seen[row, new]
        # One node may be met along two edges at once.
        order = np.argsort(new, axis=1, kind="stable")
        twice = np.zeros_like(fresh)
        ordered = np.take_along_axis(new, order, 1)
        np.put_along_axis(twice, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
        fresh &= ~twice
        at, which = np.nonzero(fresh)
        seen[at, new[at, which]] = True
        d = np.full(new.shape, np.inf, np.float32)
        gap = x[new[at, which]] - queries[at]
        d[at, which] = np.einsum("ij,ij->i", gap, gap)
        all_ids, all_far = np.concatenate([ids, np.where(fresh, new, -1)], 1), np.concatenate([far, d], 1)
        all_open = np.concatenate([open_, fresh], 1)
        best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        ids, far, open_ = (np.take_along_axis(a, best, 1) for a in (all_ids, all_far, all_open))

    add(np.broadcast_to(starts, (n_queries, len(starts))))
    while open_.any():
        pick = np.argsort(~open_, axis=1, kind="stable")[:, :_EXPAND]
        use = np.take_along_axis(open_, pick, 1)
        node = np.where(use, np.take_along_axis(ids, pick, 1), -1)
        np.put_along_axis(open_, pick, False, 1)
        add(np.where((node >= 0)[:, :, None], edges[node], -1).reshape(n_queries, -1))
    return ids, far


def pruned(x: np.ndarray, nodes: np.ndarray, pool: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """At most `degree` diverse neighbours of each node out of its pool (-1: none)."""
    pool = np.sort(pool, axis=1)
    pool[:, 1:][pool[:, 1:] == pool[:, :-1]] = -1
    pool[pool == nodes[:, None]] = -1
    gap = x[pool] - x[nodes][:, None]
    d = np.where(pool >= 0, np.einsum("ijk,ijk->ij", gap, gap), np.inf)
    order = np.argsort(d, axis=1, kind="stable")
    pool, d = np.take_along_axis(pool, order, 1), np.take_along_axis(d, order, 1)
    out = np.full((len(nodes), degree), -1, np.int64)
    at = np.arange(len(nodes))
    for k in range(degree):
        first = d.argmin(axis=1)
        some = np.isfinite(d[at, first])
        if not some.any():
            break
        chosen = pool[at, first]
        out[some, k] = chosen[some]
        gap = x[pool] - x[chosen][:, None]
        between = np.einsum("ijk,ijk->ij", gap, gap)
        d[some[:, None] & (relax * relax * between <= d)] = np.inf
        d[at, first] = np.inf
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the graph over the rows of `x`, and the nodes where searches start."""
    n = len(x)
    random = np.random.default_rng(7)
    middle = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    starts = np.unique(np.concatenate([[middle], random.permutation(n)[: STARTS - 1]]))
    edges = np.full((n, degree), -1, np.int64)
    if n > 1:
        edges[:, : min(8, n - 1)] = (np.arange(n)[:, None] + 1 + random.integers(0, n - 1, (n, min(8, n - 1)))) % n
    for factor in (1.0, relax):
        order = random.permutation(n)
        for k in range(0, n, _BATCH):
            nodes = order[k : k + _BATCH]
            found, _ = beam_search(x, edges, starts, x[nodes], beam)
            edges[nodes] = pruned(x, nodes, np.concatenate([found, edges[nodes]], 1), degree, factor)
            # Back edges: every chosen neighbour gets the new node among its own.
            to, back = edges[nodes].ravel(), np.repeat(nodes, degree)
            to, back = to[to >= 0], back[to >= 0]
            order_to = np.argsort(to, kind="stable")
            to, back = to[order_to], back[order_to]
            targets, at, count = np.unique(to, return_index=True, return_counts=True)
            pool = np.full((len(targets), int(count.max(initial=0))), -1, np.int64)
            pool[np.repeat(np.arange(len(targets)), count), np.arange(len(to)) - np.repeat(at, count)] = back
            for j in range(0, len(targets), _BATCH):
                part = targets[j : j + _BATCH]
                edges[part] = pruned(x, part, np.concatenate([edges[part], pool[j : j + _BATCH]], 1), degree, factor)
    return edges, starts


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(dim, id, v): rows whose vector is whole, finite and not zero."""
    v = F.col("v")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return rows.filter(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda c: c != 0)).select(F.size("v").alias("dim"), "id", "v")


def shard_graphs(rows: DataFrame, shards: int) -> DataFrame:
    """(dim, shard, ids, vectors, edges, starts), one row a shard: its rows and its graph as packed arrays."""

    def packed(table: pa.Table) -> pa.Table:
        dim, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
        ids = table.column("id").to_numpy()
        x = table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        order = np.lexsort((ids, *x.T[::-1]))
        ids, x = ids[order], x[order]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]).any(axis=1)
        keep = new | first_of_runs(ids)
        ids, x, new = ids[keep], x[keep], new[keep]
        edges, starts = build(x[new].astype(np.float32))
        columns = [ids, x, np.flatnonzero(new), edges, starts]
        values = [pa.array([a.tobytes()], pa.binary()) for a in columns]
        return pa.table([pa.array([dim], pa.int32()), pa.array([shard], pa.int64()), *values], names=["dim", "shard", "ids", "vectors", "nodes", "edges", "starts"])

    keyed = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("long"))
    schema = "dim int, shard long, ids binary, vectors binary, nodes binary, edges binary, starts binary"
    return kept(keyed.groupBy("dim", "shard").applyInArrow(packed, schema), "graphs", group_rows=_GRAPHS)


def meetings(packed: DataFrame, graphs: DataFrame) -> DataFrame:
    """Every block of queries with every graph it meets, by a shuffle.

    Spark takes a block that is copied to all shards for a single one, and so could broadcast all copies.
    """
    met = packed.hint("merge").join(graphs, ["dim", "shard"])
    return met.select("dim", "asked", "ids", "vectors", "nodes", "edges", "starts")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id", vector: str = "embedding", beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query, its own id left out; score is the distance."""
    rows = usable(vectors, id_column, vector)
    asked = usable(queries, id_column, vector).distinct()
    shards = max(1, -(-rows.count() // SHARD))
    blocks = max(1, -(-asked.count() // BLOCK))
    graphs = shard_graphs(rows, shards)
    packed = (
        asked.groupBy("dim", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(blocks)).alias("block"))
        .agg(F.collect_list(F.struct("id", "v")).alias("asked"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, asked, ids, x, nodes, edges, starts = (batch.column(c)[i] for c in range(7))
                dim = dim.as_py()
                ids, nodes, starts = (np.frombuffer(a.as_py(), np.int64) for a in (ids, nodes, starts))
                x = np.frombuffer(x.as_py(), np.float64).reshape(-1, dim)
                edges = np.frombuffer(edges.as_py(), np.int64).reshape(len(nodes), -1)
                own = asked.values.field("id").to_numpy()
                q = asked.values.field("v").flatten().to_numpy().reshape(-1, dim)
                small = x[nodes].astype(np.float32)
                ends = np.append(nodes[1:], len(ids))
                for j in range(0, len(own), _BATCH):
                    part = slice(j, j + _BATCH)
                    found, _ = beam_search(small, edges, starts, q[part].astype(np.float32), beam)
                    at, which = np.nonzero(found >= 0)
                    node = found[at, which]
                    # Of equal vectors the k + 1 smallest ids are all that a rank up to k can need.
                    count = np.minimum(ends[node] - nodes[node], k + 1)
                    pair = np.repeat(nodes[node] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                    at = np.repeat(at, count)
                    score = np.sqrt(((x[pair] - q[part][at]) ** 2).sum(axis=1))
                    other = ids[pair] != own[part][at]
                    at, pair, score = at[other], pair[other], score[other]
                    order = np.lexsort((ids[pair], score, at))
                    at, pair, score = at[order], pair[order], score[order]
                    first = np.searchsorted(at, at)
                    top = np.arange(len(at)) - first < k
                    yield pa.record_batch([pa.array(own[part][at[top]]), pa.array(ids[pair[top]]), pa.array(score[top])], ["query_id", "vec_id", "score"])

    found = kept(meetings(packed, graphs).mapInArrow(search, "query_id long, vec_id long, score double"), "found")
    best = top_k_per_group(found.distinct(), ["query_id"], [F.col("score"), F.col("vec_id")], k)
    out = kept(best.select("query_id", "rank", "vec_id", "score"), "nearest")
    dropped(graphs, found)
    return out
