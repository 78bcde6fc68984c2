"""Truncated singular value decomposition of long rows (key, term, value) by a randomised range finder.

The matrix is cut into blocks of whole rows, once, and a block numbers its own terms. The factor is a table (term,
vector). A pass sends each block the vectors of its terms, multiplies by the block and by its transpose, row after row,
and adds up what the blocks return by term. So a pass moves the terms of each block, not a vector a cell, and products
with single rows are never kept. Tables of vectors are made orthonormal by QR on each partition; the small triangles are
stacked and reduced again, so the driver sees at most 64 triangles of the sketch's width, whatever the table's length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.operators.linear import _short_batches
from textspark.plans.lineage import discarded, durable
from textspark.plans.union import union_rows

FAN_IN = 64
#: Directions weaker than this share of the strongest are noise of the arithmetic.
NOISE = 1e-10
#: Cells of a block as planned (up to twice as many are met), terms that a block may have, cells of one row of the index.
CELLS, TERMS, ROW_CELLS = 1 << 22, 1 << 18, 1 << 15
#: Kinds of rows of the index, in the order in which a task reads them.
TERM, ROWS = 0, 1
_INDEX = "block int, kind int, place int, term string, keys array<{kind}>, sizes binary, idx binary, value binary"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)


def _triangles(df: DataFrame, width: int) -> DataFrame:
    """(part, r): the triangular factor of each partition's vectors, row after row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            r = np.linalg.qr(np.vstack([r, _matrix(batch.column(0), width)]), mode="r")
        yield pa.record_batch([pa.array([TaskContext.get().partitionId()]), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], ["part", "r"])

    return df.select("vector").mapInArrow(run, "part long, r array<double>")


def triangle(df: DataFrame, width: int) -> np.ndarray:
    """R of the QR decomposition of all vectors of a table, up to the signs of its rows."""
    parts = durable(_triangles(df, width))
    while parts.count() > FAN_IN:

        def stacked(group: pa.Table) -> pa.Table:
            r = np.linalg.qr(_matrix(group["r"].combine_chunks(), width), mode="r")
            return pa.table({"part": [group["group"][0].as_py()], "r": pa.array([r.ravel().tolist()], pa.list_(pa.float64()))})

        grouped = parts.withColumn("group", F.floor(F.col("part") / FAN_IN)).groupBy("group")
        more = durable(grouped.applyInArrow(stacked, "part long, r array<double>"))
        discarded(parts)
        parts = more
    blocks = [np.array(row.r).reshape(-1, width) for row in parts.select("r").collect()]
    return np.linalg.qr(np.vstack(blocks), mode="r") if blocks else np.zeros((0, width))


def times(df: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    """(key, vector): every vector times a small matrix."""
    width, out = matrix.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            product = _matrix(batch.column(1), width) @ matrix
            edges = pa.array(np.arange(len(product) + 1, dtype=np.int32) * out)
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(edges, pa.array(product.ravel()))], [key, "vector"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, "vector").mapInArrow(run, f"`{key}` {kind}, vector array<double>")


def _turned(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of a triangle above the noise, and the matrix that makes the table's columns orthonormal, strongest first."""
    if not len(r):
        return np.zeros(0), np.zeros((r.shape[1], 0))
    _, size, turn = np.linalg.svd(r, full_matrices=False)
    strong = size > NOISE * size[0] if size[0] > 0 else np.zeros(len(size), bool)
    return size[strong], turn.T[:, strong] / size[strong]


def _gaussians(terms: DataFrame, width: int, seed: int) -> DataFrame:
    """(term, vector): `width` normal values a term, from hashes of the term."""
    unit = lambda i, side: (F.pmod(F.xxhash64("term", i, F.lit(2 * seed + side)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    normal = lambda i: F.sqrt(-2.0 * F.log(unit(i, 0))) * F.cos(2.0 * math.pi * unit(i, 1))
    return terms.select("term", F.transform(F.sequence(F.lit(1), F.lit(width)), normal).alias("vector"))


def _index_rows(number: Iterator[int], rows: pa.Table, key: pa.DataType) -> Iterator[pa.RecordBatch]:
    """A block of whole rows: its terms, then its cells. One with too many terms becomes two."""
    rows = rows.combine_chunks()
    keys = rows.column("key").combine_chunks()
    starts = np.flatnonzero(np.concatenate([[True], pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)]))
    coded = rows.column("term").combine_chunks().dictionary_encode()
    if len(coded.dictionary) > TERMS and len(starts) > 1:
        half = int(starts[len(starts) // 2])
        yield from _index_rows(number, rows.slice(0, half), key)
        yield from _index_rows(number, rows.slice(half), key)
        return
    block, n = next(number), len(coded.dictionary)
    same = lambda v, size: pa.array(np.full(size, v, np.int32))
    listed = pa.list_(key)
    names = ["block", "kind", "place", "term", "keys", "sizes", "idx", "value"]
    none = lambda kind, size=n: pa.nulls(size, kind)
    terms = [same(block, n), same(TERM, n), pa.array(np.arange(n, dtype=np.int32)), coded.dictionary]
    yield pa.record_batch([*terms, none(listed), *[none(pa.binary())] * 3], names)
    idx, value = coded.indices.to_numpy().astype(np.int32), rows.column("value").to_numpy()
    edges = np.append(starts, len(idx))
    low = place = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(edges, edges[low] + ROW_CELLS, side="right")) - 1)
        cut, mine = slice(edges[low], edges[high]), keys.take(pa.array(starts[low:high]))
        packed = [pa.array([x.tobytes()], pa.binary()) for x in (np.diff(edges[low : high + 1]).astype(np.int32), idx[cut], value[cut])]
        whole = pa.ListArray.from_arrays(pa.array([0, len(mine)], pa.int32()), mine)
        yield pa.record_batch([same(block, 1), same(ROWS, 1), same(place, 1), none(pa.string(), 1), whole, *packed], names)
        low, place = high, place + 1


@dataclass
class Index:
    """The cells in blocks of whole rows; block b is read by task b modulo `parts`."""

    rows: DataFrame
    parts: int


def _indexed(features: DataFrame, key: str) -> Index:
    cells = features.select(F.col(key).alias("key"), "term", F.col("value").cast("double").alias("value"))
    cells = cells.filter("value <> 0 AND key IS NOT NULL AND term IS NOT NULL")
    parts = max(cells.sparkSession.sparkContext.defaultParallelism, -(-cells.count() // CELLS))
    kind = features.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = TaskContext.get().partitionId()
        number = iter(range(own, 1 << 31, parts))
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= 2 * CELLS:
                rows = pa.Table.from_batches(held)
                whole = pc.index(rows.column("key"), rows.column("key")[-1]).as_py()
                if whole:
                    yield from _index_rows(number, rows.slice(0, whole), batch.schema.field("key").type)
                    held = rows.slice(whole).combine_chunks().to_batches()
        if held:
            yield from _index_rows(number, pa.Table.from_batches(held), held[0].schema.field("key").type)

    dealt = cells.repartition(parts, "key").sortWithinPartitions("key", "term", "value")
    return Index(durable(dealt.mapInArrow(run, _INDEX.format(kind=kind))), parts)


def _sent(index: Index, right: DataFrame) -> DataFrame:
    """The rows of every block behind the vectors of its terms; terms without a vector have null."""
    spots = index.rows.filter(F.col("kind") == TERM).join(right, "term", "left")
    columns = ["block", "kind", "place", "term", "vector", "keys", "sizes", "idx", "value"]
    cells = index.rows.filter(F.col("kind") == ROWS).withColumn("vector", F.lit(None).cast("array<double>"))
    rows = union_rows(spots.select(*columns), cells.select(*columns))
    dealt = rows.repartitionById(index.parts, F.pmod("block", F.lit(index.parts)))
    return dealt.sortWithinPartitions("block", "kind", "place")


class _Block:
    """The vectors of a block's terms, and the sums of its rows' products by term."""

    def __init__(self, block: int, matrix: np.ndarray):
        self.block, self.matrix = block, matrix
        self.terms, self.parts, self.right, self.sums = [], [], None, None

    def take(self, terms: pa.Array, vectors: pa.Array) -> None:
        known = vectors.is_valid().to_numpy(zero_copy_only=False)
        part = np.zeros((len(terms), self.matrix.shape[1]))
        part[known] = _matrix(vectors.drop_null(), len(self.matrix)) @ self.matrix
        self.terms.append(terms)
        self.parts.append(part)

    def times(self, sizes: np.ndarray, idx: np.ndarray, value: np.ndarray) -> np.ndarray:
        """One row a document."""
        if self.right is None:
            self.right, self.parts = np.concatenate(self.parts), []
        return np.add.reduceat(value[:, None] * self.right[idx], np.cumsum(sizes) - sizes, axis=0)

    def back(self, left: np.ndarray, sizes: np.ndarray, idx: np.ndarray, value: np.ndarray) -> None:
        if self.sums is None:
            self.sums = np.zeros_like(self.right)
        order = np.argsort(idx, kind="stable")
        places, first = np.unique(idx[order], return_index=True)
        at = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.sums[places] += np.add.reduceat(value[order, None] * left[at], first, axis=0)


def _listed(matrix: np.ndarray) -> pa.ListArray:
    edges = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(matrix.ravel()))


def _blocks_of(batches: Iterator[pa.RecordBatch], matrix: np.ndarray) -> Iterator[tuple]:
    """(block, keys, sizes, idx, value) of every row of the index, the block holding its terms."""
    now = None
    for batch in batches:
        block, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
        edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0) | (kind[1:] != TERM)) + 1
        for low, high in zip([0, *edges], [*edges, len(block)]):
            if low == high:
                continue
            if now is None or block[low] != now.block:
                now = _Block(int(block[low]), matrix)
            if kind[low] == TERM:
                now.take(*(batch.column(c).slice(low, high - low) for c in ("term", "vector")))
            else:
                packed = (np.frombuffer(batch.column(c)[low].as_py(), t) for c, t in (("sizes", np.int32), ("idx", np.int32), ("value", np.float64)))
                yield now, batch.column("keys")[low].values, *packed


def _squared(index: Index, right: DataFrame, matrix: np.ndarray) -> DataFrame:
    """(term, vector): A'A times the table times a small matrix; the triangle of A's product lies under the null term."""
    width = matrix.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(block: _Block) -> Iterator[pa.RecordBatch]:
            low = 0
            for terms in block.terms:
                yield pa.record_batch([pa.array(np.full(len(terms), block.block, np.int32)), terms, _listed(block.sums[low : low + len(terms)])], names)
                low += len(terms)

        names = ["block", "term", "vector"]
        now, r = None, np.zeros((0, width))
        for block, _, *cells in _blocks_of(batches, matrix):
            if now is not None and block is not now:
                yield from out(now)
            now = block
            left = block.times(*cells)
            r = np.linalg.qr(np.vstack([r, left]), mode="r")
            block.back(left, *cells)
        if now is not None:
            yield from out(now)
            yield pa.record_batch([pa.array([now.block], pa.int32()), pa.array([None], pa.string()), _listed(r.reshape(1, -1))], names)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["term", "vector"]
        r, last = np.zeros((0, width)), None
        for batch in batches:
            terms, vectors = batch.column("term"), batch.column("vector")
            apart = terms.null_count
            if apart:
                r = np.linalg.qr(np.vstack([r, _matrix(vectors.slice(0, apart), width)]), mode="r")
            if apart == len(terms):
                continue
            runs = pc.run_end_encode(terms.slice(apart))
            starts = np.concatenate([[0], runs.run_ends.to_numpy()[:-1]])
            total = np.add.reduceat(_matrix(vectors.slice(apart), width), starts, axis=0)
            words = runs.values
            if last is not None and last[0][0].equals(words[0]):
                total[0] += last[1][0]
            elif last is not None:
                yield pa.record_batch([last[0], _listed(last[1])], names)
            last = words[-1:], total[-1:]
            yield pa.record_batch([words[:-1], _listed(total[:-1])], names)
        if last is not None:
            yield pa.record_batch([last[0], _listed(last[1])], names)
        if len(r):
            yield pa.record_batch([pa.array([None], pa.string()), _listed(r.reshape(1, -1))], names)

    with _short_batches(right.sparkSession):
        parts = _sent(index, right).mapInArrow(run, "block int, term string, vector array<double>")
        dealt = parts.repartition("term").sortWithinPartitions("term", "block")
        return durable(dealt.mapInArrow(added, "term string, vector array<double>"))


def _multiplied(index: Index, right: DataFrame, key: str) -> DataFrame:
    """(key, vector): the rows times the table."""
    kind = index.rows.schema["keys"].dataType.elementType.simpleString()
    first = right.select(F.size("vector")).first()
    eye = np.eye(first[0] if first else 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, keys, *cells in _blocks_of(batches, eye):
            yield pa.record_batch([keys, _listed(block.times(*cells))], [key, "vector"])

    with _short_batches(right.sparkSession):
        return durable(_sent(index, right).mapInArrow(run, f"`{key}` {kind}, vector array<double>"))


@dataclass
class Decomposition:
    """factor: (term, vector), the right singular vectors as columns; values: the singular values, largest first.

    `fitted` are the features of the fit and their index, which a projection of the same table uses again.
    """

    factor: DataFrame
    values: list[float]
    fitted: tuple[DataFrame, Index] | None = None

    def project(self, features: DataFrame, keys: DataFrame, key: str, unit: bool = False) -> DataFrame:
        """(key, vector): every row of `keys` times the factor, scaled to length 1 if `unit`; rows without known terms are zero."""
        k = len(self.values)
        if k:
            index = self.fitted[1] if self.fitted and self.fitted[0] is features else _indexed(features, key)
            found = _multiplied(index, self.factor, key)
        zero = F.array_repeat(F.lit(0.0), k)
        rows = keys.select(key).join(found, key, "left").select(key, F.coalesce("vector", zero).alias("vector")) if k else keys.select(key, zero.alias("vector"))
        if not unit:
            return rows
        size = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
        scaled = F.transform("vector", lambda x: F.when(F.col("_size") == 0, x).otherwise(x / F.col("_size")))
        return rows.withColumn("_size", size).select(key, scaled.alias("vector"))


def decompose(features: DataFrame, key: str, k: int, oversample: int = 10, power: int = 2, seed: int = 0) -> Decomposition:
    """The first k singular values and right singular vectors of (key, term, value), not centred.

    The sketch is `oversample` wider than k and passes the matrix `power` more times, each time made orthonormal on both
    sides: A'(AR turned) is A'AR turned, so the left side needs its triangle only. `features` are read twice. A matrix
    of smaller rank gives as many as it has. Each vector's sign makes its largest absolute entry positive.
    """
    index = _indexed(features, key)
    width = k + oversample
    right = table = durable(_gaussians(index.rows.filter(F.col("kind") == TERM).select("term").distinct(), width, seed))
    values, turn = np.zeros(0), np.eye(width)
    for _ in range(power + 1):
        # A pass needs the table of the one before, and nothing older.
        sums = _squared(index, right, turn)
        discarded(table)
        table = sums
        found = sums.filter("term IS NULL").first()
        right, width = sums.filter("term IS NOT NULL"), turn.shape[1]
        _, left = _turned(_matrix(pa.array([found["vector"]], pa.list_(pa.float64())), width) if found else np.zeros((0, width)))
        if not left.shape[1]:
            return Decomposition(times(right, "term", left), [])
        values, turn = _turned(triangle(right, width) @ left)
        turn = left @ turn
    values, turn = values[:k], turn[:, :k]
    factor = durable(times(right, "term", turn))
    discarded(table)
    entry = lambda j: F.col("vector")[j]
    largest = factor.agg(*(F.max_by(F.signum(entry(j)), F.struct(F.abs(entry(j)), "term")).alias(f"s{j}") for j in range(len(values)))).first()
    signs = F.array(*(F.lit(-1.0 if s < 0 else 1.0) for s in largest))
    signed = durable(factor.select("term", F.zip_with("vector", signs, lambda x, s: x * s).alias("vector")))
    discarded(factor)
    return Decomposition(signed, [float(v) for v in values], (features, index))
