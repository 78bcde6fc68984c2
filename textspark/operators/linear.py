"""L2-penalised linear classifiers on TF-IDF whose vocabulary, weights and optimiser state are tables.

The objective is that of the ML estimators: mean loss + reg / 2 * |W|^2 with intercepts that are not penalised; softmax
over all classes (one logistic unit for two), or the hinge loss of one class against the rest.

From zero, the weights stay combinations of documents: W = X'A with one row of A a document. So the optimiser (conjugate
gradients, an exact line search) needs documents times classes numbers and never a vector over the vocabulary. A step asks
for X X'G once. Cells are dealt out by term, once, and stay where they are: a task keeps the weights of its own terms for
the time of one block and sends out margins, so a step moves documents times classes numbers a task, whatever the
vocabulary. The gradient, 8 bytes a document and class, is broadcast to the tasks. The driver keeps the class list, the
intercepts and a few sums a step.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textspark.plans.lineage import discarded, durable, stored
from textspark.plans.union import union_rows

#: Documents of a chunk, cells that a task holds at once, rows of weights handed over at once, bytes of margins that a task holds.
CHUNK_BITS, CELLS, TERMS, HELD_BYTES = 12, 1 << 21, 1 << 16, 256 << 20
CHUNK = 1 << CHUNK_BITS
#: Tokens whose cells are dealt out together, and characters of text for each of the parts that terms are dealt to.
TOKENS, PART_CHARS = 1 << 21, 1 << 22
#: Rows hold whole blocks, so Arrow batches are short.
BATCH_ROWS = 64
_DEALT = "part int, base bigint, kind int, data binary"
_INDEX = "sub int, chunk bigint, cells binary, idf binary, w binary, names binary, parts binary"
_SUMS = "chunk bigint, sums binary"
_STATE = "chunk bigint, y binary, scale binary, v binary"
#: Places of a state: coefficients, their margins, gradient, its margins, direction, its margins.
A, M, G, Q, D, MD = range(6)
#: Kinds of dealt rows, in the order in which a task reads them.
_KNOWN, _CELLS = 0, 1
#: The term that stands for the intercept of a class.
BIAS = "<BIAS>"


@contextmanager
def _short_batches(spark: SparkSession):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def _batch(schema: str, *values) -> pa.RecordBatch:
    """One row."""
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.record_batch([pa.array([value], _ARROW[kind]) for (_, kind), value in zip(fields, values)], [name for name, _ in fields])


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers that are never negative, each in as few bytes as it needs, compressed."""
    arrays = [a.astype(np.min_scalar_type(int(a.max(initial=0)))) for a in arrays]
    head = np.array([[a.itemsize, len(a)] for a in arrays], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head.tobytes(), *(a.tobytes() for a in arrays)]))


def _unpacked(blob: bytes, n: int) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    out, at = [], 16 * n
    for width, size in np.frombuffer(data, np.int64, 2 * n).reshape(n, 2).tolist():
        out.append(np.frombuffer(data, f"u{width}", size, at))
        at += width * size
    return out


def _spelled(names: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and bytes of strings."""
    edges = np.frombuffer(names.buffers()[1], np.int32)[names.offset : names.offset + len(names) + 1]
    data = names.buffers()[2]
    return np.diff(edges), np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data and len(names) else np.zeros(0, np.uint8)


def _named(sizes: np.ndarray, data: np.ndarray) -> pa.StringArray:
    edges = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(edges.tobytes()), pa.py_buffer(data.tobytes()))


# The index: cells by term -----------------------------------------------------------------------------------
def _parts_of(names: pa.StringArray, parts: int) -> np.ndarray:
    return (hash_array(names.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(parts)).astype(np.int64)


def _dealt_cells(ids: np.ndarray, tokens: pa.Array, parts: int) -> Iterator[pa.RecordBatch]:
    """The cells of some documents of one partition, a row for each part that has some: its terms, and where they occur."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0))
    words, doc = tokens.flatten(), np.repeat(np.arange(len(ids)), sizes)
    if words.null_count:
        doc, words = doc[np.asarray(words.is_valid())], words.drop_null()
    if not len(words):
        return
    coded = words.cast(pa.string()).dictionary_encode()
    part = _parts_of(coded.dictionary, parts)
    order = np.argsort(part, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    cells, n = np.unique(rank[coded.indices.to_numpy()] * len(ids) + doc, return_counts=True)
    df = np.bincount(cells // len(ids), minlength=len(order))
    base = int(ids.min())
    at = (ids - base)[cells % len(ids)]
    sizes, data = _spelled(coded.dictionary.take(pa.array(order)))
    letters, until = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), np.concatenate([[0], np.cumsum(df)])
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(edges)).tolist():
        a, b = edges[p], edges[p + 1]
        cut = slice(until[a], until[b])
        yield _batch(_DEALT, p, base, _CELLS, _packed(sizes[a:b], data[letters[a] : letters[b]], df[a:b], at[cut], n[cut]))


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Cells of (_id, _tokens), by parts of the terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            # A task may read several partitions, in each of which numbers follow each other.
            edges = np.flatnonzero(np.diff(ids >> 33)) + 1
            for low, high in zip([0, *edges], [*edges, len(ids)]):
                if low == high:
                    continue
                if held and (size >= TOKENS or held[0][0][0] >> 33 != ids[low] >> 33):
                    yield from _dealt_cells(np.concatenate([i for i, _ in held]), pa.concat_arrays([t for _, t in held]), parts)
                    held, size = [], 0
                piece = batch.column(1).slice(low, high - low)
                held.append((ids[low:high], piece))
                size += len(piece.flatten())
        if held:
            yield from _dealt_cells(np.concatenate([i for i, _ in held]), pa.concat_arrays([t for _, t in held]), parts)

    return rows.select("_id", "_tokens").mapInArrow(run, _DEALT)


class _Block:
    """Cells of whole terms, gathered until there are enough for the rows of one `sub`.

    Terms stay that are in `low` to `high` documents, or, in the index of a model, that the model knows.
    """

    def __init__(self, n_docs: int, low: float, high: float, k: int):
        self.n_docs, self.low, self.high, self.k, self.sub = n_docs, low, high, k, 0
        self._clear()

    def _clear(self) -> None:
        self.cells, self.names, self.dfs, self.known, self.part_of, self.size = [], [], [], [], [], 0

    def add(self, part: int, base: int, kind: int, data: bytes) -> None:
        if kind == _KNOWN:
            self.known.append(data)
            return
        sizes, letters, df, at, n = _unpacked(data, 5)
        self.names.append(_named(sizes, letters))
        self.dfs.append(df.astype(np.int64))
        self.part_of.append(np.full(len(df), part))
        self.cells.append((base, at, n))
        self.size += len(at)

    def _chosen(self, terms: pa.StringArray, df: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Which terms stay, and idf and weights of those."""
        if not self.k:
            stays = (df >= self.low) & (df <= self.high)
            return stays, np.log((self.n_docs + 1.0) / (df[stays] + 1.0)) + 1.0, None
        if not self.known:
            return np.zeros(len(df), bool), np.zeros(0), None
        rows = [_opened(x, self.k) for x in self.known]
        place = pc.index_in(terms, value_set=pa.concat_arrays([t for t, _, _ in rows]))
        stays = np.asarray(place.is_valid())
        at = place.drop_null().to_numpy()
        return stays, np.concatenate([i for _, i, _ in rows])[at], np.concatenate([w for _, _, w in rows])[at]

    def rows(self) -> Iterator[pa.RecordBatch]:
        """A row a chunk of documents; the first holds the terms, what they weigh, and their documents and parts."""
        if not self.size:
            self._clear()
            return
        coded = pa.concat_arrays(self.names).dictionary_encode()
        code, dfs = coded.indices.to_numpy(), np.concatenate(self.dfs)
        df = np.bincount(code, dfs, len(coded.dictionary)).astype(np.int64)
        stays, idf, w = self._chosen(coded.dictionary, df)
        place = np.cumsum(stays) - 1
        of = np.repeat(code, dfs)
        keep = stays[of]
        idx = place[of[keep]]
        ids = np.concatenate([base + at.astype(np.int64) for base, at, _ in self.cells])[keep]
        n = np.concatenate([n.astype(np.int64) for _, _, n in self.cells])[keep]
        parts = np.zeros(len(df), np.int64)
        parts[code] = np.concatenate(self.part_of)
        names = coded.dictionary.filter(pa.array(stays))
        self._clear()
        if not len(idx):
            return
        order = np.lexsort((ids, idx, ids >> CHUNK_BITS))
        idx, n, ids = idx[order], n[order], ids[order]
        chunk, at = ids >> CHUNK_BITS, ids & (CHUNK - 1)
        edges = np.flatnonzero(np.diff(chunk)) + 1
        head = idf.tobytes(), None if w is None else w.tobytes(), _packed(*_spelled(names), df[stays]), _packed(parts[stays])
        for low, high in zip([0, *edges], [*edges, len(chunk)]):
            cells = _packed(np.diff(idx[low:high], prepend=0), at[low:high], n[low:high])
            yield _batch(_INDEX, self.sub, int(chunk[low]), cells, *head)
            head = None, None, None, None
        self.sub += 1


def _opened(blob: bytes, k: int) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """Terms, idf and weights of a row of known terms."""
    sizes, letters, idf, w = _unpacked(blob, 4)
    return _named(sizes, letters), idf.astype(np.uint64).view(np.float64), w.astype(np.uint64).view(np.float64).reshape(-1, k)


def _known(weights: DataFrame) -> DataFrame:
    """The terms of a model, by the parts that their cells are dealt to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy()
            for p in np.unique(part).tolist():
                mine = batch.filter(pa.array(part == p))
                sizes, letters = _spelled(mine.column("term").cast(pa.string()))
                numbers = [np.ascontiguousarray(x, np.float64).view(np.uint64) for x in (mine.column("idf").to_numpy(), mine.column("w").flatten().to_numpy())]
                yield _batch(_DEALT, p, 0, _KNOWN, _packed(sizes, letters, *numbers))

    return weights.select("part", "term", "idf", "w").mapInArrow(run, _DEALT)


def _indexed(rows: DataFrame, parts: int, n_docs: int, low: float, high: float, known: DataFrame | None = None, k: int = 0) -> DataFrame:
    """The cells of (_id, _tokens), dealt out by parts of the terms; a partition is read by one task as a whole."""
    dealt = _dealt(rows, parts)
    tasks = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    dealt = dealt if known is None else union_rows(_known(known), dealt)
    dealt = dealt.repartitionById(tasks, F.pmod("part", F.lit(tasks))).sortWithinPartitions("part", "kind", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, now = _Block(n_docs, low, high, k), None
        for part, *row in _cells_of(batches):
            if part != now and block.size >= CELLS:
                yield from block.rows()
            now = part
            block.add(part, *row)
        yield from block.rows()

    return durable(dealt.mapInArrow(run, _INDEX))


class _Held:
    """Rows of one `sub`: weights of its terms from the documents' coefficients, then margins from the weights."""

    def __init__(self, k: int):
        self.k, self.rows, self.idf, self.sums = k, [], np.zeros(0), np.zeros((0, k))

    def take(self, chunk: int, cells: bytes, idf: bytes | None, rep: bytes) -> None:
        if idf is not None:
            self.idf = np.frombuffer(idf)
            self.sums = np.zeros((len(self.idf), self.k))
        idx, at, value = _values(cells, self.idf)
        rep = np.frombuffer(rep).reshape(CHUNK, self.k)
        self.rows.append((chunk, cells))
        for j in range(self.k):
            self.sums[:, j] += np.bincount(idx, value * rep[at, j], len(self.idf))

    def margins(self, sums: dict[int, np.ndarray]) -> None:
        for chunk, cells in self.rows:
            idx, at, value = _values(cells, self.idf)
            total = sums.setdefault(chunk, np.zeros((CHUNK, self.k)))
            for j in range(self.k):
                total[:, j] += np.bincount(at, value * self.sums[idx, j], minlength=CHUNK)


def _values(cells: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    idx, at, n = _unpacked(cells, 3)
    idx = np.cumsum(idx, dtype=np.int64)
    return idx, at, n * idf[idx]


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(column[i].as_py() for column in batch.columns)


def _partial(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for chunk, total in sums.items():
        yield _batch(_SUMS, chunk, total.tobytes())
    sums.clear()


def _products(index: DataFrame, rep: DataFrame, k: int) -> DataFrame:
    """(chunk, sums): parts of X X' rep, for `rep` (chunk, rep) with k columns."""
    rows = index.join(F.broadcast(rep), "chunk").select("sub", "chunk", "cells", "idf", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, sums = None, _Held(k), {}
        for sub, *row in _cells_of(batches):
            if sub != now:
                held.margins(sums)
                now, held = sub, _Held(k)
                if len(sums) * CHUNK * k * 8 > HELD_BYTES:
                    yield from _partial(sums)
            held.take(*row)
        held.margins(sums)
        yield from _partial(sums)

    return rows.mapInArrow(run, _SUMS)


def _squares(index: DataFrame, k: int = 0) -> DataFrame:
    """(chunk, sums): parts of the squared lengths of the documents, and before them of their products with k columns of weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        idf = w = None
        for chunk, cells, new, weights in _cells_of(batches):
            if new is not None:
                idf, w = np.frombuffer(new), np.frombuffer(weights).reshape(-1, k) if k else None
                if len(sums) * CHUNK * (k + 1) * 8 > HELD_BYTES:
                    yield from _partial(sums)
            idx, at, value = _values(cells, idf)
            total = sums.setdefault(chunk, np.zeros((CHUNK, k + 1)))
            for j in range(k):
                total[:, j] += np.bincount(at, value * w[idx, j], minlength=CHUNK)
            total[:, k] += np.bincount(at, value * value, minlength=CHUNK)
        yield from _partial(sums)

    return index.select("chunk", "cells", "idf", "w").mapInArrow(run, _SUMS)


def _weight_rows(index: DataFrame, rep: DataFrame, k: int) -> DataFrame:
    """(part, term, df, idf, w): X' rep, one row a term."""
    rows = index.join(F.broadcast(rep), "chunk").select("names", "parts", "chunk", "cells", "idf", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[pa.RecordBatch]:
            sizes, letters, df = _unpacked(names, 3)
            terms, part, w = _named(sizes, letters), _unpacked(parts, 1)[0].astype(np.int32), held.sums
            for low in range(0, len(terms), TERMS):
                cut = slice(low, low + TERMS)
                edges = pa.array(np.arange(len(part[cut]) + 1, dtype=np.int32) * k)
                columns = [pa.array(part[cut]), terms[cut], pa.array(df[cut].astype(np.int64)), pa.array(held.idf[cut])]
                listed = pa.ListArray.from_arrays(edges, pa.array(np.ascontiguousarray(w[cut]).ravel()))
                yield pa.record_batch([*columns, listed], ["part", "term", "df", "idf", "w"])

        names = parts = held = None
        for spelled, part, *row in _cells_of(batches):
            if spelled is not None:
                if held:
                    yield from out()
                names, parts, held = spelled, part, _Held(k)
            held.take(*row)
        if held:
            yield from out()

    return rows.mapInArrow(run, "part int, term string, df bigint, idf double, w array<double>")


# Losses -----------------------------------------------------------------------------------------------------
def _loss(kind: str, margins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(loss by column, slopes); y is the class of each row. Softmax has one loss, given in the first column."""
    n, k = margins.shape
    if kind == "hinge":
        side = np.where(y[:, None] == np.arange(k), 1.0, -1.0)
        short = 1.0 - side * margins
        return np.maximum(short, 0.0).sum(axis=0), np.where(short > 0, -side, 0.0)
    if k == 1:
        side = np.where(y == 1, 1.0, -1.0)
        z = side * margins[:, 0]
        return np.array([np.logaddexp(0.0, -z).sum()]), (-side * np.exp(-np.logaddexp(0.0, z)))[:, None]
    top = margins.max(axis=1, keepdims=True, initial=-np.inf)
    e = np.exp(margins - top)
    total = e.sum(axis=1, keepdims=True)
    slopes = e / total
    rows = np.arange(n)
    loss = np.zeros(k)
    loss[0] = (np.log(total[:, 0]) + top[:, 0] - margins[rows, y]).sum()
    slopes[rows, y] -= 1.0
    return loss, slopes


@dataclass
class _Problem:
    kind: str
    k: int
    n: int
    reg: float

    @property
    def joint(self) -> bool:
        return self.kind == "log"

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """Sums that belong together: over all columns of a softmax, or each column alone."""
        return np.full(self.k, x.sum()) if self.joint else x

    def opened(self, y: bytes, scale: bytes, v: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.frombuffer(y, np.int16), np.frombuffer(scale), np.frombuffer(v).reshape(6, CHUNK, self.k)

    def turned(self, v: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return beta * v[D] - v[G], beta * v[MD] - v[Q]

    def advanced(self, v: np.ndarray, y: np.ndarray, beta, t, bias) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(state, slopes, loss) after a step t; margins of the new gradient are still the old one's."""
        d, md = self.turned(v, beta)
        a, m = v[A] + t * d, v[M] + t * md
        real = y >= 0
        slopes = np.zeros((CHUNK, self.k))
        loss, slopes[real] = _loss(self.kind, (m + bias)[real], y[real])
        return np.stack([a, m, slopes / self.n + self.reg * a, v[Q], d, md]), slopes, loss


# The optimiser ----------------------------------------------------------------------------------------------
def _stepped(p: _Problem, index: DataFrame, state: DataFrame, beta, t, bias) -> tuple[DataFrame, dict[str, np.ndarray]]:
    """The state after a step with the margins of its gradient, and the sums that the next step needs, by column."""

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, y, scale, v in _cells_of(batches):
            ys, s, vs = p.opened(y, scale, v)
            now, slopes, loss = p.advanced(vs, ys, beta, t, bias)
            rep = np.ascontiguousarray(now[G] * s[:, None])
            dots = np.stack([slopes.sum(axis=0), loss, (now[A] * now[M]).sum(axis=0)])
            yield _batch(f"{_STATE}, rep binary, dots binary", chunk, y, scale, now.tobytes(), rep.tobytes(), dots.tobytes())

    moved = state.select("chunk", "y", "scale", "v").mapInArrow(advance, f"{_STATE}, rep binary, dots binary")
    parts = _products(index, moved.select("chunk", "rep"), p.k)

    def closed(rows: pa.Table) -> pa.Table:
        place = pc.index(rows.column("y").is_null(), False).as_py()
        chunk, y, scale, v, dots = (rows.column(c)[place].as_py() for c in ("chunk", "y", "scale", "v", "dots"))
        _, s, now = p.opened(y, scale, v)
        q = np.zeros((CHUNK, p.k))
        for one in sorted(rows.column("sums").drop_null().to_pylist()):
            q += np.frombuffer(one).reshape(CHUNK, p.k)
        q *= s[:, None]
        more = [(now[G] * q).sum(axis=0), (now[G] * now[Q]).sum(axis=0)]
        now = now.copy()
        now[Q] = q
        dots = np.concatenate([np.frombuffer(dots).reshape(3, p.k), more])
        return pa.Table.from_batches([_batch(f"{_STATE}, dots binary", chunk, y, scale, now.tobytes(), dots.tobytes())])

    # A union, not a cogroup: the estimated size of a cogroup is a product, whose digits would double with every step.
    blank = {c: F.lit(None).cast("binary") for c in ("y", "scale", "v", "dots")}
    columns = ["chunk", "y", "scale", "v", "dots", "sums"]
    both = union_rows(moved.drop("rep").withColumn("sums", blank["y"]).select(*columns), parts.withColumns(blank).select(*columns))
    joined = both.groupBy("chunk").applyInArrow(closed, f"{_STATE}, dots binary")
    state, old = durable(joined), state
    discarded(old)
    # Sums of each chunk, a few numbers, are added up in the tasks.
    total = _added(state.select("dots").mapInArrow(_summed(lambda dots: np.frombuffer(dots)), "sums binary"), (5, p.k))
    return state, dict(zip(("slopes", "loss", "am", "gg", "go"), total))


def _summed(value):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for row in _cells_of(batches):
            total = total + value(*row)
        if not np.isscalar(total):
            yield _batch("sums binary", np.ascontiguousarray(total).tobytes())

    return run


def _added(rows: DataFrame, shape: tuple) -> np.ndarray:
    """The sum of one small array a partition."""
    total = np.zeros(shape)
    for r in rows.collect():
        total += np.frombuffer(r[0]).reshape(shape)
    return total


def _line(p: _Problem, state: DataFrame, beta, bias, turn, steps: np.ndarray) -> np.ndarray:
    """Derivative of the objective along the direction at each of `steps` (places, columns), by column."""

    def at(y: bytes, v: bytes) -> np.ndarray:
        ys, vs = np.frombuffer(y, np.int16), np.frombuffer(v).reshape(6, CHUNK, p.k)
        d, md = p.turned(vs, beta)
        real = ys >= 0
        now, way, ys = (vs[M] + bias)[real], (md + turn)[real], ys[real]
        out = [(_loss(p.kind, now + t * way, ys)[1] * way).sum(axis=0) / p.n for t in steps]
        am, dm = (d * vs[M]).sum(axis=0), (d * md).sum(axis=0)
        return np.array([x + p.reg * (am + t * dm) for x, t in zip(out, steps)])

    return _added(state.select("y", "v").mapInArrow(_summed(at), "sums binary"), steps.shape)


def _searched(p: _Problem, state: DataFrame, beta, bias, turn, guess: np.ndarray) -> np.ndarray:
    """Where the derivative along the direction passes zero: a wide grid, a fine one between two of its places, a secant."""
    steps = np.vstack([np.zeros(p.k), guess * 4.0 ** np.arange(-5, 6)[:, None]])
    for fine in (False, True):
        slope = np.array([p.pooled(x) for x in _line(p, state, beta, bias, turn, steps)])
        # The objective is convex, so slopes rise.
        last = np.clip((slope < 0).sum(axis=0) - 1, 0, len(steps) - 2)
        cols = np.arange(p.k)
        low, high, s_low, s_high = steps[last, cols], steps[last + 1, cols], slope[last, cols], slope[last + 1, cols]
        if not fine:
            steps = low + (high - low) * np.linspace(0.0, 1.0, 12)[:, None]
    inner = (s_low < 0) & (s_high > 0)
    share = np.where(inner, -s_low / np.where(inner, s_high - s_low, 1.0), np.where(s_low < 0, 1.0, 0.0))
    return low + (high - low) * share


@dataclass
class TableModel:
    """weights: (part, term, df, idf, w), w by class, in `parts` parts of the terms; stages: what makes the tokens of a text.

    `read` holds the rows that were scored last and what was made of them, for their explanation.
    """

    stages: list
    weights: DataFrame
    parts: int
    bias: list[float]
    labels: list[str]
    key: str
    kind: str
    objective: float
    read: tuple[DataFrame, DataFrame, DataFrame] | None = None

    def _tokens(self, df: DataFrame) -> tuple[DataFrame, Column]:
        for stage in self.stages[:-1]:
            df = stage.transform(df)
        return df.select(self.key, self.stages[-1].getInputCol()), self.stages[-1].column(F.col(self.stages[-1].getInputCol()))

    def _products(self, df: DataFrame, tokens: Column) -> tuple[DataFrame, DataFrame]:
        """(chunk, at, key, scale, scores) of every row, and the index of the rows' cells by the model's terms.

        `scale` is the inverse length; a row without known terms has the intercepts and a scale of zero.
        """
        key, k, bias = self.key, len(self.labels), np.array(self.bias)
        spark = df.sparkSession
        numbered = stored(df.withColumn("_id", F.monotonically_increasing_id()), "numbered")
        with _short_batches(spark):
            index = _indexed(numbered.select("_id", tokens.alias("_tokens")), self.parts, 0, 0.0, 0.0, self.weights, k)

            def closed(left: pa.Table, right: pa.Table) -> pa.Table:
                total = np.zeros((CHUNK, k + 1))
                for one in sorted(right.column("sums").to_pylist()):
                    total += np.frombuffer(one).reshape(CHUNK, k + 1)
                at, square = left.column("at").to_numpy(), total[:, k]
                scale = np.divide(1.0, np.sqrt(square), out=np.zeros(CHUNK), where=square > 0)
                scores = (total[:, :k] * scale[:, None] + bias)[at]
                edges = pa.array(np.arange(len(at) + 1, dtype=np.int32) * k)
                listed = pa.ListArray.from_arrays(edges, pa.array(scores.ravel()))
                return pa.table([left.column("chunk"), left.column("at"), left.column(key), pa.array(scale[at]), listed], names=["chunk", "at", key, "scale", "scores"])

            rows = numbered.select(*_spots(), key)
            schema = f"chunk bigint, at int, `{key}` {df.schema[key].dataType.simpleString()}, scale double, scores array<double>"
            scored = stored(rows.groupBy("chunk").cogroup(_squares(index, k).groupBy("chunk")).applyInArrow(closed, schema), "scores")
        discarded(numbered)
        return scored, index

    def _read(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        if not self.read or self.read[0] is not df:
            self.read = (df, *self._products(*self._tokens(df)))
        return self.read[1:]

    def scores(self, df: DataFrame) -> DataFrame:
        """(key, scores array<double>) of every row, by class; a row without known terms has the intercepts."""
        return self._read(df)[0].select(self.key, "scores")

    def explained(self, df: DataFrame, tokens: Column | None, top: int) -> DataFrame:
        """(key, label, term, contribution) for the `top` best classes of each row, ties to the first label.

        `tokens` are those whose contributions are asked for, the model's own if none are given.
        """
        key, labels = self.key, list(self.labels)
        ranked = F.array_sort(F.transform("scores", lambda s, i: F.struct((-s).alias("s"), i.alias("i"))))
        best = F.transform(F.slice(ranked, 1, min(top, len(labels))), lambda x: x["i"]).alias("best")
        scored, index = self._read(df)
        docs = scored.filter(F.col(key).isNotNull()).select("chunk", "at", key, "scale", best)
        if tokens is not None:
            own, index = self._products(df, tokens)
            docs = own.select("chunk", "at", key, "scale").join(docs.select(key, "best"), key)
        kind, width = df.schema[key].dataType.simpleString(), min(top, len(labels))

        def packed(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("at").combine_chunks()
            at, scale, chosen = rows.column("at").to_numpy(), np.zeros(CHUNK), np.zeros((CHUNK, width), np.int16)
            scale[at] = rows.column("scale").to_numpy()
            chosen[at] = rows.column("best").combine_chunks().flatten().to_numpy().reshape(-1, width)
            place = np.full(CHUNK, -1, np.int16)
            place[at] = np.arange(len(at))
            keys = rows.column(key).combine_chunks()
            listed = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
            values = [pa.array([x.tobytes()], pa.binary()) for x in (place, scale, chosen)]
            return pa.table([rows.column("chunk").slice(0, 1), listed, *values], names=["chunk", "keys", "place", "scale", "best"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = idf = w = None
            called = pa.array(labels)
            for batch in batches:
                for i in range(batch.num_rows):
                    spelled, new, weights, cells, place, scale, chosen = (batch.column(c)[i].as_py() for c in range(7))
                    if new is not None:
                        names, idf, w = _named(*_unpacked(spelled, 3)[:2]), np.frombuffer(new), np.frombuffer(weights).reshape(-1, len(labels))
                    if place is None:
                        continue
                    idx, at, value = _values(cells, idf)
                    row = np.frombuffer(place, np.int16)[at]
                    idx, at, value, row = (x[row >= 0] for x in (idx, at, value, row))
                    value = value * np.frombuffer(scale)[at]
                    keys, terms = batch.column(7)[i].values.take(pa.array(row)), names.take(pa.array(idx))
                    for classes in np.frombuffer(chosen, np.int16).reshape(CHUNK, width).T:
                        of = classes[at]
                        yield pa.record_batch([keys, called.take(pa.array(of)), terms, pa.array(value * w[idx, of])], [key, "label", "term", "contribution"])

        # Rows whose documents are not asked for still bring the terms of their block.
        rep = stored(docs.groupBy("chunk").applyInArrow(packed, f"chunk bigint, keys array<{kind}>, place binary, scale binary, best binary"), "explained")
        met = index.join(F.broadcast(rep), "chunk", "left").select("names", "idf", "w", "cells", "place", "scale", "best", "keys")
        terms = met.mapInArrow(run, f"`{key}` {kind}, label string, term string, contribution double")
        bias = F.array(*(F.struct(F.lit(x).alias("label"), F.lit(BIAS).alias("term"), F.lit(float(b)).alias("contribution")) for x, b in zip(labels, self.bias)))
        biases = docs.select(key, F.inline(F.transform("best", lambda i: F.get(bias, i))))
        return union_rows(terms, biases)

    def predict(self, df: DataFrame) -> DataFrame:
        """`df` with the label of the highest score, ties to the first, and the probabilities of a logistic model."""
        labels = F.array(*map(F.lit, self.labels))
        scores = self.scores(df).withColumn("predicted", F.element_at(labels, F.array_position("scores", F.array_max("scores")).cast("int")))
        if self.kind == "log":
            # Scores of two classes are the margin and its negative.
            half, top = F.lit(0.5 if len(self.labels) == 2 else 1.0), F.array_max("scores")
            parts = F.transform("scores", lambda s: F.exp((s - top) * half))
            total = F.aggregate("_e", F.lit(0.0), lambda x, e: x + e)
            scores = scores.withColumn("_e", parts).withColumn("probability", F.transform("_e", lambda e: e / total)).drop("_e")
        return df.join(scores.drop("scores"), self.key)


def fit(
    train: DataFrame,
    stages: list,
    key: str,
    label: str = "label",
    kind: str = "log",
    min_df: float = 1.0,
    max_df: float = float("inf"),
    reg: float = 1.0,
    max_iter: int = 100,
    tol: float = 1e-6,
) -> TableModel:
    """At most `max_iter` steps from zero; ends when a step lowers the objective by less than `tol` of itself.

    `stages` make the tokens in the output column of the last one. min_df and max_df: counts from 1 on, else shares.
    """
    if kind not in ("log", "hinge"):
        raise ValueError(f"loss {kind!r} is neither log nor hinge")
    spark = train.sparkSession
    for stage in stages[:-1]:
        train = stage.transform(train)
    text = stages[-1].getInputCol()
    rows = train.filter(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("_label"), text)
    # Numbered once and stored, so that labels and cells agree; a number tells the chunk and the place in it.
    numbered = stored(rows.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    found = numbered.groupBy("_label").agg(F.count("*"), F.sum(F.char_length(F.col(text)))).collect()
    counts = dict(sorted((r[0], r[1]) for r in found))
    labels, n = list(counts), sum(counts.values())
    if not n:
        raise ValueError("no rows to fit")
    parts = max(spark.sparkContext.defaultParallelism, -(-sum(r[2] or 0 for r in found) // PART_CHARS))
    low, high = (b if b >= 1.0 else b * n for b in (min_df, max_df))
    tokenised = numbered.select("_id", stages[-1].column(F.col(text)).alias("_tokens"))
    k = 1 if kind == "log" and len(labels) == 2 else len(labels)
    p = _Problem(kind, k, n, reg)
    prior = np.log(np.array(list(counts.values())))
    bias = np.zeros(k) if kind == "hinge" else prior[1:] - prior[:1] if len(labels) == 2 else prior - prior.mean()
    with _short_batches(spark):
        index = _indexed(tokenised, parts, n, low, high)
        state = _started(p, numbered, index, labels)
        zero = np.zeros(k)
        state, sums = _stepped(p, index, state, zero, zero, bias)
        value = lambda s: (s["loss"].sum() + 0.5 * reg * n * s["am"].sum()) / n
        before, slope, beta, turn, guess = value(sums), sums["slopes"] / n, zero, zero, np.full(k, 4.0)
        for _ in range(max_iter if len(labels) > 1 else 0):
            turn = beta * turn - slope
            t = _searched(p, state, beta, bias, turn, guess)
            bias = bias + t * turn
            past, old = sums, slope
            state, sums = _stepped(p, index, state, beta, t, bias)
            slope = sums["slopes"] / n
            now = value(sums)
            done = abs(before - now) <= tol * max(abs(before), abs(now))
            before = now
            if done:
                break
            size = p.pooled(past["gg"] + old * old)
            beta = np.maximum(0.0, np.divide(p.pooled(sums["gg"] + slope * slope - sums["go"] - slope * old), size, out=np.zeros(k), where=size > 0))
            guess = np.where(t > 0, t, 1.0)
        weights = stored(_weight_rows(index, _coefficients(p, state), k), "weights")
    discarded(numbered, index, state)
    if p.joint and k > 1:
        bias = bias - bias.mean()
    if k < len(labels):
        weights = weights.withColumn("w", F.array(-F.col("w")[0], F.col("w")[0]))
        bias = np.array([-bias[0], bias[0]])
    return TableModel(list(stages), weights, parts, [float(b) for b in bias], labels, key, kind, float(before))


def _spots() -> list[Column]:
    """The chunk of a numbered row, and its place there."""
    return [F.shiftright("_id", CHUNK_BITS).alias("chunk"), F.col("_id").bitwiseAND(F.lit(CHUNK - 1)).cast("int").alias("at")]


def _started(p: _Problem, numbered: DataFrame, index: DataFrame, labels: list[str]) -> DataFrame:
    """Coefficients of zero, with the class and the inverse length of every document."""
    place = (F.array_position(F.array(*map(F.lit, labels)), F.col("_label")) - 1).cast("int").alias("y")
    rows = numbered.select(*_spots(), place)

    def start(left: pa.Table, right: pa.Table) -> pa.Table:
        y = np.full(CHUNK, -1, np.int16)
        y[left.column("at").to_numpy()] = left.column("y").to_numpy()
        square = np.zeros(CHUNK)
        for one in sorted(right.column("sums").to_pylist()):
            square += np.frombuffer(one)
        scale = np.divide(1.0, np.sqrt(square), out=np.zeros(CHUNK), where=square > 0)
        v = np.zeros((6, CHUNK, p.k))
        return pa.Table.from_batches([_batch(_STATE, left.column("chunk")[0].as_py(), y.tobytes(), scale.tobytes(), v.tobytes())])

    return durable(rows.groupBy("chunk").cogroup(_squares(index).groupBy("chunk")).applyInArrow(start, _STATE))


def _coefficients(p: _Problem, state: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, y, scale, v in _cells_of(batches):
            _, s, vs = p.opened(y, scale, v)
            yield _batch("chunk bigint, rep binary", chunk, np.ascontiguousarray(vs[A] * s[:, None]).tobytes())

    return state.select("chunk", "y", "scale", "v").mapInArrow(run, "chunk bigint, rep binary")
