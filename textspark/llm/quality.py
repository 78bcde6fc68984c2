"""Document quality by regularised quadratic discriminant analysis over transformed text statistics.

Each text gives `FEATURES` (lengths, shares of kinds of characters and words, repetition), on logarithmic scales. Class
means and covariances are sums over all labelled training rows, made in tasks and added by Spark: only classes x
(1 + d + d^2) numbers reach the driver. A class covariance is shrunk towards the diagonal of the pooled one (`SHRINKAGE`)
and its Cholesky factor kept, so a score is two triangular solves: the Mahalanobis terms and log-determinants of both
classes, plus the log of the class shares, as a probability of label 1.

Defined results: null, empty and blank texts are scored by the statistics of an empty text; labels other than 0 and 1
and null ones are ignored; several labels of one document each count; without labels every score is 0.5, with one class
only that class's label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.llm.storage import Shared, by_slices, dropped, free_name, kept, remainder
from textspark.llm.words import first_of_runs, split_words

SHRINKAGE = 0.05
FLOOR = 1e-3
FEATURES = (
    "words", "word_length", "length_spread", "longest", "upper", "digits", "exclaim", "symbols", "stops", "bars", "newlines",
    "foreign", "distinct", "distinct_triples", "top_word", "marked_words", "capital_words",
)

_KINDS = np.zeros(256, np.uint8)
_KINDS[65:91] = 1
_KINDS[97:123] = 2
_KINDS[48:58] = 3
_KINDS[ord("!")] = 4
for _c in b"#$%&*@^~+=<>_\\`":
    _KINDS[_c] = 5
for _c in b".,;:?'\"-()":
    _KINDS[_c] = 6
_KINDS[ord("|")] = 7
_KINDS[ord("\n")] = 8
_KINDS[128:] = 9
_N_KINDS = 10


def _counts(flags: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[ends] - total[starts]).astype(float)


def _distinct(hashes: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, and the count of its most frequent one."""
    hashes = hashes.copy()
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        hashes[a:b].sort()
    fresh = first_of_runs(hashes)
    fresh[(ends - sizes)[sizes > 0]] = True
    distinct = _counts(fresh, ends, ends - sizes)
    at = np.flatnonzero(fresh)
    runs = np.diff(np.concatenate([at, [len(hashes)]]))
    top = np.zeros(len(sizes))
    np.maximum.at(top, np.repeat(np.arange(len(sizes)), sizes)[at], runs)
    return distinct, top


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of `FEATURES` for each text."""
    words = split_words(texts, fold=False)
    first, ends = words.first[:-1], words.first[1:]
    sizes = ends - first
    sorted_texts = np.concatenate([[0], np.cumsum(pa.compute.binary_length(texts.cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    kinds = _KINDS[words.data]
    by = [_counts(kinds == k, sorted_texts[1:], sorted_texts[:-1]) for k in range(_N_KINDS)]
    lengths = (words.end - words.start).astype(float)
    sums = np.concatenate([[0], np.cumsum(lengths)])
    squares = np.concatenate([[0], np.cumsum(lengths**2)])
    n = sizes.astype(float)
    mean = (sums[ends] - sums[first]) / np.maximum(n, 1)
    spread = np.sqrt(np.maximum((squares[ends] - squares[first]) / np.maximum(n, 1) - mean**2, 0))
    longest = np.zeros(len(n))
    some = np.flatnonzero(sizes)
    if len(some):
        longest[some] = np.maximum.reduceat(lengths, first[some])
    last = kinds[words.end - 1]
    marked = _counts((last == 4) | (last == 5), ends, first)
    capital = np.concatenate([[0], np.cumsum(kinds == 1)])
    lower = np.concatenate([[0], np.cumsum(kinds == 2)])
    shouted = _counts((capital[words.end] - capital[words.start] > 1) & (lower[words.end] == lower[words.start]), ends, first)
    distinct, top = _distinct(words.hash, ends, sizes)
    runs, inside = words.runs(3)
    triple_sizes = np.maximum(sizes - 2, 0)
    triples, _ = _distinct(runs[inside], np.cumsum(triple_sizes), triple_sizes)
    share = lambda part, whole: np.log((part + 0.5) / (whole + 1.0))
    return np.stack(
        [
            np.log1p(n), np.log1p(mean), np.log1p(spread), np.log1p(longest), share(by[1], by[1] + by[2]), share(by[3], n),
            share(by[4], n), share(by[5], n), share(by[6], n), share(by[7], n), share(by[8], n), share(by[9], n),
            np.log1p(distinct) / np.log(n + 2), share(triples, triple_sizes), share(top, n), share(marked, n), share(shouted, n),
        ],
        axis=1,
    )


@dataclass
class Discriminant:
    means: np.ndarray  # label x feature
    factors: np.ndarray  # inverse of the lower Cholesky factor, by label
    constants: np.ndarray  # log share less half the log-determinant, by label
    fixed: float | None = None  # the score where labels don't tell two classes apart

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        if self.fixed is not None:
            return np.full(len(x), self.fixed)
        logs = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            logs.append(constant - 0.5 * (((x - mean) @ factor.T) ** 2).sum(axis=1))
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fitted(moments: np.ndarray, shrinkage: float = SHRINKAGE) -> Discriminant:
    """From sums over each label's rows: count, features, products of features."""
    counts, d = moments[:, 0], len(FEATURES)
    if (counts == 0).any():
        return Discriminant(*np.zeros((3, 2)), fixed=0.5 if not counts.any() else float(counts[1] > 0))
    means = moments[:, 1 : d + 1] / counts[:, None]
    spread = moments[:, d + 1 :].reshape(2, d, d) - counts[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = np.diag(np.maximum(np.diag(spread.sum(axis=0) / counts.sum()), FLOOR))
    factors, constants = [], []
    for k in range(2):
        own = spread[k] / counts[k]
        weight = max(shrinkage, d / (d + counts[k]))
        lower = np.linalg.cholesky((1 - weight) * (own + own.T) / 2 + weight * pooled)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(counts[k] / counts.sum()) - np.log(np.diag(lower)).sum())
    return Discriminant(means, np.array(factors), np.array(constants))


def features(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, features) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), _rows(statistics(batch.column(1)))], ["doc_id", "features"])

    named = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string"))
    return named.mapInArrow(by_slices(run), "doc_id long, features array<double>")


def _rows(x: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))


def fit(rows: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """The discriminant of feature rows joined to (doc_id, quality)."""
    d = len(FEATURES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(-1, d)
            label = np.asarray(batch.column(0))
            for k in (0, 1):
                own = x[label == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        at = np.arange(total.size)
        yield pa.record_batch([pa.array(at), pa.array(total.ravel())], ["at", "value"])

    named = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality")).filter("quality IN (0, 1)")
    sums = (
        rows.join(named, "doc_id").select("quality", "features").mapInArrow(moments, "at long, value double").groupBy("at").agg(F.sum("value"))
    )
    total = np.zeros(2 * (1 + d + d * d))
    for at, value in sums.collect():  # two classes' sums: a fixed number of rows
        total[at] = value
    return fitted(total.reshape(2, -1), shrinkage)


def held_out() -> F.Column:
    """Rows whose labels are never learned from: the fold of the id is 1 of 3."""
    return F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows = kept(features(docs), "features")
    shared = Shared(docs.sparkSession, fit(rows.filter(~held_out()), labels))
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(np.asarray(batch.column(2).flatten()).reshape(-1, d))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    out = rows.select("doc_id", held_out().alias("held_out"), "features")
    scored = kept(out.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"), "quality")
    dropped(rows)
    return scored


def with_quality(docs: DataFrame, model: Discriminant, name: str = "quality_score") -> DataFrame:
    """`docs` with the score of each row's text, in one pass."""
    shared = Shared(docs.sparkSession, model)
    read = free_name(docs.columns, "text_read")
    named = docs.drop(name).withColumn(name, F.lit(0.0)).withColumn(read, F.col("text").cast("string"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(batch.column(batch.schema.get_field_index(read)))
        return batch.set_column(batch.schema.get_field_index(name), name, pa.array(shared.value.score(x)))

    return named.mapInArrow(by_slices(run, read), named.schema).drop(read)
