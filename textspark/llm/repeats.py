"""Windows of words that repeat between documents, found through minimisers; shared by the two span operators.

A window of L words has the smallest hash of its m-word grams as its minimiser. Equal windows have equal minimisers, so
only windows whose minimiser occurs in two documents can repeat, and only those are ever spread out as rows. Documents
with equal words are one text from the start: the later ones are covered whole and add no rows.

A row of the documents is known by doc_id and a fingerprint of its words, so rows that share a doc_id but not the text
are kept apart. Hashes of windows have 128 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textspark.llm.storage import by_slices, free_name, kept, lists
from textspark.llm.words import Words, first_of_runs, run_hashes, span_hashes, split_words

#: Columns that the span operators add.
ADDED = ("n_words", "n_removed", "kept_sha256")
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def window_minima(words: Words, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The minimiser of each window of `length` words, and the text it lies in; windows over a border are left out."""
    text = words.text()
    if len(text) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    minima = sliding_min(run_hashes(words.hash, gram), length - gram + 1)
    inside = text[: len(minima)] == text[length - 1 :]
    return minima[inside], text[: len(minima)][inside]


def fingerprints(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's words, as signed numbers."""
    first, end = words.first[:-1], words.first[1:]
    size = (end - first).astype(np.uint64)
    return tuple((span_hashes(words.hash, first, end, base) ^ size).view(np.int64) for base in _BASES)


def outlines(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, n_words, fp, fp2, minima): size, fingerprint and minimisers of each text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = split_words(batch.column(1), fold=False)
        minima, text = window_minima(words, length, gram)
        fresh = first_of_runs(minima) | first_of_runs(text)
        ends = np.cumsum(np.bincount(text[fresh], minlength=batch.num_rows))
        fp, fp2 = fingerprints(words)
        columns = [batch.column(0), pa.array(np.diff(words.first)), pa.array(fp), pa.array(fp2)]
        columns.append(lists(minima[fresh].view(np.int64), ends, pa.int64()))
        return pa.record_batch(columns, ["doc_id", "n_words", "fp", "fp2", "minima"])

    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return kept(
        named.mapInArrow(by_slices(run), "doc_id long, n_words long, fp long, fp2 long, minima array<long>"), "outlines"
    )


def copies(outline: DataFrame, length: int) -> DataFrame:
    """(doc_id, fp) of the texts whose words are those of a smaller doc_id, and long enough to be covered whole."""
    texts = outline.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= length)).select("doc_id", "n_words", "fp", "fp2")
    firsts = texts.groupBy("fp", "fp2", "n_words").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
    firsts = firsts.filter("_first < _last").drop("_last")
    return kept(texts.join(firsts, ["fp", "fp2", "n_words"]).filter("doc_id > _first").select("doc_id", "fp").distinct(), "copies")


def shared_minima(outline: DataFrame, copied: DataFrame) -> DataFrame:
    """(doc_id, fp, hits): the minimisers of each text that occur under another doc_id too; copies stay out."""
    texts = outline.filter(F.col("doc_id").isNotNull() & (F.size("minima") > 0)).select("doc_id", "fp", "minima")
    rows = texts.join(copied, ["doc_id", "fp"], "left_anti").select("doc_id", "fp", F.explode("minima").alias("hash"))
    several = (
        rows.groupBy("hash").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b")).filter("_a < _b").select("hash")
    )
    found = rows.join(several, "hash").groupBy("doc_id", "fp").agg(F.collect_set("hash").alias("hits"))
    return kept(found, "shared-minima")


def with_fingerprint(docs: DataFrame, fp: str = "_fp", read: str = "_text_read") -> DataFrame:
    """`docs` with the fingerprint of each row's words in column `fp` and the text as string in `read`, without a shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.schema.get_field_index(read))
        prints, _ = fingerprints(split_words(texts, fold=False))
        return batch.set_column(batch.schema.get_field_index(fp), fp, pa.array(prints))

    named = docs.withColumn(read, F.col("text").cast("string")).withColumn(fp, F.lit(0).cast("long"))
    return named.mapInArrow(by_slices(run, read), named.schema)


def owned(windows: DataFrame, places: bool = True) -> DataFrame:
    """Of (a, b, doc_id, fp, pos): the windows that occur under several doc_ids, with their smallest doc_id as `owner`.

    `places` adds the smallest place of each (owner_fp, owner_pos). A window in every document costs one row per task
    before the shuffle; the owners are written first, so that the join back is one that splits a hot window's rows.
    """
    first = F.min(F.struct("doc_id", "fp", "pos")) if places else F.min("doc_id")
    found = windows.groupBy("a", "b").agg(first.alias("_o"), F.max("doc_id").alias("_last"))
    if places:
        columns = [F.col("_o.doc_id").alias("owner"), F.col("_o.fp").alias("owner_fp"), F.col("_o.pos").alias("owner_pos")]
        owners = found.filter("_o.doc_id < _last").select("a", "b", *columns)
    else:
        owners = found.filter("_o < _last").select("a", "b", F.col("_o").alias("owner"))
    return windows.join(kept(owners, "owners"), ["a", "b"]).drop("a", "b")


def window_rows(texts: pa.Array, doc: np.ndarray, fp: np.ndarray, length: int, chosen) -> pa.RecordBatch | None:
    """Rows (a, b, doc_id, fp, pos) of the windows that `chosen(words, text, pos)` marks."""
    words = split_words(texts, fold=False)
    if len(words.hash) < length:
        return None
    text = words.text()
    at = np.flatnonzero(text[: len(text) - length + 1] == text[length - 1 :])
    at = at[chosen(words, text[at], at - words.first[text[at]])]
    if not len(at):
        return None
    pair = [run_hashes(words.hash, length, base)[at].view(np.int64) for base in _BASES]
    owner = text[at]
    pos = (at - words.first[owner]).astype(np.int32)
    return pa.record_batch(
        [pa.array(pair[0]), pa.array(pair[1]), pa.array(doc[owner]), pa.array(fp[owner]), pa.array(pos)], ["a", "b", "doc_id", "fp", "pos"]
    )


WINDOW_ROW = "a long, b long, doc_id long, fp long, pos int"


def islands(rows: DataFrame, keys: list[str], along: Column, at: str = "pos") -> DataFrame:
    """Runs of neighbouring places: (keys, start, n) of rows of one document that follow each other with equal `along`.

    A window over one document, so its size is bounded by the longest text.
    """
    order = Window.partitionBy("doc_id", "fp").orderBy(at)
    numbered = rows.withColumn("_along", along).withColumn(
        "_new", (F.coalesce((F.lag(at).over(order) != F.col(at) - 1) | (F.lag("_along").over(order) != F.col("_along")), F.lit(True))).cast("int")
    )
    runs = numbered.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc_id", "fp", "_run", *keys).agg(F.min(at).alias("start"), F.count("*").alias("n")).drop("_run")


def without_spans(docs: DataFrame, spans: DataFrame, copied: DataFrame, length: int) -> DataFrame:
    """`docs` with text rewritten and n_words, n_removed, kept_sha256 added, less the words of `spans` (doc_id, fp, start, n).

    A span of n windows covers n + length - 1 words. Of a copy nothing stays. Words left in a text keep the white space
    before them; kept_sha256 is over the words left, joined by single spaces. Columns of `docs` with the added names are
    replaced, all others stay.
    """
    places = F.struct(F.col("start").cast("int").alias("start"), (F.col("start") + F.col("n") + length - 1).cast("int").alias("end"))
    base = [c for c in docs.columns if c.lower() not in ADDED]
    fp, read, found, ident = (free_name(base, name) for name in ("fp", "text_read", "spans", "id"))
    cut = spans.groupBy("doc_id", "fp").agg(F.collect_list(places).alias(found))
    whole = copied.select("doc_id", "fp", F.array(F.struct(F.lit(0).alias("start"), F.lit(2**31 - 1).alias("end"))).alias(found))
    cut = cut.unionByName(whole).select(F.col("doc_id").alias(ident), F.col("fp").alias(f"{fp}_cut"), found)
    named = with_fingerprint(docs.select(*(f"`{c}`" for c in base)), fp, read)
    # Text is shuffled whatever the size: a broadcast of the spans would grow with the corpus.
    same = (named["doc_id"].cast("long") == cut[ident]) & (named[fp] == cut[f"{fp}_cut"])
    joined = named.join(cut.hint("merge"), same, "left").select(*(named[f"`{c}`"] for c in base), read, found)
    text_at = base.index("text")
    kinds = ", ".join(f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in joined.schema.fields[: len(base)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(len(base))
        words = split_words(texts, fold=False)
        spans_of = batch.column(len(base) + 1).to_pylist()
        raw = texts.to_pylist()
        counts = np.diff(words.first)
        removed, digests, left = np.zeros(len(counts), np.int64), [], []
        view = words.data.tobytes()
        for i, places in enumerate(spans_of):
            low, high = int(words.first[i]), int(words.first[i + 1])
            start, end = words.start[low:high], words.end[low:high]
            keep = np.ones(high - low, bool)
            for place in places or ():
                keep[place["start"] : min(place["end"], high - low)] = False
            removed[i] = len(keep) - keep.sum()
            chosen = [view[a:b] for a, b in zip(start[keep].tolist(), end[keep].tolist())]
            digests.append(hashlib.sha256(b" ".join(chosen)).hexdigest())
            if not removed[i]:
                left.append(raw[i])
                continue
            before = np.concatenate([[start[0]], end[:-1]])
            left.append(b"".join(view[a:b] for a, b in zip(before[keep].tolist(), end[keep].tolist())).strip().decode("utf-8", "replace"))
        columns = list(batch.columns[: len(base)])
        columns[text_at] = pa.array(left, pa.string())
        columns += [pa.array(counts), pa.array(removed), pa.array(digests, pa.string())]
        return pa.record_batch(columns, [*base, "n_words", "n_removed", "kept_sha256"])

    return joined.mapInArrow(by_slices(run, read), f"{kinds}, n_words long, n_removed long, kept_sha256 string")
