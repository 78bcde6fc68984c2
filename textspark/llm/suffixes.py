"""Long repeated passages by sparse suffix arrays.

Suffixes are kept at minimiser positions only: every passage of `SPAN` = 50 words has a position where the smallest
8-word gram of the passage begins, and equal passages have it at the same place. Suffixes whose gram occurs under one
doc_id alone are dropped. The rest are sorted by what follows the gram and compared with their neighbours, which gives
the longest match to the right; sorted by what precedes it (nearest word first), they give the longest to the left.
Where both together reach 50 words, the match is extended: the 50-word windows inside its reach are compared exactly,
and those that occur under a smaller doc_id are repeats.

Both sorts are range partitioned over the whole key with the place as last part, so a passage in a third of all
documents is spread over many tasks; at the border of a partition a match counts as longest possible, which only adds
windows to the exact comparison. A suffix carries 42 words either way, whatever the text's length.

Defined results: words are taken unchanged; null, empty and short texts lose nothing; rows with a null doc_id take no
part and lose nothing; a doc_id's own repetitions do not count; of documents with equal words all but the smallest
doc_id lose everything from 50 words up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.llm.repeats import WINDOW_ROW, copies, islands, outlines, owned, shared_minima, window_rows, with_fingerprint, without_spans
from textspark.llm.storage import by_slices, dropped, kept
from textspark.llm.words import first_of_runs, run_hashes, split_words

SPAN = 50
GRAM = 8


def suffix_rows(texts: DataFrame, span: int, gram: int) -> DataFrame:
    """(hash, ahead, behind, doc_id, fp, pos) of the suffixes at shared minimisers; contexts are words as 4 bytes each."""
    reach = span - gram

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        words = split_words(batch.column(2), fold=False)
        if len(words.hash) < span:
            return None
        text = words.text()
        hashes = run_hashes(words.hash, gram)
        hits = batch.column(3)
        values = np.asarray(hits.flatten()).view(np.uint64)
        ends = np.cumsum(np.asarray(pa.compute.list_value_length(hits)))
        marks = np.zeros(len(hashes), bool)
        for i in range(batch.num_rows):
            a, b = words.first[i], words.first[i + 1] - gram + 1
            if a < b:
                marks[a:b] = np.isin(hashes[a:b], values[(ends[i - 1] if i else 0) : ends[i]])
        at = np.flatnonzero(marks)
        if not len(at):
            return None
        # Zero stands for what lies outside the text, on both sides.
        padded = np.concatenate([[0], (words.hash >> np.uint64(32)).astype(">u4") | np.uint32(1), [0]])
        steps = np.arange(reach)
        owner = text[at]
        ahead, behind = at[:, None] + gram + steps, at[:, None] - 1 - steps
        ahead = np.where(ahead < words.first[owner + 1][:, None], ahead + 1, 0)
        behind = np.where(behind >= words.first[owner][:, None], behind + 1, 0)
        wide = pa.binary(4 * reach)
        sides = [
            pa.FixedSizeBinaryArray.from_buffers(wide, len(at), [None, pa.py_buffer(padded[x].astype(">u4").tobytes())]).cast(pa.binary())
            for x in (ahead, behind)
        ]
        doc, fp = np.asarray(batch.column(0))[owner], np.asarray(batch.column(1))[owner]
        pos = (at - words.first[owner]).astype(np.int32)
        return pa.record_batch(
            [pa.array(hashes[at].view(np.int64)), *sides, pa.array(doc), pa.array(fp), pa.array(pos)],
            ["hash", "ahead", "behind", "doc_id", "fp", "pos"],
        )

    schema = "hash long, ahead binary, behind binary, doc_id long, fp long, pos int"
    return kept(texts.mapInArrow(by_slices(run), schema), "suffixes")


def neighbour_matches(rows: DataFrame, side: str, name: str, reach: int) -> DataFrame:
    """`rows` less the column `side`, with the longest match of that context among suffixes of the same gram."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["hash", side, "doc_id", "fp", "pos"]
    at, names = rows.columns.index(side), [c for c in rows.columns if c != side] + [name]
    key = rows.columns.index("hash")

    def matches(table: pa.Table, opened: bool, closed: bool) -> pa.RecordBatch:
        batch = table.combine_chunks().to_batches()[0]
        context = np.frombuffer(b"".join(batch.column(at).to_pylist()), np.uint32).reshape(-1, reach)
        hashes = np.asarray(batch.column(key))
        equal = np.logical_and.accumulate(context[1:] == context[:-1], axis=1).sum(axis=1) * ~first_of_runs(hashes)[1:]
        before, after = np.concatenate([[reach], equal]), np.concatenate([equal, [reach]])
        longest = np.maximum(before, after)
        low, high = (0 if opened else 1), (len(longest) if closed else len(longest) - 1)
        columns = [c for i, c in enumerate(batch.columns) if i != at]
        return pa.record_batch([*columns, pa.array(longest.astype(np.int32))], names).slice(low, high - low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, opened = None, True
        for batch in batches:
            if held is not None:
                table = pa.Table.from_batches([*held, batch])
                yield matches(table, opened, False)
                opened = False
                held = [table.slice(table.num_rows - 2).combine_chunks().to_batches()[0]]
            else:
                held = [batch]
        if held is not None:
            yield matches(pa.Table.from_batches(held), opened, True)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != side) + f", {name} int"
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, schema)


def repeated_windows(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Runs (doc_id, fp, start, n) of windows that also occur under a smaller doc_id, and the copies."""
    outline = outlines(docs, span, gram)
    copied = copies(outline, span)
    hits = shared_minima(outline, copied)
    dropped(outline)
    named = with_fingerprint(docs.select(F.col("doc_id").cast("long"), "text"))
    named = named.select("doc_id", F.col("_fp").alias("fp"), F.col("_text_read").alias("text"))
    texts = kept(named.join(hits.hint("merge"), ["doc_id", "fp"]).select("doc_id", "fp", "text", "hits"), "suffix-texts")
    rows = suffix_rows(texts, span, gram)
    right = kept(neighbour_matches(rows, "ahead", "r", span - gram), "ahead")
    both = neighbour_matches(right, "behind", "l", span - gram)
    reaches = (
        both.filter(F.col("l") + gram + F.col("r") >= span)
        .select("doc_id", "fp", (F.col("pos") - F.col("l")).alias("low"), (F.col("pos") + gram + F.col("r") - span).alias("high"))
        .groupBy("doc_id", "fp")
        .agg(F.collect_list(F.struct("low", "high")).alias("reach"))
    )
    reaches = kept(reaches, "reaches")
    dropped(rows, right)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        doc, fp = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        reach = batch.column(3)
        ends = np.cumsum(np.asarray(pa.compute.list_value_length(reach)))
        flat = reach.flatten()
        low, high = np.asarray(flat.field("low")), np.asarray(flat.field("high"))

        def chosen(words, text, pos):
            # Window starts inside some reach: the running sum of openings less closings is positive.
            sizes = np.diff(words.first) + 2
            base = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
            total = np.zeros(int(sizes.sum()) + 1, np.int64)
            np.add.at(total, base[owner] + np.clip(low, 0, sizes[owner] - 1), 1)
            np.add.at(total, base[owner] + np.clip(high + 1, 0, sizes[owner] - 1), -1)
            return np.cumsum(total)[base[text] + pos] > 0

        return window_rows(batch.column(2), doc, fp, span, chosen)

    found = texts.select("doc_id", "fp", "text").join(reaches.hint("merge"), ["doc_id", "fp"]).mapInArrow(by_slices(run), WINDOW_ROW)
    windows = kept(found, "windows")
    later = owned(windows, places=False).filter(F.col("doc_id") > F.col("owner")).select("doc_id", "fp", "pos")
    runs = kept(islands(later, [], F.lit(0)), "runs")
    dropped(hits, texts, reaches, windows)
    return runs, copied


def without_passages(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """`docs` less every word of a passage of at least `span` words that a smaller doc_id holds too.

    The text is rewritten; n_words, n_removed and kept_sha256 are added.
    """
    runs, copied = repeated_windows(docs, span, gram)
    return kept(without_spans(docs, runs, copied, span), "without-passages")
