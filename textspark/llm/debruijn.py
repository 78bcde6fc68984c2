"""Repeated passages by a de Bruijn graph over words: repeated k-word windows are edges, compacted into paths.

An edge is a window of `K` = 13 words that occurs under several doc_ids, known by its source coordinates: the smallest
(doc_id, text, place) it occurs at. Edges that follow each other at their source are linked; a document that goes on
elsewhere shows itself as a link that leaves or enters between source neighbours, and those are the branches. Paths are
the runs between branches; an unbranched link between two runs of different sources joins them, by joins that double
their reach. A path is kept as the stretches of source places it goes through, in order.

What is removed are occurrences of paths: a document's run along a source is expanded over the stretches that it goes
through, by their number at the source, held against their coordinates there, and put together again along each path.
A document that leaves a path at its own end, which is no branch, holds a part of it.

Only edges found through shared minimisers become rows, a path's occurrence is one row, and nothing is collected.

Defined results: words are taken unchanged; a null text has no words; texts with fewer than K words lose nothing; rows
with a null doc_id take no part and lose nothing; a doc_id's own repetitions do not count.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textspark.llm.repeats import WINDOW_ROW, copies, islands, outlines, owned, shared_minima, window_minima, window_rows, with_fingerprint, without_spans
from textspark.llm.storage import by_slices, dropped, kept

K = 13
GRAM = 5


def _candidates(docs: DataFrame, hits: DataFrame, length: int, gram: int) -> DataFrame:
    """Rows of the windows whose minimiser is shared."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        doc, fp = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        own = batch.column(3)
        values = np.asarray(own.flatten()).view(np.uint64)
        ends = np.cumsum(np.asarray(pa.compute.list_value_length(own)))

        def chosen(words, text, pos):
            minima, of = window_minima(words, length, gram)
            marks = np.zeros(len(minima), bool)
            edges = np.searchsorted(of, np.arange(batch.num_rows + 1))
            for i in range(batch.num_rows):
                a, b = edges[i], edges[i + 1]
                if a < b:
                    marks[a:b] = np.isin(minima[a:b], values[(ends[i - 1] if i else 0) : ends[i]])
            return marks

        return window_rows(batch.column(2), doc, fp, length, chosen)

    texts = with_fingerprint(docs.select(F.col("doc_id").cast("long"), "text")).select("doc_id", F.col("_fp").alias("fp"), F.col("_text_read").alias("text"))
    return texts.join(hits.hint("merge"), ["doc_id", "fp"]).mapInArrow(by_slices(run), WINDOW_ROW)


def repeated_edges(docs: DataFrame, k: int = K, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Every occurrence of a repeated edge with its source (doc_id, fp, pos, owner, owner_fp, owner_pos), and the copies."""
    outline = outlines(docs, k, gram)
    copied = copies(outline, k)
    hits = shared_minima(outline, copied)
    windows = kept(_candidates(docs, hits, k, gram), "windows")
    places = kept(owned(windows), "places")
    dropped(outline, hits, windows)
    return places, copied


def occurrences(places: DataFrame) -> DataFrame:
    """(doc_id, fp, start, n, owner, owner_fp, owner_start): maximal runs of a document along the source of its edges."""
    runs = islands(places, ["owner", "owner_fp", "_along"], F.struct("owner", "owner_fp", (F.col("pos") - F.col("owner_pos")).alias("shift")))
    return runs.select("doc_id", "fp", "start", "n", "owner", "owner_fp", (F.col("start") - F.col("_along.shift")).alias("owner_start"))


def paths(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths (owner, owner_fp, from, to, path): runs of source places between branches, and the path each belongs to.

    A run of a document that begins or ends inside the source's own run is a branch there: it cuts the path.
    """
    sources = runs.filter((F.col("doc_id") == F.col("owner")) & (F.col("fp") == F.col("owner_fp"))).select(
        "owner", "owner_fp", F.col("start").alias("_low"), (F.col("start") + F.col("n")).alias("_high")
    )
    ends = F.explode(F.array("owner_start", F.col("owner_start") + F.col("n")))
    cuts = runs.select("owner", "owner_fp", ends.alias("cut")).distinct()
    order = Window.partitionBy("owner", "owner_fp").orderBy("cut")
    pieces = cuts.withColumn("to", F.lead("cut").over(order)).filter("to IS NOT NULL")
    pieces = pieces.join(sources, ["owner", "owner_fp"]).filter("cut >= _low AND to <= _high").select("owner", "owner_fp", F.col("cut").alias("from"), "to")
    pieces = kept(pieces.withColumn("piece", F.xxhash64("owner", "owner_fp", "from")), "pieces")
    # A document that steps from the end of one piece to the start of another one.
    order = Window.partitionBy("doc_id", "fp").orderBy("start")
    follows = runs.withColumn("_next", F.lead(F.struct("start", "owner", "owner_fp", "owner_start")).over(order)).filter("_next.start = start + n")
    left = follows.select(
        "owner", "owner_fp", (F.col("owner_start") + F.col("n")).alias("to"), F.col("_next.owner").alias("_o"), F.col("_next.owner_fp").alias("_f"), F.col("_next.owner_start").alias("_s")
    )
    inner = pieces.alias("p").join(
        pieces.alias("q"), (F.col("p.owner") == F.col("q.owner")) & (F.col("p.owner_fp") == F.col("q.owner_fp")) & (F.col("p.to") == F.col("q.from"))
    ).select(F.col("p.piece").alias("one"), F.col("q.piece").alias("two"))
    outer = (
        left.join(pieces.select("owner", "owner_fp", "to", F.col("piece").alias("one")), ["owner", "owner_fp", "to"])
        .join(pieces.select(F.col("owner").alias("_o"), F.col("owner_fp").alias("_f"), F.col("from").alias("_s"), F.col("piece").alias("two")), ["_o", "_f", "_s"])
        .select("one", "two")
    )
    arcs = outer.unionByName(inner).distinct()
    single_out = arcs.groupBy("one").agg(F.min("two").alias("two"), F.max("two").alias("_m")).filter("two = _m").drop("_m")
    single_in = arcs.groupBy("two").agg(F.min("one").alias("one"), F.max("one").alias("_m")).filter("one = _m").drop("_m")
    return pieces, kept(single_out.join(single_in, ["one", "two"]), "arcs")


def compacted(pieces: DataFrame, arcs: DataFrame) -> DataFrame:
    """`pieces` with `path`, the first piece of the unbranched path each lies on, and `at`, the edges before it on the path.

    By joins that double their reach.
    """
    before = arcs.join(pieces.select(F.col("piece").alias("one"), (F.col("to") - F.col("from")).alias("size")), "one")
    heads = pieces.select("piece").join(before.select(F.col("two").alias("piece"), F.col("one").alias("up"), "size"), "piece", "left")
    heads = kept(heads.select("piece", F.coalesce("up", "piece").alias("up"), F.coalesce("size", F.lit(0)).cast("long").alias("at")), "heads")
    for _ in range(max(1, math.ceil(math.log2(heads.count() + 1)))):
        above = heads.select(F.col("piece").alias("up"), F.col("up").alias("_next"), F.col("at").alias("_more"))
        step = heads.join(above, "up").select("piece", F.col("_next").alias("up"), (F.col("at") + F.col("_more")).alias("at"), (F.col("_next") != F.col("up")).alias("_moved"))
        step = kept(step, "heads")
        moved = not step.filter("_moved").isEmpty()
        dropped(heads)
        heads = step.drop("_moved")
        if not moved:
            break
    # A ring has no first piece; its pieces stay single.
    roots = heads.filter("piece = up").select(F.col("piece").alias("up"), F.lit(True).alias("_root"))
    path, at = F.when(F.col("_root"), F.col("up")).otherwise(F.col("piece")), F.when(F.col("_root"), F.col("at")).otherwise(F.lit(0))
    placed = heads.join(roots, "up", "left").select("piece", path.alias("path"), at.cast("long").alias("at"))
    return pieces.join(placed, "piece")


def numbered(placed: DataFrame) -> DataFrame:
    """`placed` with `stretch`: pieces of one source that follow each other on one path have the same number at the source.

    A window over one source text.
    """
    order = Window.partitionBy("owner", "owner_fp").orderBy("from")
    ends = F.lag(F.struct("path", "to", (F.col("at") + F.col("to") - F.col("from")).alias("at"))).over(order)
    same = (ends.path == F.col("path")) & (ends.to == F.col("from")) & (ends.at == F.col("at"))
    new = placed.withColumn("_new", (~F.coalesce(same, F.lit(False))).cast("int"))
    return new.withColumn("stretch", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def stretches(pieces: DataFrame) -> DataFrame:
    """(owner, owner_fp, stretch, from, to, path, at): the source places each path goes through, one row a stretch."""
    ends = [F.min("from").alias("from"), F.max("to").alias("to"), F.min("path").alias("path"), F.min("at").alias("at")]
    return pieces.groupBy("owner", "owner_fp", "stretch").agg(*ends)


def path_occurrences(runs: DataFrame, pieces: DataFrame) -> DataFrame:
    """(doc_id, fp, path, at, start, n): the edges of each path that a document of `runs` holds without a gap.

    Windows start..start+n-1 of the document are the edges at..at+n-1 of the path. `pieces` are numbered.
    """
    source = ["owner", "owner_fp"]
    # A run lies on whole pieces of its source: the pieces it begins and ends with give the first and last stretch.
    first = pieces.select(*source, F.col("from").alias("owner_start"), F.col("stretch").alias("_first"))
    last = pieces.select(*source, F.col("to").alias("_end"), F.col("stretch").alias("_last"))
    through = runs.withColumn("_end", F.col("owner_start") + F.col("n")).join(first, [*source, "owner_start"]).join(last, [*source, "_end"])
    crossed = through.withColumn("stretch", F.explode(F.sequence("_first", "_last"))).drop("n", "_first", "_last")
    low, high = F.greatest("from", "owner_start"), F.least("to", "_end")
    # Held against the source: only places that both the run and the stretch have.
    # Written first, so that the join is one that splits the runs along a hot source.
    found = crossed.join(kept(stretches(pieces), "stretches"), [*source, "stretch"]).filter(low < high)
    parts = found.select(
        "doc_id", "fp", "path", (F.col("start") + low - F.col("owner_start")).alias("start"), (F.col("at") + low - F.col("from")).alias("at"), (high - low).alias("n")
    )
    order = Window.partitionBy("doc_id", "fp").orderBy("start")
    ends = F.lag(F.struct("path", (F.col("start") + F.col("n")).alias("start"), (F.col("at") + F.col("n")).alias("at"))).over(order)
    same = (ends.path == F.col("path")) & (ends.start == F.col("start")) & (ends.at == F.col("at"))
    new = parts.withColumn("_new", (~F.coalesce(same, F.lit(False))).cast("int"))
    joined = new.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return joined.groupBy("doc_id", "fp", "_run", "path").agg(F.min("at").alias("at"), F.min("start").alias("start"), F.sum("n").alias("n")).drop("_run")


def repeated_paths(docs: DataFrame, k: int = K, gram: int = GRAM) -> DataFrame:
    """(owner, owner_fp, stretch, from, to, path, at): compacted paths by their source; windows from..to-1 of that text are
    the edges of `path` from its edge `at` on."""
    places, _ = repeated_edges(docs, k, gram)
    return stretches(numbered(compacted(*paths(kept(occurrences(places), "runs")))))


def without_repeats(docs: DataFrame, k: int = K, gram: int = GRAM) -> DataFrame:
    """`docs` less every word covered by a k-word window that also starts in a document with a smaller doc_id.

    Adds n_words, n_removed and kept_sha256. Each removed span is an occurrence of a path away from its source.
    """
    places, copied = repeated_edges(docs, k, gram)
    runs = kept(occurrences(places), "runs")
    dropped(places)
    pieces, arcs = paths(runs)
    placed = kept(numbered(compacted(pieces, arcs)), "placed")
    held = path_occurrences(runs.filter(F.col("doc_id") > F.col("owner")), placed)
    out = kept(without_spans(docs, held.select("doc_id", "fp", "start", "n"), copied, k), "without-repeats")
    dropped(runs, pieces, arcs, placed)
    return out
