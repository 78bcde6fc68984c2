"""Keyword replacement from a dictionary table of any size: one pass over the text, whatever the number of keywords.

A dictionary of up to PORTION_BYTES, the usual case, becomes an automaton that is broadcast and finds all of its keywords
in a text at once; texts never move. A larger one stays a table: texts are put into chunks of bounded size, the distinct
pieces of a chunk are joined to the dictionary, and a chunk meets the keywords it holds. The work grows with the texts
and the dictionary apart, not with their product, and a task holds one chunk and its keywords. Either way texts are
resolved left to right, the longest keyword first, as `clean.replace_keywords` does for a short list.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.plans.lineage import durable

#: Bytes of keywords and replacements that are broadcast; their automaton takes some fifty times as much in a task.
PORTION_BYTES = 4 << 20
#: Bytes of text in a chunk, for larger dictionaries. A longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: A keyword covers whole pieces: it begins and ends where a word does, or at a character outside words.
PIECE = re.compile(r"\w+|\W")
Hit = tuple[int, int, str]


def _folded(text: str) -> str:
    """Lower case letter by letter, so places stay the same."""
    lower = text.lower()
    return lower if len(lower) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _in_word(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


def _automaton(entries: list[tuple[str, str]]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for keyword, target in entries:
        machine.add_word(keyword, (len(keyword), target))
    machine.make_automaton()
    return machine


def _hits(machine: ahocorasick.Automaton, text: str, folded: str) -> list[Hit]:
    """All whole-word hits: no word goes on over the end, nor over the start of a keyword that begins in a word."""
    found = []
    for last, (size, target) in machine.iter(folded):
        start = last + 1 - size
        if not _in_word(text, last + 1) and not (_in_word(text, start) and _in_word(text, start - 1)):
            found.append((start, last + 1, target))
    return found


def _resolved(text: str, hits: list[Hit]) -> str:
    if not hits:
        return text
    out, at = [], 0
    for start, stop, target in sorted(hits, key=lambda h: (h[0], -h[1])):
        if start >= at:
            out += [text[at:start], target]
            at = stop
    return "".join(out) + text[at:]


def _prepared(dictionary: DataFrame, keyword: str, replacement: str, case_sensitive: bool) -> DataFrame:
    """(keyword, replacement, head, pieces), one row a keyword: of several replacements the smallest; null ones are empty."""
    key = F.col(keyword) if case_sensitive else F.lower(keyword)
    named = dictionary.select(key.alias("keyword"), F.coalesce(replacement, F.lit("")).alias("replacement"))
    entries = named.filter("keyword <> ''").groupBy("keyword").agg(F.min("replacement").alias("replacement"))

    @F.pandas_udf("struct<head: string, pieces: int>")
    def cut(keywords: pd.Series) -> pd.DataFrame:
        pieces = [PIECE.findall(k) for k in keywords]
        return pd.DataFrame({"head": [p[0] for p in pieces], "pieces": [len(p) for p in pieces]})

    return durable(entries.withColumn("_cut", cut("keyword")).select("keyword", "replacement", "_cut.*"))


def replace_from_table(
    df: DataFrame, text: str, dictionary: DataFrame, keyword: str = "keyword", replacement: str = "replacement", case_sensitive: bool = False
) -> DataFrame:
    """`df` with the keywords of the dictionary replaced in the column `text`; null texts stay null."""
    spark = df.sparkSession
    entries = _prepared(dictionary, keyword, replacement, case_sensitive)
    size = entries.agg(F.sum(F.octet_length("keyword") + F.octet_length("replacement") + 16)).first()[0] or 0
    if not size:
        return df
    fold = (lambda s: s) if case_sensitive else _folded
    if size > PORTION_BYTES:
        return _by_chunk(df, text, entries, fold)
    whole = spark.sparkContext.broadcast([tuple(r) for r in entries.select("keyword", "replacement").collect()])

    @F.pandas_udf("string")
    def replaced(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = _automaton(whole.value)
        for batch in batches:
            yield batch.map(lambda t: None if t is None else _resolved(t, _hits(machine, t, fold(t))))

    return df.withColumn(text, replaced(F.col(text)))


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name


def _chunked(df: DataFrame, text: str, name: str) -> DataFrame:
    """`df` with a chunk number: neighbouring rows of at most CHUNK_BYTES of text together, or a single row."""
    limit = CHUNK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            chunks = []
            for size in pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist():
                if held and held + size > limit:
                    number, held = number + 1, 0
                held += size
                chunks.append(number)
            yield batch.append_column(name, pa.array(chunks, pa.int64()))

    # The numbers hold for every later use only because the rows are written down.
    return durable(df.mapInArrow(run, df.withColumn(name, F.lit(0).cast("long")).schema))


def _heads(chunks: DataFrame, text: str, name: str, fold) -> DataFrame:
    """(chunk, head): the distinct pieces of each chunk."""

    def batch_of(number: int, seen: set) -> pa.RecordBatch:
        return pa.record_batch([pa.array([number] * len(seen), pa.int64()), pa.array(list(seen), pa.string())], ["chunk", "head"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, set()
        for batch in batches:
            for number, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if number != now:
                    if seen:
                        yield batch_of(now, seen)
                    now, seen = number, set()
                if value.is_valid:
                    seen.update(PIECE.findall(fold(value.as_py())))
        if seen:
            yield batch_of(now, seen)

    return chunks.select(name, text).mapInArrow(run, "chunk long, head string")


def _runs(value: str, folded: str, sizes: dict[str, list[int]]) -> Iterator[tuple[int, int, list[str], list[int]]]:
    """(first piece, number of pieces, pieces, starts) wherever a keyword of that length could stand, longest first."""
    starts = [m.start() for m in PIECE.finditer(value)] + [len(value)]
    pieces = [folded[a:b] for a, b in zip(starts, starts[1:])]
    for i, piece in enumerate(pieces):
        for n in sizes.get(piece, ()):
            if i + n <= len(pieces) and not _in_word(value, starts[i + n]):
                yield i, n, pieces, starts


def _swapped(value: str, folded: str, targets: dict[str, str], sizes: dict[str, list[int]]) -> str:
    out, at = [], 0
    for i, n, _, starts in _runs(value, folded, sizes):
        start, stop = starts[i], starts[i + n]
        if start >= at and (target := targets.get(folded[start:stop])) is not None:
            out += [value[at:start], target]
            at = stop
    return "".join(out) + value[at:]


def _by_chunk(df: DataFrame, text: str, entries: DataFrame, fold) -> DataFrame:
    name = _free(df, "chunk")
    chunks = _chunked(df, text, name)
    heads = _heads(chunks, text, name, fold)
    if entries.agg(F.max("pieces")).first()[0] == 1:
        present = heads.withColumnRenamed("head", "keyword")
    else:
        sizes = entries.groupBy("head").agg(F.sort_array(F.collect_set("pieces"), asc=False).alias("sizes"))

        def sequences(left: pa.Table, right: pa.Table) -> pa.Table:
            known = dict(zip(right["head"].to_pylist(), right["sizes"].to_pylist()))
            seen = set()
            for value in left[text]:
                if value.is_valid:
                    value = value.as_py()
                    folded = fold(value)
                    seen.update(folded[s[i] : s[i + n]] for i, n, _, s in _runs(value, folded, known))
            number = (left[name] if left.num_rows else right["chunk"])[0].as_py()
            return pa.table({"chunk": pa.array([number] * len(seen), pa.int64()), "keyword": pa.array(list(seen), pa.string())})

        met = chunks.select(name, text).groupBy(name).cogroup(heads.join(sizes, "head").groupBy("chunk"))
        present = met.applyInArrow(sequences, "chunk long, keyword string")
    found = present.join(entries, "keyword").select("chunk", "keyword", "replacement", "head", "pieces")
    columns = df.columns

    def replaced(left: pa.Table, right: pa.Table) -> pa.Table:
        targets = dict(zip(right["keyword"].to_pylist(), right["replacement"].to_pylist()))
        sizes: dict[str, list[int]] = {}
        for head, n in sorted(set(zip(right["head"].to_pylist(), right["pieces"].to_pylist())), key=lambda x: -x[1]):
            sizes.setdefault(head, []).append(n)
        values = (v.as_py() for v in left[text])
        new = pa.array([None if v is None else _swapped(v, fold(v), targets, sizes) for v in values], pa.string())
        return left.select(columns).set_column(columns.index(text), text, new)

    return chunks.groupBy(name).cogroup(found.groupBy("chunk")).applyInArrow(replaced, df.schema)


def remove_from_table(df: DataFrame, text: str, words: DataFrame, keyword: str = "keyword", case_sensitive: bool = False) -> DataFrame:
    """`df` with every stop word of the table made one space."""
    return replace_from_table(df, text, words.select(F.col(keyword).alias("keyword"), F.lit(" ").alias("replacement")), case_sensitive=case_sensitive)
