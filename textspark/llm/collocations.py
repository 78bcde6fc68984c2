"""Phrase collocations by set-oriented relational mining (SETM), in Spark joins over chunks of documents.

The occurrence relation R1 (position, word) of a chunk is written sorted by position; positions run through a chunk and
skip one between pieces, so adjacent words of one piece have adjacent positions. Level by level, the relation Rk of
frequent k-word phrases is merge-joined with itself at the adjacent position, which gives the occurrences of all
(k + 1)-word phrases whose k-word parts are frequent. Their counts are grouped over the corpus, and a semi-join with the
groups that are frequent keeps only their occurrences in R(k + 1), which is written.

Counting moves a row for each distinct phrase of some chunks, so a phrase that fills a language has few rows.
Phrases are known by 64-bit hashes of their words and language; that two of m phrases agree has a chance of m^2 / 2^65.

Defined results: null texts are empty; null languages are `und`; repeated rows count each time; empty tables, and texts
without words, give no rows; a phrase never spans pieces or documents. A very long text is a chunk of its own, handled
whole in one task. Only text and lang are read, so names of other columns are free.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.llm.chunks import answered, chunk_ids, in_chunks
from textspark.llm.storage import dropped, kept
from textspark.llm.words import first_of_runs, mix, split_words
from textspark.plans.ranking import top_k_per_group

#: Bytes of text in a chunk; the arrays of a step need some forty times as much.
CHUNK_BYTES = 3 << 20
LEAST = 100
LONGEST = 5
#: Keys of phrases held at once beside a chunk (24 bytes each), and rows handed over at once; a chunk's rows are few.
KEYS = 1 << 20
BATCH = 10_000
#: Chunks that a task passes on, writes or reads at once.
ROWS = 4
BEST = 2000
_BREAK, _BETWEEN = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN[[*b" \t", *np.flatnonzero(_BREAK)]] = True
_HEAD, _TAIL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _narrow(name: str, values: np.ndarray) -> np.ndarray:
    """Positions as gaps, and numbers that are never negative in as few bytes as they need."""
    if name.startswith("pos"):
        values = np.diff(values, prepend=0)
    if name.startswith(("pos", "phrase", "code", "step", "word_size", "word_lang")):
        values = values.astype(np.min_scalar_type(values.max(initial=0)))
    return values


def packed(**arrays: np.ndarray) -> bytes:
    """Arrays as one Arrow stream of a single row."""
    arrays = {name: _narrow(name, values) for name, values in arrays.items()}
    columns = [pa.LargeListArray.from_arrays(pa.array([0, len(v)], pa.int64()), pa.array(v)) for v in arrays.values()]
    batch = pa.record_batch(columns, list(arrays))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(blob: bytes) -> dict[str, np.ndarray]:
    batch = pa.ipc.open_stream(blob).read_next_batch()
    arrays = {name: column.values.to_numpy(zero_copy_only=False) for name, column in zip(batch.schema.names, batch.columns)}
    return {name: np.cumsum(v, dtype=np.int64) if name.startswith("pos") else v for name, v in arrays.items()}


def _words(part: list[pa.RecordBatch]) -> tuple[dict[str, np.ndarray], list[str], np.ndarray]:
    """R1 of a chunk with the dictionary of its words, its languages and their numbers of words."""
    keys, steps, texts, langs, of = [], [], [], [], []
    names: dict[str, int] = {}
    for piece in part:
        words = split_words(piece.column(0), blank=_BETWEEN)
        named = piece.column(1).fill_null("und").to_pylist()
        number = np.array([names.setdefault(x, len(names)) for x in named], np.int64)
        text = words.text()
        breaks = np.concatenate([[0], np.cumsum(_BREAK[words.data])])[words.start]
        step = np.ones(len(text), np.int32)
        if len(step):
            step[1:] += (np.diff(breaks) > 0) | (np.diff(text) > 0)
            step[0] = 2  # slices begin with a new document
        salt = np.array([xxhash.xxh64_intdigest(x) for x in named], np.uint64)
        keys.append(mix(words.hash ^ mix(salt)[text]).view(np.int64))
        steps.append(step)
        langs.append(number[text])
        texts.append(words)
        of.append(np.full(len(text), len(of)))
    key, first, code = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    lang, of = np.concatenate(langs), np.concatenate(of)
    begun = np.cumsum([0, *map(len, keys)])
    spelled = [texts[of[i]].data[texts[of[i]].start[i - begun[of[i]]] : texts[of[i]].end[i - begun[of[i]]]] for i in first.tolist()]
    state = {
        "step": np.concatenate(steps),
        "code": code,
        "key": key,
        "word_lang": lang[first],
        "word_size": np.array([len(x) for x in spelled], np.int64),
        "word_data": np.concatenate(spelled) if spelled else np.zeros(0, np.uint8),
    }
    return state, list(names), np.bincount(lang, minlength=len(names))


_CHUNK = "chunk long, langs array<string>, words array<long>, state binary"


def occurrences(docs: DataFrame) -> DataFrame:
    """R1, one row a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = chunk_ids()
        for part in in_chunks(batches, "text", CHUNK_BYTES):
            state, langs, words = _words(part)
            yield _row(next(ids), langs, words.tolist(), packed(**state))

    return docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(run, _CHUNK)


def _row(chunk: int, langs: list[str], words: list[int], state: bytes) -> pa.RecordBatch:
    values = [pa.array([chunk], pa.int64()), pa.array([langs], pa.list_(pa.string())), pa.array([words], pa.list_(pa.int64())), pa.array([state], pa.binary())]
    return pa.record_batch(values, [f.split()[0] for f in _CHUNK.split(", ")])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """One row at a time, so that a single state is copied out of the batch."""
    for i in range(batch.num_rows):
        yield tuple(column[i].as_py() for column in batch.columns)


def _groups(state: dict[str, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the k-word phrases of a chunk, sorted, and how often each occurs there."""
    if k == 1:
        return state["key"], np.bincount(state["code"], minlength=len(state["key"]))
    return np.unique(_joined(state, k - 1)[1], return_counts=True)


def grouped(chunks: DataFrame, k: int) -> DataFrame:
    """(key, n, owner) of k-word phrases: added up over the chunks of a task, KEYS or so at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for chunk, blob in _rows(batch):
                key, n = _groups(unpacked(blob), k)
                parts.append((key, n, np.full(len(key), chunk)))
                size += len(key)
                if size > KEYS:
                    yield _added(parts)
                    parts, size = [], 0
        if size:
            yield _added(parts)

    return chunks.select("chunk", "state").mapInArrow(run, "key long, n long, owner long")


def _added(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    key, n, owner = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key, kind="stable")
    key, n, owner = key[order], n[order], owner[order]
    first = np.flatnonzero(first_of_runs(key)) if len(key) else np.zeros(0, np.int64)
    sums = np.add.reduceat(n, first) if len(key) else n
    lowest = np.minimum.reduceat(owner, first) if len(key) else owner
    return pa.record_batch([pa.array(key[first]), pa.array(sums.astype(np.int64)), pa.array(lowest)], ["key", "n", "owner"])


def _asked(chunks: DataFrame, k: int) -> DataFrame:
    """(chunk, key): the k-word phrases of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in _rows(batch):
                key, _ = _groups(unpacked(blob), k)
                yield pa.record_batch([pa.array(np.full(len(key), chunk)), pa.array(key)], ["chunk", "key"])

    return chunks.select("chunk", "state").mapInArrow(run, "chunk long, key long")


def _joined(state: dict[str, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rk merged with itself at the adjacent position: starts and keys of the occurrences of longer phrases."""
    pos, phrase, key = state[f"pos{k}"], state[f"phrase{k}"], state[f"key{k}"].view(np.uint64)
    at = np.flatnonzero(np.diff(pos) == 1)
    return pos[at], mix(mix(key[phrase[at]] * _HEAD) + key[phrase[at + 1]] * _TAIL).view(np.int64)


def _semi_joined(state: dict[str, np.ndarray], k: int, chunk: int, key: np.ndarray, total: np.ndarray, owner: np.ndarray) -> dict[str, np.ndarray]:
    """Rk of a chunk: the occurrences whose phrase is among the frequent ones (sorted by key)."""
    if k == 1:
        pos, found, local = np.cumsum(state["step"], dtype=np.int64), state["key"], state["code"]
    else:
        pos, longer = _joined(state, k - 1)
        found, local = np.unique(longer, return_inverse=True)
    place = np.minimum(np.searchsorted(key, found), max(len(key) - 1, 0))
    there = key[place] == found if len(key) else np.zeros(len(found), bool)
    number = np.where(there, np.cumsum(there) - 1, -1)
    phrase = number[local]
    stays = phrase >= 0
    place = place[there]
    pos = pos[stays]
    new = {f"pos{k}": pos, f"phrase{k}": phrase[stays], f"key{k}": found[there], f"total{k}": total[place], f"owned{k}": owner[place] == chunk}
    if k == 1:
        every = state["word_size"].astype(np.int64)
        begin, sizes = (np.cumsum(every) - every)[there], every[there]
        taken = np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        return new | {"word_lang": state["word_lang"][there], "word_size": sizes, "word_data": state["word_data"][taken]}
    if k == 2:  # only words inside a frequent pair are asked for later
        used = np.isin(state["pos1"], np.concatenate([pos, pos + 1]))
        state |= {"pos1": state["pos1"][used], "phrase1": state["phrase1"][used]}
    return state | new


def semi_joined(chunks: DataFrame, frequent: DataFrame, k: int) -> DataFrame:
    """The chunks with Rk. Few frequent phrases (KEYS at most, counted) are broadcast; more are joined to the chunks'
    own phrases by shuffle, and each chunk meets its answers."""
    spark = chunks.sparkSession
    if frequent.count() <= KEYS:
        table = frequent.select("key", "total", "owner").orderBy("key").toArrow()
        shared = spark.sparkContext.broadcast([c.to_numpy() for c in table.columns])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk, langs, words, blob in _rows(batch):
                    yield _row(chunk, langs, words, packed(**_semi_joined(unpacked(blob), k, chunk, *shared.value)))

        return chunks.mapInArrow(run, _CHUNK)
    answers = kept(_asked(chunks, k).join(frequent, "key"), f"answers-{k}", batch_rows=BATCH)

    def step(chunk: pa.Table, answer: pa.Table) -> pa.Table:
        answer = answer.sort_by("key")
        number, langs, words, blob = (chunk[name][0].as_py() for name in ("chunk", "langs", "words", "state"))
        state = _semi_joined(unpacked(blob), k, number, *(answer[name].to_numpy() for name in ("key", "total", "owner")))
        return pa.Table.from_batches([_row(number, langs, words, packed(**state))])

    return answered(chunks, answers, step, _CHUNK)


_CANDIDATE = (
    "lang string, phrase string, size int, key long, a long, lefts array<long>, rights array<long>, head long, head_n long, tail long, tail_n long"
)


def _found(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for langs, blob in _rows(batch):
                state = unpacked(blob)
                for k in range(2, longest + 1):
                    out = _owned(state, langs, k)
                    if out is not None:
                        yield out

    return run


def _owned(state: dict[str, np.ndarray], langs: list[str], k: int) -> pa.RecordBatch | None:
    """The frequent k-word phrases whose first chunk this is, each read off one of its occurrences."""
    phrase, first = np.unique(state[f"phrase{k}"], return_index=True)
    mine = state[f"owned{k}"][phrase]
    phrase, at = phrase[mine], state[f"pos{k}"][first[mine]]
    if not len(phrase):
        return None

    def part(j: int, p: np.ndarray) -> np.ndarray:
        return state[f"phrase{j}"][np.searchsorted(state[f"pos{j}"], p)]

    count = lambda j, p: state[f"total{j}"][part(j, p)]
    words = np.stack([part(1, at + i) for i in range(k)], 1)
    end = np.cumsum(state["word_size"], dtype=np.int64)
    begin, data = end - state["word_size"], state["word_data"].tobytes()
    spelled = [b" ".join(data[begin[w] : end[w]] for w in row).decode("utf-8", "replace") for row in words.tolist()]
    cuts = range(1, k)
    lefts, rights = (np.stack(x, 1) for x in ([count(j, at) for j in cuts], [count(k - j, at + j) for j in cuts]))
    head, tail = (state[f"key{k - 1}"][part(k - 1, p)] for p in (at, at + 1))
    listed = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * (k - 1), pa.int32()), pa.array(x.ravel()))
    values = [
        pa.array([langs[i] for i in state["word_lang"][words[:, 0]].tolist()]),
        pa.array(spelled, pa.string()),
        pa.array(np.full(len(at), k, np.int32)),
        pa.array(state[f"key{k}"][phrase]),
        pa.array(state[f"total{k}"][phrase]),
        *map(listed, (lefts, rights)),
        *map(pa.array, (head, count(k - 1, at), tail, count(k - 1, at + 1))),
    ]
    return pa.record_batch(values, [f.split()[0] for f in _CANDIDATE.split(", ")])


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All phrases of 2 to `longest` words that occur `least` times in their language, and (lang, n) of all words.

    A phrase has its parts' counts for each cut, and key and count of the two phrases that are one word shorter.
    """
    chunks = kept(occurrences(docs), "occurrences", batch_rows=ROWS, group_rows=ROWS)
    sizes = chunks.select(F.explode(F.arrays_zip("langs", "words")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.words").alias("n"))
    sizes = kept(sizes, "sizes")
    for k in range(1, longest + 1):
        counts = grouped(chunks, k).groupBy("key").agg(F.sum("n").alias("total"), F.min("owner").alias("owner"))
        frequent = kept(counts.filter(F.col("total") >= least), f"frequent-{k}")
        longer = kept(semi_joined(chunks, frequent, k), f"occurrences-{k}", batch_rows=ROWS, group_rows=ROWS)
        dropped(chunks, frequent)
        chunks = longer
    found = kept(chunks.select("langs", "state").mapInArrow(_found(longest), _CANDIDATE), "phrases")
    dropped(chunks)
    return found, sizes


def scored(found: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, phrase, size, key, a, l, r, n, score): the lowest score over all cuts, in exact decimals."""
    wide = lambda c: c.cast("decimal(19,0)")
    rows = found.join(sizes, "lang")
    above = wide(F.col("a")) * F.lit(1000).cast("decimal(4,0)") * F.col("n").cast("decimal(15,0)")
    rows = rows.withColumn("above", above).withColumn("cuts", F.arrays_zip("lefts", "rights"))
    score = "transform(cuts, (c, i) -> struct(above div (cast(c.lefts as decimal(19,0)) * cast(c.rights as decimal(19,0))) AS score, i AS cut, c.lefts AS l, c.rights AS r))"
    worst = F.array_min(F.expr(score))
    return rows.withColumn("w", worst).select("lang", "phrase", "size", "key", "a", F.col("w.l").alias("l"), F.col("w.r").alias("r"), "n", F.col("w.score").cast("long").alias("score"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, best: int = BEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `best` phrases of each language.

    A phrase goes if a longer one holds it as often. Then one that is a word longer does too, since counts fall
    with length, so it is enough to look at the phrases' heads and tails.
    """
    found, sizes = frequent_phrases(docs, least, longest)
    parts = F.explode(F.array(*(F.struct(F.col(p).alias("key"), F.col(f"{p}_n").alias("n")) for p in ("head", "tail"))))
    inside = found.filter("size > 2").select("a", (F.col("size") - 1).alias("size"), parts.alias("p")).filter("a >= p.n")
    alone = scored(found, sizes).join(inside.select("size", F.col("p.key").alias("key")), ["size", "key"], "left_anti")
    ranked = top_k_per_group(alone, ["lang"], [F.desc("score"), F.desc("a"), F.col("phrase")], best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
