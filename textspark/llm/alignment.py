"""Cross-tokenizer alignment: which tokens of two tokenizers share their bytes, and how common each pairing is.

Tokens of a slice of texts are flat Arrow lists with parent indices; byte ends are segmented cumulative sums. A hash join
on (document, end) finds the offsets where both tokenizers end a token, which cut a document into groups. All pairs of an
A and a B token of one group are linked. A chunk counts, with Table.group_by, in how many of its documents each id pair
is linked; Spark sums these counts over the corpus and hands every chunk the sums of its own pairs.

The byte-level tokenizer (A) encodes a space before the text, the piece model (B) adds one itself, so both cover the
bytes of space + text. Where A's file is byte-level BPE with merges in id order, its vocabulary runs in `tiktoken`, which
gives the same ids several times as fast; other files run in `tokenizers`.

Defined results: null and empty texts, and texts whose joined A or B bytes are not those of space + text (the text holds
U+2581, say), have no tokens: zeros and ''. Repeated rows count as documents of their own; null ids stay. An empty table
gives an empty result. One text longer than a slice is handled alone, whole, so a task needs memory for its longest text.
Only doc_id and text are read, so names of other columns are free.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from textspark.llm.chunks import answered, chunk_ids, in_chunks, requests, totals, unpacked
from textspark.llm.storage import kept

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
#: Fixed value: the pattern that splits a text before byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Links made at once; a single longer group is cut by its A tokens.
LINKS = 1 << 22


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_vocabulary(spec: dict) -> dict[bytes, int]:
    letters = byte_letters()
    return {bytes(letters[c] for c in entry): i for entry, i in spec["model"]["vocab"].items() if all(c in letters for c in entry)}


def ranked(spec: dict) -> bool:
    """Whether the file is plain byte-level BPE whose merges come in the order of the ids they make."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
    if not plain or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or len(byte_vocabulary(spec)) != len(model["vocab"]):
        return False
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    return all(a < b for a, b in zip(made, made[1:])) and sorted(model["vocab"].values()) == list(range(len(model["vocab"])))


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(MARKER, " ").encode()


class Pair:
    """The two tokenizers of one task: `a` and `b` encode a list of texts, the tables hold each id's bytes."""

    def __init__(self, spec: str, model: bytes):
        read = json.loads(spec)
        if ranked(read):
            core = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=byte_vocabulary(read), special_tokens={})
            self.a = lambda texts: [core.encode_ordinary(t) for t in texts]
        else:
            tokenizer = Tokenizer.from_str(spec)
            tokenizer.encode_special_tokens = True
            self.a = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.b = lambda texts: pieces.encode(texts, num_threads=1)
        vocabulary = {i: t for t, i in byte_vocabulary(read).items()}
        parsed = sentencepiece_model_pb2.ModelProto.FromString(model)
        self.a_bytes = pa.array([vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)], pa.large_binary())
        self.b_bytes = pa.array([piece_bytes(p.piece) for p in parsed.pieces], pa.large_binary())
        self.width = len(self.b_bytes)
        self.decimal = pa.array([f"{i}{s}" for i in range(max(len(self.a_bytes), self.width)) for s in ",|;"], pa.large_string())


def _listed(ids: list[list[int]]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)])
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat))


class _Side:
    """Flat tokens of a slice: id, document, and the byte after each token, counted in its document."""

    def __init__(self, ids: list[list[int]], entries: pa.Array):
        listed = _listed(ids)
        self.id, self.doc = pc.list_flatten(listed), pc.list_parent_indices(listed).cast(pa.int64())
        self.joined = pc.take(entries, self.id)
        sizes = pc.binary_length(self.joined).cast(pa.int64())
        through = pc.cumulative_sum(sizes).to_numpy()
        edges = listed.offsets.to_numpy()
        self.edges = edges
        self.before = np.concatenate([[0], through])[edges]
        self.end = pa.array(through - self.before[:-1][self.doc.to_numpy()])

    def same(self, texts: list[bytes]) -> np.ndarray:
        """Whether the joined bytes of each document are its text."""
        data = memoryview(self.joined.buffers()[2] or b"")
        return np.array([bytes(data[a:b]) == t for a, b, t in zip(self.before[:-1].tolist(), self.before[1:].tolist(), texts)], bool)


def _groups(a: _Side, b: _Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group of each A token, of each B token, and the document of each group: cut where both end at one byte."""
    left = pa.table([a.doc, a.end, pa.array(np.arange(len(a.id)))], ["doc", "end", "i"])
    right = pa.table([b.doc, b.end, pa.array(np.arange(len(b.id)))], ["doc", "end", "j"])
    shared = left.join(right, keys=["doc", "end"], join_type="inner", use_threads=False)
    i, j = np.sort(shared["i"].to_numpy()), np.sort(shared["j"].to_numpy())  # ends rise in both alike
    groups = []
    for last, n in ((i, len(a.id)), (j, len(b.id))):
        cut = np.zeros(n + 1, np.int64)
        cut[last + 1] = 1
        groups.append(np.cumsum(cut)[:-1])
    return groups[0], groups[1], a.doc.to_numpy()[i]


def _digests(pair: Pair, a: _Side, b: _Side, ga: np.ndarray, gb: np.ndarray, na: np.ndarray, nb: np.ndarray, n_docs: int) -> list[str]:
    """SHA-256 of each document's groups in decimal ids; '' for one without tokens."""
    total = len(ga) + len(gb)
    code = np.empty(total, np.int64)
    at_a = np.arange(len(ga)) + (np.cumsum(nb) - nb)[ga]
    at_b = np.arange(len(gb)) + np.cumsum(na)[gb]
    code[at_a] = a.id.to_numpy() * 3
    code[at_b] = b.id.to_numpy() * 3
    code[at_a[np.cumsum(na) - 1]] += 1
    code[at_b[np.cumsum(nb) - 1]] += 2
    text = pc.take(pair.decimal, pa.array(code))
    starts = np.frombuffer(text.buffers()[1], np.int64)[: total + 1]
    data = memoryview(text.buffers()[2] or b"")
    edges = starts[a.edges + b.edges].tolist()
    return [hashlib.sha256(data[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(edges[:-1], edges[1:])][:n_docs]


def _links(a: _Side, b: _Side, ga: np.ndarray, gb: np.ndarray, nb: np.ndarray, docs: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, id pair) of all links, LINKS or so at a time: each A token meets every B token of its group."""
    ids_a, ids_b = a.id.to_numpy().astype(np.int64), b.id.to_numpy().astype(np.int64)
    first = np.cumsum(nb) - nb
    wide = nb[ga]
    through = np.cumsum(wide)
    start = 0
    while start < len(ga):
        stop = max(start + 1, int(np.searchsorted(through, (through[start - 1] if start else 0) + LINKS, "right")))
        n = wide[start:stop]
        token = np.repeat(np.arange(start, stop), n)
        other = np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n) + first[ga[token]]
        yield docs[ga[token]], ids_a[token] * width + ids_b[other]
        start = stop


def _distinct(links: Iterator[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    """(doc, pair, times), by document and pair."""
    one = lambda t: t.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")]).rename_columns(["doc", "pair", "times"])
    parts = []
    for doc, pair in links:
        parts.append(one(pa.table({"doc": doc, "pair": pair, "times": np.ones(len(doc), np.int64)})))
    if not parts:
        return pa.table({"doc": np.zeros(0, np.int64), "pair": np.zeros(0, np.int64), "times": np.zeros(0, np.int64)})
    whole = parts[0] if len(parts) == 1 else one(pa.concat_tables(parts))
    return whole.sort_by([("doc", "ascending"), ("pair", "ascending")])


def align(pair: Pair, texts: list[str | None]) -> dict:
    """Facts of each text of a slice, and its distinct linked pairs: doc, pair = a * width + b, times."""
    whole = [(" " + t).encode() if t else b"" for t in texts]
    ids_a, ids_b = pair.a([" " + t if t else "" for t in texts]), pair.b([t or "" for t in texts])
    a, b = _Side(ids_a, pair.a_bytes), _Side(ids_b, pair.b_bytes)
    good = a.same(whole) & b.same(whole)
    if not good.all():
        a = _Side([x if g else [] for x, g in zip(ids_a, good)], pair.a_bytes)
        b = _Side([x if g else [] for x, g in zip(ids_b, good)], pair.b_bytes)
    ga, gb, docs = _groups(a, b)
    na, nb = np.bincount(ga, minlength=len(docs)), np.bincount(gb, minlength=len(docs))
    n = len(texts)
    return {
        "n_a": np.diff(a.edges),
        "n_b": np.diff(b.edges),
        "n_groups": np.bincount(docs, minlength=n),
        "n_links": np.bincount(docs, weights=na * nb, minlength=n).astype(np.int64),
        "groups_sha256": _digests(pair, a, b, ga, gb, na, nb, n),
        "pairs": _distinct(_links(a, b, ga, gb, nb, docs, pair.width)),
    }


FACTS = ["n_a", "n_b", "n_groups", "n_links"]


def _shared(spark: SparkSession, byte_level: str, pieces: str):
    """The two tokenizer files, read on the driver; their sizes are those of the vocabularies."""
    with open(byte_level, encoding="utf-8") as a, open(pieces, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


def aligned_chunks(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """One row a chunk of documents: `rows` (an Arrow stream of the documents' facts), and per document its linked pairs
    as places in the sorted `keys` of the chunk, with `counts`, the number of its documents that hold each."""
    shared = _shared(docs.sparkSession, byte_level, pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*shared.value)
        ids = chunk_ids()
        for part in in_chunks(batches, "text"):
            facts, links, offset = [], [], 0
            for piece in part:
                found = align(pair, piece.column(1).to_pylist())
                facts.append(pa.record_batch([piece.column(0), *(pa.array(found[f], pa.int64()) for f in FACTS), pa.array(found["groups_sha256"])], ["doc_id", *FACTS, "groups_sha256"]))
                table = found["pairs"]
                links.append(table.set_column(0, "doc", pa.array(table["doc"].to_numpy() + offset)))
                offset += piece.num_rows
            linked = pa.concat_tables(links).combine_chunks()
            counted = linked.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
            keys = counted["pair"].to_numpy()
            code = np.searchsorted(keys, linked["pair"].to_numpy()).astype("<u4")
            sizes = np.bincount(linked["doc"].to_numpy(), minlength=offset)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, facts[0].schema) as stream:
                for batch in facts:
                    stream.write_batch(batch)
            blobs = [sizes.astype("<i8"), code, linked["times"].to_numpy().astype("<u4"), keys.astype("<i8"), counted["count_all"].to_numpy().astype("<i8")]
            yield pa.record_batch([pa.array([next(ids)]), pa.array([sink.getvalue().to_pybytes()], pa.binary()), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)], [f.split()[0] for f in _CHUNK])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ", ".join(_CHUNK))


_CHUNK = ["chunk long", "rows binary", "sizes binary", "code binary", "times binary", "keys binary", "counts binary"]


def pair_counts(chunks: DataFrame, width: int) -> DataFrame:
    """(key, total, best): documents that hold each linked pair, and whether no pair of its A id is held by more."""
    counts = kept(totals(requests(chunks)).select("key", "total"), "pair-counts")
    a = F.floor(F.col("key") / width)
    most = counts.groupBy(a.alias("a")).agg(F.max("total").alias("most"))  # a row an A id: the vocabulary bounds it
    return counts.withColumn("a", a).join(most, "a").select("key", "total", (F.col("total") == F.col("most")).alias("best"))


def _summed(chunk: pa.Table, answer: pa.Table) -> pa.Table:
    """Facts of a chunk's documents, with n_best and count_sum from the sums of the chunk's pairs."""
    blob = lambda name, kind: unpacked(chunk[name][0].as_py(), kind)
    facts = pa.ipc.open_stream(chunk["rows"][0].as_py()).read_all()
    answer = answer.sort_by("key")
    assert np.array_equal(answer["key"].to_numpy(), blob("keys", "<i8")), "every pair of a chunk has its sum"
    total, best = answer["total"].to_numpy(), answer["best"].to_numpy(zero_copy_only=False)
    code, times, sizes = blob("code", "<u4"), blob("times", "<u4").astype(np.int64), blob("sizes", "<i8")
    ends = np.cumsum(sizes)
    through = lambda x: np.concatenate([[0], np.cumsum(x)])
    sums = [through(x)[ends] - through(x)[ends - sizes] for x in (times * best[code], times * total[code])]
    return facts.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))


def tokenizer_alignment(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every document."""
    chunks = kept(aligned_chunks(docs, byte_level, pieces), "aligned", batch_rows=4)
    with open(pieces, "rb") as file:
        width = len(sentencepiece_model_pb2.ModelProto.FromString(file.read()).pieces)
    answers = requests(chunks).select("chunk", "key").join(kept(pair_counts(chunks, width), "pairs"), "key")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return kept(answered(chunks.drop("counts"), answers, _summed, schema), "alignment", batch_rows=100_000)


def aligned_pairs(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """(a, b, n_docs, best): the table of id pairs itself, for carrying embeddings or scores from one vocabulary to another."""
    chunks = kept(aligned_chunks(docs, byte_level, pieces), "aligned", batch_rows=4)
    with open(pieces, "rb") as file:
        width = len(sentencepiece_model_pb2.ModelProto.FromString(file.read()).pieces)
    pairs = pair_counts(chunks, width)
    return pairs.select(F.floor(F.col("key") / width).cast("int").alias("a"), (F.col("key") % width).cast("int").alias("b"), F.col("total").alias("n_docs"), "best")


def aligned_groups(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """(doc_id, a_ids, a_groups, b_ids, b_groups): both token sequences of each text with the number of each token's group."""
    shared = _shared(docs.sparkSession, byte_level, pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*shared.value)
        for part in in_chunks(batches, "text"):
            for piece in part:
                yield pa.record_batch([piece.column(0), *_listed_groups(pair, piece.column(1).to_pylist())], ["doc_id", "a_ids", "a_groups", "b_ids", "b_groups"])

    schema = "doc_id long, a_ids array<int>, a_groups array<int>, b_ids array<int>, b_groups array<int>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _listed_groups(pair: Pair, texts: list[str | None]) -> list[pa.Array]:
    whole = [(" " + t).encode() if t else b"" for t in texts]
    ids = [pair.a([" " + t if t else "" for t in texts]), pair.b([t or "" for t in texts])]
    sides = [_Side(ids[0], pair.a_bytes), _Side(ids[1], pair.b_bytes)]
    good = sides[0].same(whole) & sides[1].same(whole)
    a, b = (_Side([x if g else [] for x, g in zip(side, good)], table) for side, table in zip(ids, (pair.a_bytes, pair.b_bytes)))
    ga, gb, docs = _groups(a, b)
    before = np.searchsorted(docs, np.arange(len(texts)))
    out = []
    for side, group in ((a, ga), (b, gb)):
        edges = pa.array(side.edges.astype(np.int32))
        out += [pa.ListArray.from_arrays(edges, side.id), pa.ListArray.from_arrays(edges, pa.array((group - before[side.doc.to_numpy()]).astype(np.int32)))]
    return out
