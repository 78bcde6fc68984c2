"""SentencePiece encoding and decoding on the `tokenizers` library, held against `sentencepiece` itself.

The model file (a protobuf) is parsed on the driver and rebuilt: its normaliser, the metaspace marker, unigram scores or
BPE merges ranked by piece score, and byte fallback. Tasks encode with the rebuilt tokenizer, several threads a batch.

Every whole text is encoded, and its ids are decoded and compared with the text. Where the text is not normalised and
no piece holds a marker after another character, no token can cross the start of a marked word, so a text's ids are
those of its words one after another in both libraries. Then each distinct word of a task is encoded by both and
compared once, and a text takes the ids of its words, which covers every text of the task. Otherwise whole texts are
encoded and compared. Words are remembered up to a bound, which changes speed only. A text longer than a slice is
handled alone.

Defined results: null and empty texts have no ids; `parity` says that all ids equal those of `sentencepiece`;
`round_trip` that decoding gives the text again (false for a text that itself holds the marker character).
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from textspark.llm.storage import free_name, kept, lists, slices

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
REMEMBERED = 200_000
#: Ids of remembered words, which bounds long ones.
REMEMBERED_IDS = 8 * REMEMBERED
#: Bytes of text encoded at once; each token is a Python int for a moment.
TEXT_BYTES = 1 << 18
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6
_UNIGRAM, _BPE = 1, 2


def read_model(path: str):
    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return model


def rebuilt(model) -> Tokenizer:
    """The model as a tokenizer of the `tokenizers` library."""
    pieces = [(p.piece, p.score) for p in model.pieces]
    ids = {piece: i for i, (piece, _) in enumerate(pieces)}
    unknown = next((i for i, p in enumerate(model.pieces) if p.type == _UNKNOWN), None)
    fallback = any(p.type == _BYTE for p in model.pieces)
    if model.trainer_spec.model_type == _UNIGRAM:
        # Only normal pieces are ever found in a text.
        lowest = min(score for _, score in pieces)
        scored = [(text, p.score if p.type == _NORMAL else lowest - 100.0) for (text, _), p in zip(pieces, model.pieces)]
        core = models.Unigram(scored, unk_id=unknown, byte_fallback=fallback)
    elif model.trainer_spec.model_type == _BPE:
        splits = [
            (-p.score, ids[p.piece[:k]], ids[p.piece[k:]], p.piece[:k], p.piece[k:])
            for p in model.pieces
            if p.type == _NORMAL
            for k in range(1, len(p.piece))
            if p.piece[:k] in ids and p.piece[k:] in ids
        ]
        merges = [(left, right) for *_, left, right in sorted(splits)]
        unk = pieces[unknown][0] if unknown is not None else None
        core = models.BPE(vocab=ids, merges=merges, unk_token=unk, fuse_unk=True, byte_fallback=fallback)
    else:
        raise ValueError(f"model type {model.trainer_spec.model_type} has no subword pieces")
    spec = model.normalizer_spec
    steps = []
    if spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if spec.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARKER))
    tokenizer = Tokenizer(core)
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    strip = [decoders.Strip(" ", 1, 0)] if spec.add_dummy_prefix else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return tokenizer


def word_by_word(model) -> bool:
    """Whether ids of a text are those of its marked words: no piece has a marker after another character.

    The marker is a piece of its own, so a run of unknown characters ends where a word does.
    """
    spec = model.normalizer_spec
    plain = spec.escape_whitespaces and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap
    found = [p.piece for p in model.pieces if p.type in (_NORMAL, _USER)]
    return bool(plain) and MARKER in found and not any(MARKER in piece.lstrip(MARKER) for piece in found)


def byte_table(model) -> pa.Array:
    """Bytes that each id stands for in a decoded text."""
    as_bytes = lambda p: bytes([int(p.piece[3:5], 16)]) if p.type == _BYTE else p.piece.replace(MARKER, " ").encode()
    return pa.array([as_bytes(p) for p in model.pieces], pa.large_binary())


class _Encoder:
    """One task's tokenizer. `encode` gives flat ids, the end of each text's ids, parity and round trip."""

    def __init__(self, tokenizer: str, model: bytes, by_word: bool, threads: int):
        os.environ["RAYON_NUM_THREADS"] = str(threads)  # read when the library encodes its first batch
        self.tokenizer = Tokenizer.from_str(tokenizer)
        resize = getattr(self.tokenizer.model, "_resize_cache", None)
        if resize:  # neither whole texts nor new words come again, so remembering them only costs time
            resize(0)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.threads, self.by_word = threads, by_word
        parsed = sentencepiece_model_pb2.ModelProto.FromString(model)
        self.bytes = byte_table(parsed)
        self.prefix = b" " if parsed.normalizer_spec.add_dummy_prefix else b""
        self._forget()

    def _forget(self) -> None:
        """Words by number, and of each: where its ids end among all, and whether the libraries differ on it."""
        self.words: dict[str, int] = {}
        self.held, self.until, self.wrong = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, bool)
        if self.by_word:  # a single space at the end is the word "", which neither library marks when it stands alone
            ours, theirs = ([ids[1][len(ids[0]) :]] for ids in (self._ids(["a", "a "]), self.pieces.encode(["a", "a "])))
            self._add([""], ours, theirs)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        ids = self._ids(texts)
        parity = [a == b for a, b in zip(ids, self.pieces.encode(texts, num_threads=self.threads))]
        return *_flat(ids), parity

    def _learn(self, words: list[str]) -> None:
        """Encodes new words by both libraries and remembers them."""
        self._add(words, self._ids(words), self.pieces.encode(words, num_threads=self.threads))

    def _add(self, words: list[str], ours: list[list[int]], theirs: list[list[int]]) -> None:
        differ = [a != b for a, b in zip(ours, theirs)]
        flat, ends = _flat(ours)
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words))))
        self.until = np.concatenate([self.until, ends + len(self.held)])
        self.held = np.concatenate([self.held, flat])
        self.wrong = np.concatenate([self.wrong, np.array(differ, bool)])

    def _by_word(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        if len(self.words) > REMEMBERED or len(self.held) > REMEMBERED_IDS:
            self._forget()
        split = [_words(t) for t in texts]
        new = set(chain.from_iterable(split)).difference(self.words)
        if new:
            self._learn(list(new))
        sizes = np.array([len(w) for w in split], np.int64)
        word = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        n = np.diff(self.until)[word]
        ends = np.cumsum(n)
        flat = self.held[np.arange(int(n.sum())) + np.repeat(self.until[word] - (ends - n), n)]
        last = np.cumsum(sizes)
        at = lambda sums: np.concatenate([np.zeros(1, np.int64), sums])[last]
        bad = np.diff(at(np.cumsum(self.wrong[word])), prepend=0)
        return flat, at(ends), (bad == 0).tolist()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool], list[bool]]:
        flat, ends, parity = self._by_word(texts) if self.by_word else self._whole(texts)
        joined = pc.take(self.bytes, pa.array(flat))
        places = np.frombuffer(joined.buffers()[1], np.int64)[: len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
        data = memoryview(joined.buffers()[2] or b"")
        cuts = [0, *places[ends].tolist()]
        back = [bytes(data[a:b]) == (self.prefix + t.encode() if t else b"") for a, b, t in zip(cuts, cuts[1:], texts)]
        return flat, ends, parity, back


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after another, and where each list ends."""
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    return np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]) if len(ends) else 0), ends


def _words(text: str) -> list[str]:
    """The words at single spaces; a word keeps the further spaces before it, and a space at the end is a word. An empty text has none."""
    if not text:
        return []
    if MARKER in text:  # to the models a marker in the text is a space
        text = text.replace(MARKER, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [w[1:] for w in _SPACED.findall(f" {text}")]


#: A word with the spaces before it, or the spaces at the end.
_SPACED = re.compile(" +[^ ]*|[^ ]+")


def encoded(docs: DataFrame, path: str = DEFAULT_MODEL, text: str = "text", with_ids: bool = True) -> DataFrame:
    """`docs` with n_tokens, token_sha256 (of the ids as little-endian int32), parity, round_trip and, if wanted, token_ids.

    Columns of those names are replaced. One pass over the texts, no shuffle.
    """
    model = read_model(path)
    spark = docs.sparkSession
    threads = int(spark.sparkContext.getConf().get("spark.task.cpus", "1"))
    shared = spark.sparkContext.broadcast((rebuilt(model).to_str(), model.SerializeToString(), word_by_word(model), threads))
    made = {"n_tokens": "long", "token_sha256": "string", "parity": "boolean", "round_trip": "boolean"}
    made |= {"token_ids": "array<int>"} if with_ids else {}
    rest = docs.drop(*made)
    names = [*rest.columns, *made]
    column = free_name(docs.columns, "text_read")
    named = rest.withColumn(column, F.col(text).cast("string"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields), *(f"{k} {v}" for k, v in made.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(*shared.value)
        for batch in batches:
            for piece in slices(batch, column, TEXT_BYTES):
                at = piece.schema.get_field_index(column)
                ids, ends, parity, back = encoder.encode([t or "" for t in piece.column(at).to_pylist()])
                starts = np.concatenate([[0], ends[:-1]])
                digests = [hashlib.sha256(ids[a:b].astype("<i4").tobytes()).hexdigest() for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [c for i, c in enumerate(piece.columns) if i != at]
                columns += [pa.array(ends - starts), pa.array(digests), pa.array(parity), pa.array(back)]
                columns += [lists(ids, ends, pa.int32())] if with_ids else []
                yield pa.record_batch(columns, names)

    return named.mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str = DEFAULT_MODEL, ids: str = "token_ids", name: str = "decoded") -> DataFrame:
    """`rows` with the text of a column of ids; null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(rebuilt(read_model(path)).to_str())
    rest = rows.drop(name)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields), f"`{name}` string"])
    names = [*rest.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.from_str(shared.value)
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = tokenizer.decode_batch([v or [] for v in values], skip_special_tokens=False)
            texts = [None if v is None else t for v, t in zip(values, texts)]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names)

    return rest.mapInArrow(run, schema)


def encoding_report(docs: DataFrame, path: str = DEFAULT_MODEL) -> DataFrame:
    """(doc_id, n_tokens, token_sha256, parity, round_trip) of every document."""
    return kept(encoded(docs.select("doc_id", "text"), path, with_ids=False).drop("text"), "encoded")
