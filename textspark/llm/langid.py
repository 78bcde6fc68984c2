"""Language of texts by rank-order profiles of character n-grams.

Words are runs of letters in lower case, with a blank on either side; their 1- to 3-grams are counted. A language's
profile is its `PROFILE` = 300 most frequent n-grams over all training documents, ranked by count and then by code; a
document's is made the same way from its whole text. The out-of-place distance adds up how far each n-gram of the
document stands from its rank in the language, `PROFILE` places if it is absent. The nearest language wins, ties to the
smaller name; `score` is one less the distance as a share of the largest possible.

Counts are summed in tasks and then by Spark; the driver gets 300 rows a language. Defined results: `und` and 0 for a
null text and one without letters, and where no language could be learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.llm.storage import free_name, kept, remainder, slices
from textspark.llm.words import first_of_runs
from textspark.plans.ranking import top_k_per_group

PROFILE = 300
UNKNOWN = "und"
#: Entries of a task's running counts before they are passed on.
HELD = 1 << 20
_POINTS = 0x110000
_BLANK = ord("_")


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams, text after text, and the end of each text's. A code holds up to three code points."""
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in lowered], np.int64)
    points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    present = np.flatnonzero(np.bincount(points, minlength=1))
    letters = np.zeros(_POINTS, bool)
    letters[present] = [chr(p).isalpha() for p in present.tolist()]
    letter = letters[points]
    text = np.repeat(np.arange(len(texts)), sizes)
    # One blank stands for every run of other characters, and one before the first text.
    stays = letter.copy()
    stays[1:] |= letter[:-1]
    stays[0] = True
    c = np.where(letter, points, _BLANK)[stays]
    mine, letter = text[stays], letter[stays]
    if letter[:1].any():
        c, mine, letter = np.concatenate([[_BLANK], c]), np.concatenate([[0], mine]), np.concatenate([[False], letter])
    mid = np.flatnonzero(letter)
    two = np.flatnonzero(letter[:-1] | letter[1:])
    owners = [mine[mid], mine[mid], np.where(letter[two], mine[two], mine[two + 1])]
    codes = [c[mid], c[mid - 1] << 42 | c[mid] << 21 | c[mid + 1], c[two] << 21 | c[two + 1]]
    counts = [np.bincount(o, minlength=len(texts)) for o in owners]
    ends = np.cumsum(sum(counts))
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    begin = ends - sum(counts)
    for code, owner, count in zip(codes, owners, counts):
        out[np.arange(len(code)) + (begin - (np.cumsum(count) - count))[owner]] = code
        begin = begin + count
    return out, ends


def profile(codes: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent codes of one text, by count and then by code. Sorts `codes` in place."""
    codes.sort()
    at = np.flatnonzero(first_of_runs(codes))
    counts = np.diff(np.concatenate([at, [len(codes)]]))
    top = counts.max(initial=0)
    key = (top - counts).astype(np.uint16) if top < 65536 else top - counts
    return codes[at][np.argsort(key, kind="stable")[:most]]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, list[int]]:
    """Profiles, most frequent first, of every language of the rows given; rows with a null on either side are left out."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for name, (codes, n) in held.items():
                yield pa.record_batch([pa.array([name] * len(codes)), pa.array(codes), pa.array(n)], ["lang", "code", "n"])

        for batch in batches:
            for piece in slices(batch, "_text"):
                names = np.array(piece.column(1).to_pylist(), dtype=object)
                codes, ends = ngrams(piece.column(0).to_pylist())
                sizes = np.diff(np.concatenate([[0], ends]))
                for name in dict.fromkeys(names):
                    found, n = np.unique(codes[np.repeat(names == name, sizes)], return_counts=True)
                    old, m = held.get(name, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    both, at = np.unique(np.concatenate([old, found]), return_inverse=True)
                    held[name] = both, np.bincount(at, np.concatenate([m, n]), len(both)).astype(np.int64)
                if sum(len(c) for c, _ in held.values()) > HELD:
                    yield from rows()
                    held = {}
        yield from rows()

    named = docs.select(F.col(text).cast("string").alias("_text"), F.col(lang).cast("string").alias("_lang")).dropna()
    totals = named.mapInArrow(counted, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    ranked = top_k_per_group(totals, ["lang"], [F.col("n").desc(), F.col("code")], PROFILE)
    profiles: dict[str, list[int]] = {}
    for row in kept(ranked.select("lang", "rank", "code"), "profiles").orderBy("lang", "rank").collect():
        profiles.setdefault(row.lang, []).append(row.code)
    return profiles


def predict(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score; columns of those names are replaced."""
    names = sorted(profiles)
    union = np.unique(np.array([code for codes in profiles.values() for code in codes], np.int64))
    ranks = np.full((len(union) + 1, len(names)), PROFILE, np.int64)
    for k, name in enumerate(names):
        ranks[np.searchsorted(union, profiles[name]), k] = np.arange(len(profiles[name]))
    present = ranks < PROFILE
    shared = docs.sparkSession.sparkContext.broadcast((names, union, ranks, present))
    rest = docs.drop("lang_pred", "score")
    columns = [*rest.columns, "lang_pred", "score"]
    read = free_name(columns, "text_read")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, union, ranks, present = shared.value
        for batch in batches:
            for piece in slices(batch, read):
                at = piece.schema.get_field_index(read)
                codes, ends = ngrams([t or "" for t in piece.column(at).to_pylist()])
                found, scores, start = [], np.zeros(len(ends)), 0
                for i, end in enumerate(ends.tolist()):
                    own = profile(codes[start:end])
                    start = end
                    if not len(own) or not names:
                        found.append(UNKNOWN)
                        continue
                    place = np.searchsorted(union, own)
                    place[(place == len(union)) | (union[np.minimum(place, len(union) - 1)] != own)] = len(union)
                    apart = np.where(present[place], np.abs(ranks[place] - np.arange(len(own))[:, None]), PROFILE).sum(axis=0)
                    best = int(apart.argmin())
                    found.append(names[best])
                    scores[i] = 1.0 - apart[best] / (len(own) * PROFILE)
                kept_columns = [c for k, c in enumerate(piece.columns) if k != at]
                yield pa.record_batch([*kept_columns, pa.array(found, pa.string()), pa.array(scores)], columns)

    named = rest.withColumn(read, F.col(text).cast("string"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields), "lang_pred string, score double"])
    return named.mapInArrow(run, schema)


def held_out() -> Column:
    """Rows that are never learned from: the fold of the id is 0 of 5."""
    return F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    profiles = learn(docs.filter(~held_out()))
    named = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return kept(predict(named, profiles).drop("text"), "languages")
