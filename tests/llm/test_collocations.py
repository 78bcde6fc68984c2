import random
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

from textspark.llm import collocations as module
from textspark.llm.collocations import collocations, frequent_phrases

FOLD = {i: i + 32 for i in range(65, 91)}


def slow(rows, least, best=2000, longest=5):
    """The contract with dictionaries: rows of (text, lang)."""
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            sizes[lang] += len(words)
            counts.update((lang, words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), f in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if 100 * f >= 100 * counts[lang, words[i : i + k]]:
                    dropped.add((lang, words[i : i + k]))
    out = {}
    for (lang, words), a in candidates.items():
        if (lang, words) not in dropped:
            cuts = [(1000 * a * sizes[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, sizes[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:best])
    )


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def random_rows(n, seed=5):
    rng = random.Random(seed)
    words = ["the", "of", "New", "York", "times", "é", "日本", "a.b", "x", "to", "be"]
    phrases = ["once upon a time", "state of the art thing", "New York Times", "to be or not to be"]
    out = []
    for i in range(n):
        parts = [rng.choice(phrases) if rng.random() < 0.4 else rng.choice(words) + rng.choice(["", "", ",", "\n", ";  ", "\t"]) for _ in range(rng.randrange(25))]
        out.append((i, " ".join(parts), rng.choice(["en", "en", "en", "fr", None, "und"])))
    return out


@pytest.mark.parametrize("least, best", [(2, 2000), (5, 4)])
def test_equals_the_slow_version(corpus, edge_rows, least, best):
    rows = [*random_rows(90), *((r[0], r[1], "en") for r in edge_rows)]
    got = result(collocations(corpus(*rows).repartition(5), least=least, best=best))
    assert got == slow([(r[1], r[2]) for r in rows], least, best)


@pytest.mark.parametrize("keys", [1 << 20, 10])
def test_many_small_chunks_give_the_same(corpus, monkeypatch, keys):
    """With few frequent phrases, which are broadcast, and with more than may be, which are joined."""
    rows = random_rows(60)
    monkeypatch.setattr(module, "KEYS", keys)
    monkeypatch.setattr(module, "CHUNK_BYTES", 200)
    assert result(collocations(corpus(*rows).coalesce(1), least=3)) == slow([(r[1], r[2]) for r in rows], 3)


def test_a_phrase_of_every_document_is_one_row_a_chunk(corpus):
    rows = [(i, "all rights reserved here now", "en") for i in range(300)]
    found, sizes = frequent_phrases(corpus(*rows).repartition(4))
    assert found.count() == 4 + 3 + 2 + 1
    assert sizes.collect()[0].n == 1500
    assert result(collocations(corpus(*rows))) == slow([(r[1], r[2]) for r in rows], 100)


def test_scores_past_64_bits():
    """Exact decimals: the product of three large counts does not fit a long."""
    from pyspark.sql import SparkSession

    from textspark.llm.collocations import scored

    spark = SparkSession.getActiveSession()
    a, n, l, r = 3 * 10**12, 10**13, 4 * 10**12 + 1, 5 * 10**12 + 3
    schema = "lang string, phrase string, size int, key long, a long, lefts array<long>, rights array<long>"
    found = spark.createDataFrame([("en", "x y z", 3, 1, a, [l, l], [r, r])], schema)
    row = scored(found, spark.createDataFrame([("en", n)], "lang string, n long")).collect()[0]
    assert (row.score, row.l, row.r) == (1000 * a * n // (l * r), l, r)


def test_empty_tables_and_texts_without_words(corpus):
    assert collocations(corpus()).collect() == []
    assert collocations(corpus((1, None, "en"), (2, " ..", None), (3, "", ""))).collect() == []


def test_chunks_are_stored_a_few_to_a_row_group(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK_BYTES", 200)
    stored = []
    keep = module.kept
    monkeypatch.setattr(module, "kept", lambda df, name, **more: stored.append(keep(df, name, **more)) or stored[-1])
    monkeypatch.setattr(module, "dropped", lambda *frames: None)
    docs = spark.createDataFrame([(f"a b c d e {i % 7}. " * 10, "en") for i in range(120)], "text string, lang string").coalesce(1)
    module.frequent_phrases(docs, 5, 3)
    chunks = [f for f in stored if "state" in f.columns]
    assert len(chunks) == 4 and chunks[0].count() > 20
    for frame in chunks:
        for path in frame.inputFiles():
            meta = pq.ParquetFile(path.removeprefix("file://")).metadata
            assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= module.ROWS
