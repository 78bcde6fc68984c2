import random
import time

import pytest
from pyspark.sql import functions as F

from textspark.functions import clean
from textspark.operators import keywords


def table(spark, pairs):
    return spark.createDataFrame([(k, v) for k, v in pairs], "keyword string, replacement string")


PAIRS = {"Paris": "P", "new york": "NY", "new york city": "NYC", "city": "town", "Über": "over", "c++": "cpp", "a_b": "", "of the": "$1 \\1", "42": "answer"}
TEXTS = [
    "New York City, new york and New Yorkers; parisian Paris", "über ÜBER überall", "c++ c+++ xc++ c++x", "a_b a_bc za_b 42 421 4 2",
    "out of the city of the new york city", "", None, "  ", "İstanbul Paris ſ K", "new  york new york", "paris" * 3, "Paris" + " of the" * 2000,
]


@pytest.mark.parametrize("case_sensitive", [False, True])
@pytest.mark.parametrize("portion", [1 << 20, 60])
def test_same_rows_as_the_list(spark, texts, monkeypatch, case_sensitive, portion):
    """Also where the dictionary takes several portions."""
    monkeypatch.setattr(keywords, "PORTION_BYTES", portion)
    df = texts(*TEXTS).withColumn("hits", F.lit(1))
    got = keywords.replace_from_table(df, "text", table(spark, PAIRS.items()), case_sensitive=case_sensitive)
    assert got.columns == df.columns
    want = df.withColumn("text", clean.replace_keywords(F.col("text"), PAIRS, case_sensitive))
    assert {r.id: r.text for r in got.collect()} == {r.id: r.text for r in want.collect()}


def test_random_dictionaries(spark, texts):
    rng = random.Random(3)
    words = ["alpha", "beta", "ga", "g", "alphabet", "-", "beta."]
    for _ in range(4):
        pairs = {" ".join(rng.choices(words, k=rng.randrange(1, 4))): f"<{i}>" for i in range(12)}
        df = texts(*(" ".join(rng.choices(words + ["x", "ga,"], k=40)) for _ in range(12)))
        got = keywords.replace_from_table(df, "text", table(spark, pairs.items())).orderBy("id").collect()
        want = df.select("id", clean.replace_keywords(F.col("text"), pairs).alias("text")).orderBy("id").collect()
        assert [r.text for r in got] == [r.text for r in want]


def test_ten_thousand_keywords_take_no_longer(spark, texts):
    line = " ".join(f"word{i % 977} filler" for i in range(4000))
    df = texts(*([line] * 200)).repartition(4).cache()
    df.count()
    seconds = []
    for n in (100, 10_000):
        out = keywords.replace_from_table(df, "text", table(spark, [(f"word{i}x", "y") for i in range(n)]))
        out.write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        out.write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 3 * seconds[0] + 1


def test_repeated_empty_and_null_entries(spark, texts):
    entries = table(spark, [("a", "2"), ("A", "1"), ("", "x"), (None, "y"), ("b", None)])
    got = keywords.replace_from_table(texts("a b c"), "text", entries).first().text
    assert got == "1  c"
    assert keywords.replace_from_table(texts("a"), "text", table(spark, [])).first().text == "a"
    assert keywords.remove_from_table(texts("the cat", None), "text", table(spark, [("The", None)])).orderBy("id").first().text == "  cat"


def test_large_dictionaries_are_joined_in_a_fixed_number_of_passes(spark, texts, monkeypatch):
    """Texts are written once, not once for every portion of the dictionary; chunks may cut anywhere."""
    written = []
    keep = keywords.durable
    monkeypatch.setattr(keywords, "durable", lambda df: written.append(df.columns) or keep(df))
    monkeypatch.setattr(keywords, "PORTION_BYTES", 60)
    monkeypatch.setattr(keywords, "CHUNK_BYTES", 30)
    df = texts(*(f"word{i} and word{i + 1}, the word{i}x" for i in range(40)), None, "")
    for pairs in ({f"word{i}": f"<{i}>" for i in range(30)}, {f"word{i}{' and' * (i % 2)}": f"<{i}>" for i in range(30)}):
        written.clear()
        got = keywords.replace_from_table(df, "text", table(spark, pairs.items()))
        want = df.withColumn("text", clean.replace_keywords(F.col("text"), pairs))
        assert {r.id: r.text for r in got.collect()} == {r.id: r.text for r in want.collect()}
        assert len(written) <= 2
