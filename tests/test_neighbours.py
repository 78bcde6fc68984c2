import numpy as np
import pytest
from pyspark.sql import functions as F

from textspark.operators import neighbours

WORDS = "word string, embedding array<double>"


def slow(words, queries, k):
    """{(qid, rank): word} by comparing everything in one loop."""
    long = {w: np.array(v, float) / np.linalg.norm(v) for w, v in words}
    out = {}
    for qid, vec in queries:
        q = np.array(vec, float) / np.linalg.norm(vec)
        ranked = sorted(long, key=lambda w: (-round(float(q @ long[w]), 12), w))
        out.update({(qid, i + 1): w for i, w in enumerate(ranked[:k])})
    return out


@pytest.fixture
def small(monkeypatch):
    """Blocks small enough for many of them to meet."""
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 7)
    monkeypatch.setattr(neighbours, "WORD_ROWS", 16)


@pytest.mark.parametrize("k", [1, 5, 16])
def test_equals_a_plain_loop_with_many_ties(spark, small, k):
    pick = np.random.default_rng(k)
    # Few distinct directions, so most similarities are ties, within and across blocks.
    words = [(f"w{i}", pick.integers(-1, 2, 3).tolist()) for i in range(90)]
    words = [(w, [float(x) for x in v]) for w, v in words if any(v)]
    queries = [(i, [float(x) for x in pick.normal(size=3)]) for i in range(10)] + [(99, [2.0, 0.0, 0.0])]
    found = neighbours.nearest(spark.createDataFrame(words, WORDS), spark.createDataFrame(queries, "qid long, vec array<double>"), k)
    assert {(r.qid, r["rank"]): r.word for r in found.collect()} == slow(words, queries, k)


def test_every_word_as_query_leaves_itself_out(spark, small):
    pick = np.random.default_rng(0)
    words = [(f"w{i:02}", [float(x) for x in pick.normal(size=4)]) for i in range(50)]
    words += [("twin", words[3][1]), ("twin2", [2 * x for x in words[3][1]])]
    table = spark.createDataFrame(words, WORDS)
    got = neighbours.most_similar(table, table.select("word"), 4).collect()
    assert len(got) == 4 * len(words) and all(r.query != r.word for r in got)
    want = slow(words, words, 60)
    for r in got:
        others = [want[r.query, i] for i in range(1, 53) if want[r.query, i] != r.query]
        assert r.word == others[r["rank"] - 1]
    assert [r.word for r in sorted((r for r in got if r.query == "w03"), key=lambda r: r["rank"])][:2] == ["twin", "twin2"]


def test_vectors_without_a_direction_and_empty_tables(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", None), ("d", [float("nan"), 1.0]), ("e", [None, 1.0]), ("f", [float("inf"), 0.0]), (None, [1.0, 1.0]), ("g", [1.0, 1.0])]
    table = spark.createDataFrame(rows, WORDS)
    got = neighbours.most_similar(table, table.select("word"), 5).collect()
    assert sorted((r.query, r.word, r["rank"]) for r in got) == [("a", "g", 1), ("g", "a", 1)]
    none = table.limit(0)
    assert neighbours.most_similar(none, table.select("word"), 3).count() == 0
    assert neighbours.nearest(none, table.select(F.col("word").alias("qid"), F.col("embedding").alias("vec")), 3).count() == 0
    with pytest.raises(ValueError):
        neighbours.nearest(table, table.select(F.col("word").alias("qid"), F.col("embedding").alias("vec")), 0)


def test_neighbourhoods_of_a_table_of_seeds(spark):
    table = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", [0.0, 1.0])], WORDS)
    seeds = spark.createDataFrame([("x", "a"), ("x", "a"), ("y", "a"), ("y", "gone")], "grp string, word string")
    got = neighbours.neighbourhoods(table, seeds, 1).collect()
    assert sorted((r.grp, r["rank"], r.word, r.found) for r in got) == [
        ("x", 0, "a", True), ("x", 1, "b", True), ("y", 0, "a", True), ("y", 0, "gone", False), ("y", 1, "b", True)
    ]


def test_nothing_is_broadcast_or_crossed(spark):
    """The plan that meets the blocks has shuffles only."""
    table = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], WORDS)
    plans = []
    kept = neighbours.durable
    try:
        neighbours.durable = lambda df: plans.append(df._jdf.queryExecution().toString()) or kept(df)
        neighbours.most_similar(table, table.select("word"), 1).count()
    finally:
        neighbours.durable = kept
    assert plans and not any("Cartesian" in p or "NestedLoop" in p or "BroadcastExchange" in p for p in plans[-1:])


def test_large_query_blocks_are_compared_in_steps(spark, monkeypatch):
    """Words pass a block of queries once, however few queries a product takes."""
    rng = np.random.default_rng(4)
    rows = [(f"w{i:02}", [float(x) for x in rng.normal(size=3)]) for i in range(23)]
    df = spark.createDataFrame(rows, "word string, embedding array<double>")
    queries = df.select(F.col("word").alias("qid"), F.col("embedding").alias("vec"))
    ordered = lambda: sorted((r.qid, r["rank"], r.word) for r in neighbours.nearest(df, queries, 4).collect())
    whole = ordered()
    monkeypatch.setattr(neighbours, "STEP_ROWS", 4)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 10)
    monkeypatch.setattr(neighbours, "WORD_ROWS", 6)
    assert ordered() == whole and len(whole) == 23 * 4
