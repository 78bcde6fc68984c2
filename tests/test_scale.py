"""Steps whose cost must not grow faster than the rows."""

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF
from pyspark.sql import functions as F

from textspark.catalog import QUERIES, load_all
from textspark.functions import tokens
from textspark.operators import learn, phrases
from textspark.plans.stages import TokenStage

load_all()


def test_tasks_of_word_vectors_are_bounded_by_the_cores():
    assert [learn.embedding_partitions(n, most=12) for n in (0, 20_001, 240_001, 30_000_000)] == [1, 2, 12, 12]
    assert learn.embedding_partitions(5, most=0) == 1


def test_padded_grams_of_one_size_come_from_one_walk(column):
    def words_of(text, n):
        padded = [f" {w} " for w in text.lower().split()]
        return [g for w in padded for g in ([w] if len(w) < n else [w[i : i + n] for i in range(len(w) - n + 1)])]

    texts = ["", "  ", "a", "a bcd", " ab  c\n\tdéf🙂gh x ", "\u0085one\x1ctwo", "Ab " * 5 + "abcdefg", "🙂 🙂🙂"]
    for n in (3, 4, 5, 7):
        got = column(lambda c: tokens.char_wb_ngrams(c, n, n), *texts)
        assert got == [words_of(t, n) for t in texts]
    plan = repr(tokens.char_wb_ngrams(F.col("text"), 4, 4))
    assert "transform" not in plan.lower()


def test_padded_grams_of_a_missing_text_are_missing(texts):
    assert texts(None).select(tokens.char_wb_ngrams(F.col("text"), 4, 4)).first()[0] is None


def test_pairs_of_a_batch_are_counted_with_the_words_between():
    rows = [["a", "of", "b", "a", "of", "b"], [], ["of"], None, ["a", "b"], ["a", None, "of", "of", "b"]]
    table = phrases._neighbours(pa.array(rows, pa.list_(pa.string())), pa.array(["of"]))
    found = {(r["a"], r["b"], r["between"]): r["n"] for r in table.to_pylist()}
    pairs = {("a", "b", "of"): 2, ("b", "a", None): 1, ("a", "b", None): 1, ("a", "b", "of\u001fof"): 1}
    assert found == {("a", None, None): 4, ("b", None, None): 4} | pairs


def test_common_words_may_be_absent_and_sentences_empty(spark):
    rows = [(1, 0, ["x", "y"]), (1, 1, []), (2, 0, ["x", "y"])]
    sents = spark.createDataFrame(rows, "id int, sent int, tokens array<string>")
    found = phrases.learn_phrases(sents, [], min_count=1, threshold=0.1).collect()
    assert [(r.span, r.a, r.b, r.n) for r in found] == [("x\u001fy", "x", "y", 2)]
    assert phrases.learn_phrases(sents.limit(0), [], 1, 0.1).collect() == []


def test_stacked_bags_stay_in_their_rows(spark):
    plan = QUERIES["stacked"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "hashpartitioning" not in plan


def test_estimators_after_the_counts_see_no_more_partitions_than_cores(spark, monkeypatch):
    seen = {}
    for kind in (LogisticRegression, IDF):
        monkeypatch.setattr(kind, "_fit", lambda self, df, fit=kind._fit: seen.update({type(self): df.rdd.getNumPartitions()}) or fit(self, df))
    rows = [(i, "abcd " * (1 + i % 3) + "wxyz" * (i % 2), "ab"[i % 2]) for i in range(40)]
    train = spark.createDataFrame(rows, "doc_id int, text string, label string").repartition(16)
    chars = TokenStage(inputCol="text", outputCol="tokens", analyzer="char", low=4, high=4)
    model = learn.text_classifier(train, [], learn.tfidf_stages(chars), learn.logistic_regression(40, 5))
    cores = spark.sparkContext.defaultParallelism
    assert seen == {LogisticRegression: cores, IDF: cores} and cores < 16
    assert learn.predict(model, train).filter("label <> predicted").count() == 0
