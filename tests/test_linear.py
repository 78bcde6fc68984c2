"""Linear models as tables, against the ML estimators on the same rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textspark.functions import tokens
from textspark.operators import learn, linear
from textspark.plans.stages import TokenStage


def _rows(classes, n, seed=1, null=False):
    """Words of the class, of its neighbour, and of everyone."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        c = i % classes
        words = [rng.choice([f"c{c}w{rng.randrange(6)}", f"c{(c + 1) % classes}w{rng.randrange(6)}", f"all{rng.randrange(8)}"]) for _ in range(rng.randrange(4, 20))]
        out.append((i, " ".join(words), None if null and i % 9 == 0 else "pqrs"[c]))
    return out


def _stages():
    return learn.tfidf_stages(TokenStage(inputCol="text", outputCol="tokens", analyzer="word", low=1, high=2), 2.0, 0.6)


def _both(spark, classes, estimator, n=90, null=False):
    data = spark.createDataFrame(_rows(classes, n, null=null), "id bigint, text string, label string").localCheckpoint()
    train = learn.fit_rows(data, "label", "id")
    return data, learn.text_classifier(train, [], _stages(), estimator), learn.text_classifier(train, [], _stages(), estimator, key="id")


def _scores(model, data):
    return {(r.id, r.label): r.score for r in learn.class_scores(model, data, "id").collect()}


@pytest.mark.parametrize("classes", [2, 3])
def test_logistic_models_as_tables_equal_the_estimator(spark, monkeypatch, classes):
    """The same minimum, with blocks of a few cells and terms; rows without a label are not learned from."""
    monkeypatch.setattr(linear, "CELLS", 64)
    monkeypatch.setattr(linear, "TERMS", 3)
    data, old, new = _both(spark, classes, learn.logistic_regression(90, 25).setTol(1e-9), null=True)
    assert isinstance(new, linear.TableModel)
    a, b = _scores(old, data), _scores(new, data)
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 2e-3
    assert {r.term: round(r.idf, 9) for r in learn.fitted_idf(old, data).collect()} == {r.term: round(r.idf, 9) for r in learn.fitted_idf(new, data).collect()}
    p, q = ({r.id: (r.predicted, r.probability) for r in learn.predict(m, data).collect()} for m in (old, new))
    assert p.keys() == q.keys() and all(p[i][0] == q[i][0] and np.allclose(p[i][1], q[i][1], atol=1e-3) for i in p)
    u, v = ({(r.label, r.term): r.weight for r in learn.coefficients(m, data).collect()} for m in (old, new))
    assert u.keys() == v.keys() and max(abs(u[k] - v[k]) for k in u) < 5e-3


def test_hinge_models_as_tables_reach_a_smaller_objective(spark):
    n, steps = 90, 20
    data, old, new = _both(spark, 3, learn.linear_svm(n, steps))
    machines = old.stages[-1].models
    side = lambda label, i: 1.0 if label == "pqrs"[i] else -1.0
    truth = {r.id: r.label for r in data.collect()}
    loss = sum(max(0.0, 1 - side(truth[i], "pqrs".index(c)) * s) for (i, c), s in _scores(old, data).items()) / n
    reached = loss + 0.5 / n * sum(float((m.coefficients.toArray() ** 2).sum()) for m in machines)
    assert new.objective <= reached + 1e-9
    mine = sum(max(0.0, 1 - side(truth[i], "pqrs".index(c)) * s) for (i, c), s in _scores(new, data).items()) / n
    size = new.weights.agg(F.sum(F.aggregate("w", F.lit(0.0), lambda t, x: t + x * x))).first()[0]
    assert abs(mine + 0.5 / n * size - new.objective) < 1e-9
    assert "probability" not in learn.predict(new, data).columns


def test_explanations_of_a_table_model_add_up(spark):
    data, _, new = _both(spark, 3, learn.logistic_regression(90, 10))
    more = data.unionByName(spark.createDataFrame([(1000, "zz zz", None), (1001, None, None)], data.schema))
    raw = _scores(new, more)
    rows = learn.explain_linear(new, more, "id", tokens.word_ngrams(tokens.word_tokens(F.col("text")), 1, 2), 2)
    sums = {(r.id, r.label): r.s for r in rows.groupBy("id", "label").agg(F.sum("contribution").alias("s")).collect()}
    assert len(sums) == 2 * 92 and all(abs(s - raw[k]) < 1e-9 for k, s in sums.items())
    assert {r.predicted for r in learn.predict(new, more).filter("id >= 1000").collect()} <= set("pqr")


def test_chunks_and_terms_over_many_batches(spark, monkeypatch):
    """A term that fills several Arrow batches and documents of several chunks."""
    monkeypatch.setattr(linear, "CELLS", 1000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rows = [(i, f"every {'left' if i % 2 else 'right'} w{i % 7}", "pq"[i % 2]) for i in range(9000)]
        data = spark.createDataFrame(rows, "id bigint, text string, label string").coalesce(1).localCheckpoint()
        stage = learn.tfidf_stages(TokenStage(inputCol="text", outputCol="tokens", analyzer="word"), 1.0, 1.0)
        model = learn.text_classifier(data, [], stage, learn.logistic_regression(9000, 8), key="id")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.term: r.df for r in model.weights.collect()} == {"every": 9000, "left": 4500, "right": 4500, **{f"w{i}": 1286 if i < 5 else 1285 for i in range(7)}}
    assert learn.predict(model, data).filter("predicted <> label").count() == 0


def test_a_fit_leaves_its_weights_only_and_moves_packed_cells(spark):
    """Numbered rows, the index and the states of the steps go; a document's cells are not rows of the shuffle."""
    from pathlib import Path

    from textspark.plans.lineage import ensure_checkpoint_dir, settled

    data = spark.createDataFrame(_rows(2, 60), "id bigint, text string, label string").localCheckpoint()
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    model = learn.text_classifier(data, [], _stages(), learn.logistic_regression(60, 4), key="id")
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - before] == ["weights"]
    rows = data.select(F.col("id").alias("_id"), F.split("text", " ").alias("_tokens"))
    assert linear._dealt(rows.coalesce(1), 5).count() == 5
    assert model.weights.select("part").distinct().count() > 1
    context, tracker = spark.sparkContext._jsc.sc(), spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    first = context.newShuffleId()
    assert linear.durable(data.groupBy("label").count()).count() == 2
    assert not any(tracker.containsShuffle(i) for i in range(first, first + 2))
    before = set(folder.iterdir())
    out = settled(lambda: linear.durable(data), "copy")
    assert out.count() == 60 and len(set(folder.iterdir()) - before) == 1
