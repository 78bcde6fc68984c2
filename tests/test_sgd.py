import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textspark.operators import sgd
from textspark.plans import skew


def slow(features, labels, classes, loss, rate, decay, l2, batches, epochs, seed):
    """The same steps in numpy: {term: weights}."""
    targets = classes[1:] if len(classes) == 2 else classes
    rows = {k: {sgd.INTERCEPT: 1.0} for k, y in labels if y is not None}
    for k, term, value in features:
        if k in rows:
            rows[k][term] = rows[k].get(term, 0.0) + value
    y = dict(labels)
    batch = {k: int(hashlib.md5(f"{k}:{seed}".encode()).hexdigest()[:8], 16) % batches for k in rows}
    w = {t: np.zeros(len(targets)) for r in rows.values() for t in r}
    for step in range(epochs * batches):
        part = [k for k in rows if batch[k] == step % batches]
        if not part:
            continue
        g = {t: np.zeros(len(targets)) for t in w}
        for k in part:
            m = sum(v * w[t] for t, v in rows[k].items())
            hit = np.array([y[k] == c for c in targets], float)
            e = 1 / (1 + np.exp(-m)) - hit if loss == "log" else np.where((2 * hit - 1) * m < 1, -(2 * hit - 1), 0)
            for t, v in rows[k].items():
                g[t] += v * e / len(part)
        now = rate / (1 + decay * step)
        w = {t: x - now * (g[t] + (0 if t == sgd.INTERCEPT else l2) * x) for t, x in w.items()}
    return w


@pytest.fixture
def words(spark):
    """Rows of three classes that share some terms; row 90 has no features, row 91 no label, row 92 only unknown terms."""
    rng = np.random.default_rng(4)
    features, labels = [], []
    for i in range(90):
        c = "abc"[i % 3]
        labels.append((i, c))
        terms = [*(f"{c}{j}" for j in rng.integers(0, 5, 4)), *(f"all{j}" for j in rng.integers(0, 3, 6))]
        features += [(i, t, float(terms.count(t))) for t in dict.fromkeys(terms)]
    labels += [(90, "a"), (91, None)]
    features.append((91, "a0", 1.0))
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    return features, labels, make(features, "id long, term string, value double"), make(labels, "id long, label string")


@pytest.mark.parametrize("loss", ["log", "hinge"])
@pytest.mark.parametrize("classes", [["a", "b", "c"], ["a", "b"]])
def test_equals_the_steps_in_numpy(words, loss, classes):
    features, labels, x, y = words
    how = dict(loss=loss, rate=0.5, decay=0.1, l2=0.05, batches=3, epochs=2, seed=5)
    kept = [(k, c if c in classes else None) for k, c in labels]
    model = sgd.fit(x, y.filter(F.col("label").isin(classes)), "id", classes=classes, **how)
    want = slow(features, kept, classes, **how)
    got = {r.term: r.w for r in model.weights.collect()}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[t], want[t]) for t in want)


def test_learns_and_predicts_every_row(words, spark):
    _, labels, x, y = words
    model = sgd.fit(x, y, "id", rate=2.0, batches=3, epochs=6)
    keys = spark.createDataFrame([(k,) for k, _ in labels] + [(92,)], "id long")
    rows = {r.id: r for r in model.predict(x.unionByName(spark.createDataFrame([(92, "new", 3.0)], x.schema)), keys).collect()}
    assert len(rows) == len(labels) + 1
    assert sum(rows[k].prediction == c for k, c in labels if k < 90) >= 88
    assert rows[90].scores == rows[92].scores  # the intercepts alone


def test_weights_too_many_to_broadcast_give_the_same(words, monkeypatch):
    _, _, x, y = words
    one = {r.term: r.w for r in sgd.fit(x, y, "id", batches=2).weights.collect()}
    monkeypatch.setattr(skew.fits_broadcast, "__defaults__", (0,))
    monkeypatch.setattr(skew.lookup_join, "__defaults__", ("inner", 64, 0))
    two = {r.term: r.w for r in sgd.fit(x, y, "id", batches=2).weights.collect()}
    assert one.keys() == two.keys() and all(np.allclose(one[t], two[t]) for t in one)


def test_unknown_loss(words):
    with pytest.raises(ValueError):
        sgd.fit(words[2], words[3], "id", loss="squared")


def test_shares_of_words_are_made_inside_the_row(spark):
    from textspark.catalog.models import _shares

    docs = spark.createDataFrame([(1, "aa bb aa cc"), (2, ""), (3, None), (4, "dd")], "doc_id long, text string")
    shares = _shares(docs)
    assert {(r.doc_id, r.term): r.value for r in shares.collect()} == {(1, "aa"): 0.5, (1, "bb"): 0.25, (1, "cc"): 0.25, (4, "dd"): 1.0}
    assert "Exchange" not in shares._jdf.queryExecution().toString()


def test_a_fit_keeps_its_last_weights_only(spark):
    """Slopes, weights of earlier steps and shuffles of finished steps go."""
    from pathlib import Path

    from textspark.plans.lineage import ensure_checkpoint_dir

    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    features = spark.createDataFrame([(i, f"t{(i + j) % 5}", 1.0 + j) for i in range(40) for j in range(3)], "id long, term string, value double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "id long, label int")
    model = sgd.fit(features, labels, "id", batches=2, epochs=2)
    assert model.weights.count() == 6
    # The batches, the terms, the heavy ones, the weights.
    assert len(set(folder.iterdir()) - before) == 4
