"""Linear classifiers by mini-batch gradient descent, for vocabularies that no single machine holds.

Features are long rows (key, term, value). The weights are a table (term, w) with one value per class in `w`; a step
joins the rows of one batch to it, adds up the margins by key and the gradients by term, and writes the next table. The
driver keeps the class list and one row count a batch. Rows of a batch are stored together, so a step reads its batch
only; a batch moves twice (by key, by term) and the weights once.

With two classes there is one weight for the second; with more, one against the rest each. A row without features has the
intercept alone; rows without a label are not learned from.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.plans.lineage import discarded, durable, shared_dir, shuffles_removed, stored
from textspark.plans.skew import heavy_keys, lookup_join
from textspark.plans.union import union_rows

#: The term of the constant feature; its weight is not shrunk.
INTERCEPT = "(intercept)"


def batch_of(key: Column, batches: int, seed: int) -> Column:
    """The batch of a row by a seeded md5 of its key, the same in every epoch."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % batches


def with_intercept(features: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Long features with the constant feature of every row of `keys`."""
    constant = keys.select(key, F.lit(INTERCEPT).alias("term"), F.lit(1.0).alias("value"))
    return union_rows(features.select(key, "term", F.col("value").cast("double").alias("value")), constant)


def _slope(loss: str, margin: Column, hit: Column) -> Column:
    """Derivative of the loss by the margin; `hit` says whether the row is of the class."""
    if loss == "log":
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - hit.cast("double")
    side = F.when(hit, 1.0).otherwise(-1.0)
    return F.when(side * margin < 1.0, -side).otherwise(0.0)


@dataclass
class LinearModel:
    """weights: (term, w array<double>), one place per target; heavy: the terms that own most rows of the training set."""

    weights: DataFrame
    heavy: DataFrame
    classes: list
    key: str

    def scores(self, features: DataFrame, keys: DataFrame) -> DataFrame:
        """(key, scores array<double>): the margin of every target for every row of `keys`; unknown terms add nothing."""
        rows = with_intercept(features, keys, self.key).join(keys.select(self.key), self.key, "left_semi")
        return _margins(rows, self.weights, self.heavy, [self.key], _targets(self.classes)).select(self.key, F.array(*_columns(self.classes)).alias("scores"))

    def predict(self, features: DataFrame, keys: DataFrame) -> DataFrame:
        """(key, scores, prediction): the class of the highest margin, ties to the first."""
        labels = F.array(*map(F.lit, self.classes))
        if len(self.classes) == 2:
            best = F.when(F.col("scores")[0] > 0, 2).otherwise(1)
        else:
            best = F.array_position("scores", F.array_max("scores")).cast("int")
        return self.scores(features, keys).withColumn("prediction", F.element_at(labels, best))


def _targets(classes: Sequence) -> list:
    return list(classes[1:]) if len(classes) == 2 else list(classes)


def _columns(classes: Sequence) -> list[str]:
    return [f"_m{i}" for i in range(len(_targets(classes)))]


def _margins(rows: DataFrame, weights: DataFrame, heavy: DataFrame, by: list[str], targets: list) -> DataFrame:
    size = 64 + 8 * len(targets)
    met = lookup_join(rows, weights, ["term"], heavy, row_bytes=size)
    return met.groupBy(*by).agg(*(F.sum(F.col("value") * F.col("w")[i]).alias(f"_m{i}") for i in range(len(targets))))


def fit(
    features: DataFrame,
    labels: DataFrame,
    key: str,
    label: str = "label",
    classes: Sequence | None = None,
    loss: str = "log",
    rate: float = 0.5,
    decay: float = 0.0,
    l2: float = 0.0,
    batches: int = 4,
    epochs: int = 1,
    seed: int = 0,
) -> LinearModel:
    """Weights after `epochs` passes over `batches` mini-batches, from zero; step s uses rate / (1 + decay * s).

    `loss` is "log" or "hinge". A step is w - rate * (mean gradient + l2 * w).
    """
    if loss not in ("log", "hinge"):
        raise ValueError(f"loss {loss!r} is neither log nor hinge")
    spark = features.sparkSession
    known = labels.filter(F.col(label).isNotNull()).select(key, F.col(label).alias("_label"))
    classes = sorted(r[0] for r in known.select("_label").distinct().collect()) if classes is None else list(classes)
    targets = _targets(classes)
    # Written once, a folder a batch, so that a step opens its own batch only.
    path = shared_dir(spark, "batches")
    batch = batch_of(F.col(key), batches, seed).cast("int").alias("_batch")
    labelled = with_intercept(features.join(known.select(key), key, "left_semi"), known, key).join(known, key)
    with shuffles_removed(spark):
        labelled.select("*", batch).write.option("compression", "zstd").partitionBy("_batch").parquet(path)
    rows = spark.read.parquet(path)
    terms = durable(rows.groupBy("term").agg(F.count("*").alias("_n")))
    heavy = durable(heavy_keys(terms, ["term"], "_n"))
    sizes = {r[0]: r[1] for r in known.groupBy(batch).count().collect()}
    weights = durable(terms.select("term", F.array_repeat(F.lit(0.0), len(targets)).alias("w")))
    for step in range(epochs * batches):
        part, n = rows.filter(F.col("_batch") == step % batches), sizes.get(step % batches, 0)
        if not n:
            continue
        margins = _margins(part, weights, heavy, [key, "_label"], targets)
        # Stored, so that the shuffles behind the margins are gone when the rows move to meet the slopes.
        slopes = stored(
            margins.select(key, *(_slope(loss, F.col(f"_m{i}"), F.col("_label") == F.lit(c)).alias(f"_s{i}") for i, c in enumerate(targets))), "slopes"
        )
        sums = [F.sum(F.col("value") * F.col(f"_s{i}")) / F.lit(float(n)) for i in range(len(targets))]
        gradient = part.select(key, "term", "value").join(slopes, key).groupBy("term").agg(F.array(*sums).alias("_g"))
        now = rate / (1.0 + decay * step)
        shrink = F.when(F.col("term") == INTERCEPT, 0.0).otherwise(l2)
        zero = F.array_repeat(F.lit(0.0), len(targets))
        moved = F.zip_with("w", F.coalesce("_g", zero), lambda w, g: w - F.lit(now) * (g + shrink * w))
        old, weights = weights, durable(weights.join(gradient, "term", "left").select("term", moved.alias("w")))
        discarded(slopes, old)
    return LinearModel(weights, heavy, classes, key)
