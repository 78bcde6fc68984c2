"""Evaluation of (label, prediction) rows. Only class-by-class counts leave the map tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from textspark.plans.union import union_rows


def pair_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return df.agg(F.avg(hit).alias("accuracy"), F.count("*").alias("n"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then the macro and weighted means; 0 where undefined.

    Each (label, prediction) count contributes to its row class and its column class, so one more
    aggregation over the small count table replaces three joins.
    """
    counts = pair_counts(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("label").cast("string").alias("cls"), F.col("n").alias("actual"),
                         zero.alias("guessed"), hit.cast("bigint").alias("tp")),
                F.struct(F.col("prediction").cast("string").alias("cls"), zero.alias("actual"),
                         F.col("n").alias("guessed"), zero.alias("tp")),
            )
        ).alias("s")
    ).select("s.*")
    per = sides.groupBy("cls").agg(
        F.sum("actual").alias("support"), F.sum("guessed").alias("guessed"), F.sum("tp").alias("tp")
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    p, r = F.col("precision"), F.col("recall")
    per = (
        per.withColumn("precision", ratio(F.col("tp"), F.col("guessed")))
        .withColumn("recall", ratio(F.col("tp"), F.col("support")))
        .withColumn("f1", ratio(2 * p * r, p + r))
    )
    scores = ["precision", "recall", "f1"]
    macro = per.agg(*[F.avg(s).alias(s) for s in scores], F.sum("support").alias("support")).withColumn(
        "cls", F.lit("macro avg")
    )
    weighted = per.agg(
        *[ratio(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(s) for s in scores],
        F.sum("support").alias("support"),
    ).withColumn("cls", F.lit("weighted avg"))
    columns = ["cls", *scores, "support"]
    return union_rows(*[rows.select(*columns) for rows in (per, macro, weighted)])


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n, share): counts and shares of the true class, zero-filled over all classes.

    The grid comes from the count table alone: every true class meets the list of classes seen on either
    side, held as one array value.
    """
    counts = pair_counts(df, label, prediction)
    classes = counts.select(F.explode(F.array("label", "prediction")).alias("c")).agg(
        F.sort_array(F.collect_set("c"))
    ).scalar()
    rows = counts.groupBy("label").agg(
        F.map_from_entries(F.collect_list(F.struct("prediction", "n"))).alias("seen"), F.sum("n").alias("total")
    )
    cells = rows.select("label", "seen", "total", F.explode(classes).alias("prediction"))
    n = F.coalesce(F.try_element_at("seen", F.col("prediction")), F.lit(0)).cast("bigint")
    return cells.select("label", "prediction", n.alias("n"), (n / F.col("total")).alias("share"))


def confident_errors(df: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """Wrong predictions, the most confident first. Needs label, prediction and probability array<double>."""
    wrong = (
        df.filter(F.col("label") != F.col("prediction"))
        .withColumn("confidence", F.array_max("probability"))
        .orderBy(F.desc("confidence"), key)
    )
    return wrong if k is None else wrong.limit(k)
