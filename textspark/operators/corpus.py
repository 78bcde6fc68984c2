"""Corpus statistics: term counts, document frequency, label counts, contrast terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textspark.plans.lineage import durable
from textspark.plans.ranking import row_index, top_k_per_group
from textspark.plans.skew import heavy_keys, lookup_join


def term_rows(df: DataFrame, tokens: Column, *keep: str) -> DataFrame:
    """One row per token occurrence."""
    return df.select(*keep, F.explode(tokens).alias("term"))


def word_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """(term, n) over the whole corpus; map-side partial counts absorb hot terms."""
    return term_rows(df, tokens).groupBy("term").agg(F.count("*").alias("n"))


def most_common(counts: DataFrame, k: int, exclude: DataFrame | None = None) -> DataFrame:
    """The k most frequent terms, ties by term; optionally none of those in `exclude(term)`."""
    if exclude is not None:
        counts = counts.join(exclude, "term", "left_anti")
    return counts.orderBy(F.desc("n"), "term").limit(k)


def document_frequency(df: DataFrame, tokens: Column) -> DataFrame:
    """(term, df, n): in how many rows a term occurs. Distinct terms are found inside the row."""
    return (
        df.select(F.explode(F.array_distinct(tokens)).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )


def hapax_share(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.avg(F.when(F.col("n") == 1, 1.0).otherwise(0.0)).alias("hapax_share"),
        F.count("*").alias("n_terms"),
    )


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label)


def rare_labels(df: DataFrame, label: str, k: int = 10) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy("n", label).limit(k)


def distinct_label_count(df: DataFrame, label: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(label) if approximate else F.count_distinct(label)
    return df.agg(count.alias("n_labels"))


def label_terms(df: DataFrame, label: str, tokens: Column, stopwords: DataFrame, k: int) -> DataFrame:
    """The k most frequent non-stop terms of every label: the data behind a word cloud."""
    counts = (
        term_rows(df, tokens, label)
        .groupBy(label, "term")
        .agg(F.count("*").alias("n"))
        .join(stopwords.select("term"), "term", "left_anti")
    )
    return top_k_per_group(counts, [label], [F.desc("n"), F.col("term")], k)


def percent_ranks(df: DataFrame, values: list[str]) -> DataFrame:
    """Adds `<value>_pr`, the percent rank of each column, as percent_rank() would give.

    A percent rank depends on the value alone, so it is computed once per distinct value from running
    counts over a range-partitioned index and joined back; no single task sorts the whole frame. A value that
    most rows share meets a broadcast slice of the ranks and does not move.
    """
    df = durable(df)
    total = df.agg(F.count("*")).scalar()
    for value in values:
        sizes = durable(df.groupBy(value).agg(F.count("*").alias("_n")))
        ranks = running_total(row_index(sizes, [F.col(value)], "_i"), "_i", "_n").select(
            value,
            F.when(total > 1, (F.col("_before") / (total - 1)).cast("double")).otherwise(0.0).alias(f"{value}_pr"),
        )
        df = lookup_join(df, durable(ranks), [value], heavy_keys(sizes, [value], "_n"))
    return df


_BLOCK = 1 << 14


def running_total(indexed: DataFrame, index: str, weight: str) -> DataFrame:
    """Adds `_before`: the sum of `weight` over all rows with a smaller index, block by block."""
    blocks = indexed.withColumn("_block", F.shiftright(F.col(index), _BLOCK.bit_length() - 1))
    sums = blocks.groupBy("_block").agg(F.sum(weight).alias("_sum"))
    # One row per 16,384 indexed rows reaches this ordered window.
    starts = sums.select("_block", (F.sum("_sum").over(Window.orderBy("_block")) - F.col("_sum")).alias("_start"))
    inside = Window.partitionBy("_block").orderBy(index)
    return (
        blocks.withColumn("_inside", F.sum(weight).over(inside) - F.col(weight))
        .join(starts, "_block")
        .withColumn("_before", F.col("_start") + F.col("_inside"))
        .drop("_block", "_inside", "_start")
    )


def contrast_terms(df: DataFrame, category: Column, tokens: Column, min_count: int = 1) -> DataFrame:
    """Terms that set one category apart.

    Per term: count inside the category and outside, precision (share of its uses inside), frequency (share of
    the category's tokens), and the harmonic mean of the percent ranks of both. The category total is the sum
    of the per-term counts, so a term's frequency rank equals the rank of its inside count.
    """
    per_term = (
        df.select(category.alias("_in"), F.explode(tokens).alias("term"))
        .groupBy("term")
        .agg(
            F.count_if(F.col("_in")).alias("n_in"),
            F.count_if(~F.col("_in")).alias("n_out"),
        )
        .filter(F.col("n_in") + F.col("n_out") >= min_count)
        .withColumn("precision", F.col("n_in") / (F.col("n_in") + F.col("n_out")))
    )
    ranked = percent_ranks(per_term, ["precision", "n_in"])
    p, f = F.col("precision_pr"), F.col("n_in_pr")
    return ranked.select(
        "term",
        "n_in",
        "n_out",
        "precision",
        F.when(p + f > 0, 2 * p * f / (p + f)).otherwise(0.0).alias("score"),
    )
