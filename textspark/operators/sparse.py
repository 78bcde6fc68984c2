"""Sparse document vectors in long form: one (key, term, value) row per non-zero cell."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textspark.functions.arrays import value_counts
from textspark.plans.lineage import durable
from textspark.plans.ranking import row_index
from textspark.plans.skew import heavy_keys, lookup_join
from textspark.plans.union import union_rows


def bag_of_words(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, term, n). One input row is one document, so counting needs no shuffle."""
    return df.select(key, F.inline(value_counts(tokens)).alias("term", "n"))


def bags(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, cells): `bag_of_words` with a document's (term, n) cells in one row, in the order of the terms."""
    return df.select(key, value_counts(tokens).alias("cells"))


def without(tokens: Column, stopwords: Sequence[str]) -> Column:
    """Tokens minus a short list of stop words, applied before any n-grams are built."""
    return F.filter(tokens, lambda t: ~t.isin(list(stopwords))) if stopwords else tokens


def term_stats(bow: DataFrame) -> DataFrame:
    """(term, df, total) of a bag of words."""
    return bow.groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("total"))


def fit_terms(bow: DataFrame) -> DataFrame:
    """`term_stats` materialised: the fitted state of a vectoriser, one row per term, made in one pass."""
    return durable(term_stats(bow))


def prune(stats: DataFrame, n_docs: Column, min_df: int | float = 1, max_df: int | float = 1.0) -> DataFrame:
    """Keep terms within both bounds, ends included: ints are document counts, floats are shares."""

    def bound(limit: int | float) -> Column:
        return F.lit(limit) * n_docs if isinstance(limit, float) else F.lit(limit)

    return stats.filter((F.col("df") >= bound(min_df)) & (F.col("df") <= bound(max_df)))


def row_count(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def with_idf(stats: DataFrame, n_docs: Column) -> DataFrame:
    """Smooth inverse document frequency ln((1+N)/(1+df)) + 1."""
    return stats.withColumn("idf", F.ln((n_docs + 1.0) / (F.col("df") + 1.0)) + 1.0)


def tf(bow: DataFrame) -> DataFrame:
    return bow.withColumn("value", F.col("n").cast("double")).drop("n")


def tfidf(bow: DataFrame, stats: DataFrame, n_docs: Column) -> DataFrame:
    """(key, term, value) with value = count * idf, for terms present in the fitted `stats(term, df, ...)`."""
    table = with_idf(stats, n_docs)
    joined = lookup_join(bow, table.select("term", "idf"), ["term"], heavy_keys(stats, ["term"], "df"))
    return joined.withColumn("value", F.col("n") * F.col("idf")).drop("n", "idf")


def normalize(rows: DataFrame, key: str, norm: str | None = "l2", value: str = "value") -> DataFrame:
    """Scale each document's values to norm 1; a zero document is left alone.

    The window is partitioned by document, whose cells all come from one text.
    """
    if norm is None:
        return rows
    doc = Window.partitionBy(key)
    v = F.col(value)
    size = {
        "l2": F.sqrt(F.sum(v * v).over(doc)),
        "l1": F.sum(F.abs(v)).over(doc),
        "max": F.max(F.abs(v)).over(doc),
    }[norm]
    return (
        rows.withColumn("_size", size)
        .withColumn(value, F.when(F.col("_size") == 0, v).otherwise(F.try_divide(v, F.col("_size"))))
        .drop("_size")
    )


@dataclass
class Vocabulary:
    """A fitted vocabulary: (term, idx, df), with idx following the order of the terms."""

    terms: DataFrame

    @classmethod
    def fit(cls, bow: DataFrame, n_docs: Column | None = None, min_df: int | float = 1, max_df: int | float = 1.0):
        stats = term_stats(bow)
        if n_docs is not None:
            stats = prune(stats, n_docs, min_df, max_df)
        return cls(row_index(stats.select("term", "df"), [F.col("term")], "idx"))

    def transform(self, bow: DataFrame) -> DataFrame:
        """(key, idx, term, n) of unseen documents; unknown terms are ignored."""
        heavy = heavy_keys(self.terms, ["term"], "df")
        return lookup_join(bow, self.terms.select("term", "idx"), ["term"], heavy)


def stack(spaces: Mapping[str, DataFrame]) -> DataFrame:
    """Representations side by side: the union of long forms, or of bags, each under its own space name."""
    return union_rows(*[rows.withColumn("space", F.lit(name)) for name, rows in spaces.items()])


def per_column(df: DataFrame, key: str, columns: Mapping[str, Column]) -> DataFrame:
    """One bag of words per column in a single pass, features named "term (column)"."""

    def named(tokens: Column, name: str) -> Column:
        feature = F.lit(f" ({name})")
        return F.transform(
            value_counts(tokens), lambda e: F.struct(F.concat(e["term"], feature).alias("term"), e["n"].alias("n"))
        )

    bags = [named(tokens, name) for name, tokens in columns.items()]
    return df.select(key, F.inline(F.concat(*bags)).alias("term", "n"))


def weighted_bag(df: DataFrame, key: str, parts: Mapping[Column, int] | list[tuple[Column, int]]) -> DataFrame:
    """Bag of words in which a part's tokens count `weight` times; equals repeating the part for single words."""
    pairs = parts.items() if isinstance(parts, Mapping) else parts
    repeated = [tokens for tokens, weight in pairs for _ in range(weight)]
    return bag_of_words(df, key, F.concat(*repeated))


def wide(bow: DataFrame, key: str, terms: list[str]) -> DataFrame:
    """Dense view with one column per term of a small list; documents without any of them are absent."""
    picked = bow.filter(F.col("term").isin(terms))
    cells = [F.coalesce(F.sum(F.when(F.col("term") == t, F.col("n"))), F.lit(0)).alias(t) for t in terms]
    return picked.groupBy(key).agg(*cells)


def document_terms(bow: DataFrame, key: str, value) -> DataFrame:
    """Non-zero features of one document."""
    return bow.filter(F.col(key) == F.lit(value))


def cosine_pairs(rows: DataFrame, key: str, pairs: DataFrame, value: str = "value") -> DataFrame:
    """Cosine of the given document pairs (a, b): a join on (pair, term) plus the squared norms.

    Null where a document has no length. Work grows with the cells of the listed pairs only.
    """
    sides = rows.select(key, "term", value)
    norms = sides.groupBy(key).agg(F.sum(F.col(value) * F.col(value)).alias("_sq"))
    left = pairs.join(sides.toDF("a", "term", "_va"), "a")
    right = pairs.join(sides.toDF("b", "term", "_vb"), "b")
    dots = (
        left.join(right, ["a", "b", "term"]).groupBy("a", "b").agg(F.sum(F.col("_va") * F.col("_vb")).alias("_dot"))
    )
    return (
        pairs.join(dots, ["a", "b"], "left")
        .join(norms.toDF("a", "_sa"), "a", "left")
        .join(norms.toDF("b", "_sb"), "b", "left")
        .select(
            "a",
            "b",
            F.try_divide(F.coalesce("_dot", F.lit(0.0)), F.sqrt("_sa") * F.sqrt("_sb")).alias("cosine"),
        )
    )
