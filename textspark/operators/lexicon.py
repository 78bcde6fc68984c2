"""Token rewriting through lexicon tables, and audits of what a cleaning step changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.functions import patterns
from textspark.functions.arrays import value_counts
from textspark.functions.tokens import find_all, sentences
from textspark.plans.skew import heavy_keys, lookup_join


def token_positions(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, pos, token); a document without tokens keeps one row with nulls, so that no text is lost on the way back."""
    return df.select(key, F.posexplode_outer(tokens).alias("pos", "token"))


def rewrite_tokens(
    rows: DataFrame, lexicon: DataFrame, on: Callable[[Column], Column] = F.lower
) -> DataFrame:
    """Replaces `token` by the lexicon's `replacement` where on(token) equals `entry`; others stay.

    `lexicon` is materialised and unique on entry.
    """
    keyed = rows.withColumn("entry", on(F.col("token")))
    heavy = heavy_keys(keyed.groupBy("entry").agg(F.count("*").alias("_n")), ["entry"], "_n")
    out = lookup_join(keyed, lexicon.select("entry", "replacement"), ["entry"], heavy, "left")
    return out.select(
        *[c for c in rows.columns if c != "token"], F.coalesce("replacement", "token").alias("token")
    )


def join_tokens(rows: DataFrame, key: str, name: str = "text") -> DataFrame:
    """Puts a document's tokens back in order, separated by single spaces; without tokens the text is empty."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", "token")))
    return rows.groupBy(key).agg(F.array_join(F.transform(ordered, lambda t: t["token"]), " ").alias(name))


def proper_names(df: DataFrame, text: Column) -> DataFrame:
    """(entry, replacement): words seen capitalised inside a sentence and never in lower case.

    `entry` is the lowercased word, `replacement` its most frequent capitalised form.
    """
    tokens = df.select(
        F.explode(F.transform(sentences(text), lambda s: find_all(s, patterns.WORD))).alias("tokens")
    ).select(F.posexplode("tokens").alias("pos", "token"))
    forms = tokens.groupBy("token").agg(
        F.count("*").alias("n"), F.count_if(F.col("pos") > 0).alias("n_inside")
    )
    lower = F.lower("token")
    capital = F.col("token").rlike(r"^\p{Lu}")
    per_word = forms.groupBy(lower.alias("entry")).agg(
        F.bool_or(F.col("token") == lower).alias("seen_lower"),
        F.bool_or(capital & (F.col("n_inside") > 0)).alias("seen_inside"),
        F.min(F.when(capital & (F.col("n_inside") > 0), F.struct((-F.col("n_inside")).alias("m"), "token"))).alias("best"),
    )
    return per_word.filter(F.col("seen_inside") & ~F.col("seen_lower")).select(
        "entry", F.col("best.token").alias("replacement")
    )


def lower_keep_names(df: DataFrame, key: str, text: Column, names: DataFrame) -> DataFrame:
    """(key, pos, token): word tokens in lower case, except the given proper names, which keep their form.

    `names` lists lowercased words in `entry`.
    """
    rows = token_positions(df, key, find_all(text, patterns.WORD)).withColumn("entry", F.lower("token"))
    heavy = heavy_keys(rows.groupBy("entry").agg(F.count("*").alias("_n")), ["entry"], "_n")
    listed = names.select("entry", F.lit(True).alias("_name"))
    merged = lookup_join(rows, listed, ["entry"], heavy, "left")
    return merged.select(
        key, "pos", F.when(F.col("_name"), F.col("token")).otherwise(F.col("entry")).alias("token")
    )


def change_audit(df: DataFrame, key: str, before: Column, after: Column) -> DataFrame:
    """(key, term, delta): tokens a cleaning step removed (negative) or added, per document.

    Both sides live in the same row, so the multiset difference is taken there; the outer join of the two
    token counts is a sum over their concatenation.
    """

    def signed(tokens: Column, sign: int) -> Column:
        return F.transform(
            value_counts(tokens),
            lambda e: F.struct(e["term"].alias("term"), (e["n"] * sign).alias("n")),
        )

    both = F.concat(signed(before, -1), signed(after, 1))
    return (
        df.select(key, F.inline(both).alias("term", "delta"))
        .groupBy(key, "term")
        .agg(F.sum("delta").alias("delta"))
        .filter(F.col("delta") != 0)
    )


def removed_terms(audit: DataFrame) -> DataFrame:
    """(term, removed, added) over the corpus."""
    return audit.groupBy("term").agg(
        F.sum(F.when(F.col("delta") < 0, -F.col("delta")).otherwise(0)).alias("removed"),
        F.sum(F.when(F.col("delta") > 0, F.col("delta")).otherwise(0)).alias("added"),
    )
