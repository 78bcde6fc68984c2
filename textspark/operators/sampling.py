"""Reproducible sampling, splitting, quotas and batches: all ordered by hashes or keys, never by chance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.plans.ranking import group_index, row_index, top_k_per_group


def seeded_order(key: str | Column, seed: str | int) -> Column:
    """A pseudo-random but repeatable sort key."""
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string") if isinstance(key, str) else key))


def head(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: str | int) -> DataFrame:
    return df.orderBy(seeded_order(key, seed), key).limit(n)


def stratified_sample(df: DataFrame, label: str, key: str, n: int, seed: str | int) -> DataFrame:
    """Up to n rows of every label; rows without a label drop out."""
    labelled = df.filter(F.col(label).isNotNull())
    return top_k_per_group(labelled, [label], [seeded_order(key, seed), F.col(key)], n).drop("rank")


def quota_per_group(df: DataFrame, seen: DataFrame, key: str, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """At most n rows per group that the ledger `seen` does not hold, first in the given order."""
    return top_k_per_group(df.join(seen, key, "left_anti"), [group], order, n)


def stratified_split(df: DataFrame, label: str, key: str, test_share: float, seed: str | int) -> DataFrame:
    """Adds `is_test`: exactly round(share * size) rows of every label, chosen by seeded hash."""
    ranked = group_index(
        df.withColumn("_hash", seeded_order(key, seed)), [label], [F.col("_hash"), F.col(key)], "_rank", size="_size"
    )
    quota = F.round(F.lit(test_share) * F.col("_size"))
    return ranked.withColumn("is_test", F.col("_rank") < quota).drop("_hash", "_rank", "_size")


def batch_numbers(df: DataFrame, order: Sequence[Column], size: int = 100) -> DataFrame:
    """Adds `batch_no`, counting batches of `size` rows in key order."""
    return row_index(df, order, "_row").withColumn("batch_no", F.floor(F.col("_row") / size)).drop("_row")
