"""Joins on natural-language keys, where a few terms own most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from textspark.plans.union import union_rows

MAX_HEAVY = 2000
MAX_BROADCAST_BYTES = 128 << 20


def heavy_keys(counts: DataFrame, keys: Sequence[str], weight: str, max_keys: int = MAX_HEAVY) -> DataFrame:
    """Keys owning at least 1/max_keys of the total weight; there can be no more than max_keys of them."""
    total = counts.agg(F.sum(weight)).scalar()
    return counts.filter(F.col(weight) * F.lit(max_keys) >= total).select(*keys)


def fits_broadcast(lookup: DataFrame, row_bytes: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a materialised lookup table is small enough to copy to every executor: its rows are counted."""
    return lookup.count() * row_bytes <= max_bytes


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    heavy: DataFrame,
    how: str = "inner",
    row_bytes: int = 64,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Inner or left join to a materialised lookup table that is unique on `keys`.

    A lookup whose counted size fits is broadcast: one pass over `left`, no shuffle. Beyond that the rows of
    the heavy keys meet a broadcast slice of the lookup (bounded by `heavy_keys`), so they neither move nor
    pile up in one task, and the long tail is joined by shuffle.
    """
    keys = list(keys)
    if fits_broadcast(right, row_bytes, max_bytes):
        columns = [*left.columns, *(c for c in right.columns if c not in keys)]
        return left.join(F.broadcast(right), keys, how).select(*columns)
    return split_join(left, right, keys, heavy, how)


def split_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], heavy: DataFrame, how: str = "inner"
) -> DataFrame:
    """The heavy/tail half of `lookup_join`. Reads `left` twice rather than shuffling its heavy rows."""
    keys = list(keys)
    heavy = heavy.select(*keys)
    hot = heavy.join(right, keys, how)
    cold = right.join(F.broadcast(heavy), keys, "left_anti")
    columns = [*left.columns, *(c for c in right.columns if c not in keys)]
    near = left.join(F.broadcast(hot), keys).select(*columns)
    far = left.join(F.broadcast(heavy), keys, "left_anti").join(cold, keys, how).select(*columns)
    return union_rows(near, far)
