"""Array helpers built from higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it many times inside `body`.

    Repeating an expression inside a lambda would re-run it for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def positions(n: Column) -> Column:
    """1..n, or an empty array for n < 1 (a plain sequence(1, 0) would count down)."""
    return F.when(n >= 1, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(
        F.array().cast("array<int>")
    )


def value_counts(items: Column) -> Column:
    """array<string> -> array<struct<term string, n bigint>>, counted inside the row.

    Sorting brings equal items together; each run's last index minus the previous one is its length.
    """

    def run_ends(s: Column) -> Column:
        ends = F.transform(
            s,
            lambda x, i: F.when(
                ~F.get(s, i + 1).eqNullSafe(x), F.struct(x.alias("term"), (i + 1).alias("end"))
            ),
        )
        return F.filter(ends, lambda e: e.isNotNull())

    def lengths(m: Column) -> Column:
        return F.transform(
            m,
            lambda e, j: F.struct(
                e["term"].alias("term"),
                (e["end"] - F.coalesce(F.get(m, j - 1)["end"], F.lit(0))).cast("long").alias("n"),
            ),
        )

    return bind(F.sort_array(items), lambda s: bind(run_ends(s), lengths))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def norm2(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two dense arrays; null when either has no length."""
    return F.try_divide(dot(a, b), norm2(a) * norm2(b))


def unit(a: Column) -> Column:
    """The array scaled to length 1; a zero array stays as it is."""
    return bind(
        norm2(a),
        lambda length: F.transform(
            a, lambda x: F.when(length == 0, x.cast("double")).otherwise(F.try_divide(x.cast("double"), length))
        ),
    )
