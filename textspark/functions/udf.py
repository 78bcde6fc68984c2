"""The surface for caller-supplied Python: Arrow batches, as parallel as the frame has partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


#: Values whose results are held at once; an Arrow batch has many more.
SLICE_ROWS = 128


def sliced(fn: Callable) -> Callable[[Iterator[pd.Series]], Iterator[pd.Series]]:
    """`fn` over batches of values, each answered in slices, so that only a slice's results are in memory."""

    def run(batches):
        for values in batches:
            for low in range(0, max(len(values), 1), SLICE_ROWS):
                yield values.iloc[low : low + SLICE_ROWS].map(fn, na_action="ignore")

    return run


def python_column(fn: Callable, return_type: str | DataType) -> Callable[[Column], Column]:
    """A value -> value Python function as a Column -> Column function; null stays null."""
    batch = sliced(fn)
    batch.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(batch, return_type)


def map_column(
    df: DataFrame, column: str, fn: Callable, return_type: str | DataType, output: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Parallel map of a Python function over one column."""
    rows = df if partitions is None else df.repartition(partitions)
    return rows.withColumn(output or column, python_column(fn, return_type)(F.col(column)))
