"""Two-dimensional maps of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def text_map(projected: DataFrame, documents: DataFrame, key: str, label: str, text: str) -> DataFrame:
    """(key, x, y, label, text): the first two components as coordinates."""
    return projected.select(
        key, F.get("vector", F.lit(0)).alias("x"), F.get("vector", F.lit(1)).alias("y")
    ).join(documents.select(key, F.col(label).alias("label"), F.col(text).alias("text")), key)
