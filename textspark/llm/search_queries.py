"""Queries over vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textspark.llm.graph_search import nearest
from textspark.llm.queries import query
from textspark.sources.tables import read_table


@query("op2_nearest_neighbours")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 100 = 0"))
