from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textspark.plans.union import UNION_PARTITIONING

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_MODULES = ("columns", "cleaning", "tokenizing", "phrasing", "sparse", "dense", "statistics", "ingest", "models", "wordvectors")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set(UNION_PARTITIONING, "false")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load_all() -> None:
    for module in _MODULES:
        importlib.import_module(f"textspark.catalog.{module}")
