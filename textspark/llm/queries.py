"""The registered queries of this package: one `opN_<name>` per operator, and the pipeline."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_MODULES = ("dedup_queries", "text_queries", "search_queries", "corpus_queries")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load_all() -> None:
    """Imports every module that registers queries, the pipeline at the repository's top last."""
    for module in _MODULES:
        importlib.import_module(f"textspark.llm.{module}")
    importlib.import_module("corpus_pipeline")
