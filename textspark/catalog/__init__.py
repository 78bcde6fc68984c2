"""The registered queries: each operator on the corpus tables, with the SQL that must give the same rows."""

from textspark.catalog.registry import QUERIES, SQL, load_all

__all__ = ["QUERIES", "SQL", "load_all"]
