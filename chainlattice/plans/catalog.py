"""Registered queries and the SQL each is checked with. Modules add theirs on import."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with its SQL."""

    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return add


from . import queries_more, queries_registry, queries_sources, queries_store, queries_text  # noqa: E402, F401
