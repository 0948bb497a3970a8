"""Where queries and their SQL counterparts are listed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFunction] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query; ``sql`` gives the same rows on the same tables."""

    def register(function: QueryFunction) -> QueryFunction:
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
