"""Registered queries: each operator over the given tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        if key in QUERIES:
            raise KeyError(f"{key} is registered twice")
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = sql
        return query

    return add


def load_all() -> None:
    from ladderlake.registry import (  # noqa: F401
        aggregate_queries,
        column_queries,
        filter_queries,
        function_queries,
        job_queries,
        join_queries,
        quality_queries,
        sink_queries,
        source_queries,
    )
