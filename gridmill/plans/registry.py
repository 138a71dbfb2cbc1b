"""The registered queries, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmill.plans.fixtures import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"Query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = with_views(sql)
        return function

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from gridmill.plans import (  # noqa: F401
        documents,
        masks,
        numbers,
        places,
        scans,
        stored,
        tiles,
    )
