"""Registry of the named queries and their DuckDB twins.

Each query is a function ``(spark, sf_dir) -> DataFrame`` over the given
tables.  ``oracle`` holds the same result as plain SQL (tables registered as
views under their own names); queries that SQL cannot state (model fits,
file round trips) register without one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.numeric import sql_round_rewrite

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` (and its SQL twin, if any)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql_round_rewrite(sql)
        return fn
    return deco
