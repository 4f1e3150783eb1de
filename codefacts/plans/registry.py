"""Registry of contract queries: ``name -> (spark, sf_dir) -> DataFrame`` and,
where the result is expressible in SQL, an independent DuckDB statement over
the same parquet tables. Each query returns flat scalar columns named exactly
as in its SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
IDS: dict[str, str] = {}


def register(name: str, ids: str, sql: str | None = None):
    """Register a contract query covering the SURVEY ids in ``ids``."""
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        IDS[name] = ids
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from codefacts.plans import (audit_checks, client_checks, go_checks, graph_checks,  # noqa: F401
                                 link_checks, nest_checks, observed_checks, record_checks, trace_checks)
