"""Registered queries over the benchmark tables.

Each entry is ``name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL
or None)``. The SQL is an independent DuckDB formulation of the same
result; entries without SQL are checked on row counts only and are
covered by unit tests against brute force on small fixtures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from tessera.plans import (  # noqa: F401
        q_analytics, q_cdc, q_cost, q_incremental, q_layers, q_operations, q_quality, q_star, q_streaming,
    )
