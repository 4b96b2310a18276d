"""Query registry: every surveyed operator under its query name, each a
callable ``(spark, sf_dir) -> DataFrame``, with its DuckDB oracle SQL when
one can be written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the query modules (each registers on import)."""
    from hazeline.plans import (q_aggregates, q_clean, q_groups, q_joins, q_ml,  # noqa: F401
                                q_projections, q_scans, q_stats, q_streams, q_windows)
