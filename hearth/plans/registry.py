"""Registry of named query plans: each entry is a Spark builder
``(spark, sf_dir) -> DataFrame`` and, where SQL can express it, the
equivalent DuckDB statement used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query plan under ``name`` with its optional SQL oracle."""
    def wrap(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql.strip()
        return fn
    return wrap


def all_queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # importing the plan modules registers their queries
    from hearth.plans import (  # noqa: F401
        q_flagship, q_columns, q_profile, q_drift, q_errors, q_registry, q_score, q_contract, q_models, q_closed, q_explain, q_io)
