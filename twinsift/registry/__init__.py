"""Registered queries: each pairs a Spark job over the provided tables with
(where SQL can say it) an equivalent DuckDB oracle text.

Every query reads whole tables from ``sf_dir`` (or data Spark derives from
them); none runs on made-up input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under ``name`` with its oracle SQL (None: rows only)."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return wrap


def _load_all() -> None:
    from twinsift.registry import (  # noqa: F401
        files,
        fuzzy,
        incremental,
        records,
        sketches,
        streams,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
