"""The catalogue of queries and how one enters it."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; sql is its DuckDB twin, left out where SQL cannot express it."""

    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add
