"""Registry of named queries over the bound tables, each with SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


def _load() -> None:
    from gleaner.plans import catalogue  # noqa: F401  fills the registry


def queries() -> dict[str, Query]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _SQL
