"""Every query by name, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(function: Query) -> Query:
        _queries[function.__name__] = function
        if sql is not None:
            _sql[function.__name__] = sql
        return function

    return register


def _load() -> None:
    from starloom.workloads import (  # noqa: F401
        dimensions,
        facts,
        files,
        loads,
        lookups,
        quality,
        times,
    )


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
