"""Queries over the TPC-H-like test tables, each with SQL that must agree with it."""

from starloom.workloads.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
