"""Operators for preparing training text, each usable on any table of texts.

Nothing else in the library imports this package; it may be deleted whole.
"""

from starloom.llm.queries import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
