"""Data quality checks.

Each check gives a report of one row per thing checked: ``table_name``,
``check_name``, ``detail``, ``failing_rows``, ``passed``. Reports are lazy and
can be put together with :func:`report`; :func:`require` raises on failures.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starloom.schemas import ForeignKey, Table


class QualityError(ValueError):
    """Some check did not pass."""


class Watch:
    """Rows, NULLs and overlong texts of a table, counted by the job that writes it.

    The counts are taken where the rows go to their files, in the last stage, so a task
    that runs again does not count twice. ``table`` names what must not be NULL or too
    long; columns that the rows do not have are passed over.
    """

    def __init__(self, table: Table):
        self.table = table
        self._seen = Observation(f"{table.name}-{uuid.uuid4().hex}")
        self._checks: list[tuple[str, str]] = []

    def on(self, df: DataFrame) -> DataFrame:
        """``df`` with its rows counted as they pass; to be written once."""
        required = [name for name in self.table.required if name in df.columns]
        longest = {name: n for name, n in (self.table.longest or {}).items() if name in df.columns}
        self._checks = [("not_null", name) for name in required] + [("length", name) for name in longest]
        failing = [F.col(name).isNull() for name in required]
        failing += [F.coalesce(F.char_length(name) > n, F.lit(False)) for name, n in longest.items()]
        counts = [F.count_if(each).alias(f"_{i}") for i, each in enumerate(failing)]
        return df.observe(self._seen, F.count(F.lit(1)).alias("_rows"), *counts)

    @property
    def rows(self) -> int:
        """Rows written; waits for the job."""
        return self._seen.get["_rows"]

    def failures(self) -> list[str]:
        """What did not hold, in the words of :func:`require`; waits for the job."""
        seen = self._seen.get
        return [
            f"{self.table.name}: {check} {name} ({seen[f'_{i}']})"
            for i, (check, name) in enumerate(self._checks)
            if seen[f"_{i}"]
        ]


def _row(table: str, check: str, detail: str, failing: Column, passed: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(detail).alias("detail"),
        failing.cast("long").alias("failing_rows"),
        passed.alias("passed"),
    ]


def report(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ],
    )


def check_not_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every table must have rows. One row is enough to know, so one is looked for."""
    empty = lambda df: df.select(F.lit(1)).limit(1).agg(F.count(F.lit(1)).alias("_found"))
    return report(
        [
            empty(df).select(
                *_row(name, "not_empty", "", F.col("_found") == 0, F.col("_found") > 0)
            )
            for name, df in tables.items()
        ]
    )


def require_not_empty(tables: Mapping[str, DataFrame]) -> None:
    """Raise naming the tables without rows; each is read only up to its first row."""
    empty = sorted(name for name, df in tables.items() if df.isEmpty())
    if empty:
        raise QualityError(f"no rows in {', '.join(empty)}")


def check_not_null(name: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """No NULL in the given columns; all are counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "_column", "_nulls").select(
        F.lit(name).alias("table_name"),
        F.lit("not_null").alias("check_name"),
        F.col("_column").alias("detail"),
        F.col("_nulls").alias("failing_rows"),
        (F.col("_nulls") == 0).alias("passed"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter(F.col("row_count") > 1)


def check_unique(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """No key may occur twice; fails with the number of keys that do."""
    found = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("_keys"))
    detail = ", ".join(keys)
    return found.select(*_row(name, "unique_key", detail, F.col("_keys"), F.col("_keys") == 0))


def orphan_keys(
    fact: DataFrame, dim: DataFrame, column: str, references: str
) -> DataFrame:
    """Foreign key values without a dimension row, with their number of fact rows.

    Fact rows are counted per value before the join, so the join sees each value
    once however often it occurs. NULL refers to nothing and passes.
    """
    used = (
        fact.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = dim.select(F.col(references).alias(column))
    return used.join(known, column, "left_anti").select(column, "row_count")


def check_foreign_key(name: str, fact: DataFrame, dim: DataFrame, key: ForeignKey) -> DataFrame:
    orphans = orphan_keys(fact, dim, key.column, key.references).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("_rows")
    )
    detail = f"{key.column} -> {key.table}.{key.references}"
    return orphans.select(*_row(name, "foreign_key", detail, F.col("_rows"), F.col("_rows") == 0))


def check_lengths(name: str, df: DataFrame, longest: Mapping[str, int]) -> DataFrame:
    """No text longer than its declared length; Spark's strings have none of their own."""
    counts = df.agg(*[F.count_if(F.char_length(c) > n).alias(c) for c, n in longest.items()])
    return counts.unpivot([], list(longest), "_column", "_long").select(
        F.lit(name).alias("table_name"),
        F.lit("length").alias("check_name"),
        F.col("_column").alias("detail"),
        F.col("_long").alias("failing_rows"),
        (F.col("_long") == 0).alias("passed"),
    )


def fan_out(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after a join, and their ratio."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("_rows")).select(F.lit(side).alias("_side"), "_rows")
        for side, df in (("before", before), ("after", after))
    ]
    rows = lambda side: F.sum(F.when(F.col("_side") == side, F.col("_rows")))
    both = counts[0].unionByName(counts[1]).agg(
        rows("before").alias("rows_before"), rows("after").alias("rows_after")
    )
    ratio = F.try_divide(F.col("rows_after").cast("double"), F.col("rows_before").cast("double"))
    return both.withColumn("ratio", ratio)


def check_rows(table: Table, df: DataFrame) -> list[DataFrame]:
    """The checks that look at one row at a time."""
    parts = []
    if table.required:
        parts.append(check_not_null(table.name, df, table.required))
    if table.longest:
        parts.append(check_lengths(table.name, df, table.longest))
    return parts


def check_table(table: Table, frames: Mapping[str, DataFrame], rows: bool = True) -> DataFrame | None:
    """All checks the registry declares for one table; without ``rows`` only keys. None if there are none."""
    df = frames[table.name]
    parts = check_rows(table, df) if rows else []
    if table.primary_key:
        parts.append(check_unique(table.name, df, table.primary_key))
    for key in table.foreign_keys:
        if key.table in frames:
            parts.append(check_foreign_key(table.name, df, frames[key.table], key))
    return report(parts) if parts else None


def require(checks: DataFrame, known: Sequence[str] = ()) -> DataFrame:
    """Run the checks; raise naming every table and column that failed, ``known`` failures along with them.

    A report has one row per check, so its failures are safe to bring here.
    """
    failed = checks.filter(~F.col("passed")).collect()
    if failed or known:
        lines = [f"{r.table_name}: {r.check_name} {r.detail} ({r.failing_rows})" for r in failed] + list(known)
        raise QualityError("data quality checks failed\n" + "\n".join(sorted(lines)))
    return checks
