"""Catalog tables: create, drop, recreate and load by name."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from starloom.schemas import WAREHOUSE, Table


def _name(table: Table, database: str | None) -> str:
    return f"`{database}`.`{table.name}`" if database else f"`{table.name}`"


def create_all(
    spark: SparkSession,
    tables: Iterable[Table] = WAREHOUSE,
    database: str | None = None,
    location: str | None = None,
) -> None:
    """Create the tables that do not exist, in the given order.

    With ``location`` each table lives in a directory of its own below it.
    """
    for table in tables:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
        place = f" LOCATION '{location}/{table.name}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_name(table, database)} ({fields}) USING parquet{place}"
        )


def drop_all(
    spark: SparkSession, tables: Iterable[Table] = WAREHOUSE, database: str | None = None
) -> None:
    """Drop the tables that exist, dependants first.

    Files of a table with its own location stay where they are.
    """
    for table in reversed(list(tables)):
        spark.sql(f"DROP TABLE IF EXISTS {_name(table, database)}")


def recreate_all(
    spark: SparkSession,
    tables: Iterable[Table] = WAREHOUSE,
    database: str | None = None,
    location: str | None = None,
) -> None:
    """Start over with empty definitions."""
    tables = list(tables)
    drop_all(spark, tables, database)
    create_all(spark, tables, database, location)


def insert_by_name(
    df: DataFrame, table: str, truncate: bool = False, drop: Sequence[str] = ()
) -> None:
    """Insert rows into a catalog table; columns are paired by name, not position.

    A column that the table does not have raises, unless it is named in ``drop``.
    """
    target = df.sparkSession.table(table).columns
    extra = sorted(set(df.columns) - set(target) - set(drop))
    if extra:
        raise ValueError(f"{table} has no column {', '.join(extra)}")
    df.select(*target).write.insertInto(table, overwrite=truncate)
