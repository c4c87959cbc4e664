"""File scans with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

CORRUPT = "corrupt_record"


def scan_json(
    spark: SparkSession,
    root: str,
    schema: StructType,
    glob: str | None = "*.json",
    corrupt_column: str | None = CORRUPT,
) -> DataFrame:
    """JSON lines anywhere below ``root``.

    A line that is not JSON, or holds a value of another kind, keeps its text in
    ``corrupt_column``. Use :func:`starloom.sources.stage` to set such lines
    aside; whether a field is parsed at all depends on the columns a query
    needs, so a filter on the corrupt column belongs right behind the full scan.
    """
    if corrupt_column:
        schema = StructType([*schema.fields]).add(corrupt_column, StringType())
    reader = (
        spark.read.schema(schema).option("mode", "PERMISSIVE").option("recursiveFileLookup", "true")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.json(root)


def scan_csv(
    spark: SparkSession,
    root: str,
    schema: StructType,
    glob: str | None = "*.csv",
    quoted_newlines: bool = True,
    corrupt_column: str | None = None,
    delimiter: str = ",",
    header: bool = True,
) -> DataFrame:
    """CSV files below ``root``, each with its own header; ``""`` in quotes is one quote.

    Fields are taken by position. A header must name the columns of ``schema`` in
    their order, so files of another layout end the job instead of being misread.
    A quoted field may contain line breaks, which makes a file one unit of work.
    For large files known to have none, ``quoted_newlines=False`` lets Spark
    split them.
    """
    if corrupt_column:
        schema = StructType([*schema.fields]).add(corrupt_column, StringType())
    reader = (
        spark.read.schema(schema)
        .option("header", str(header).lower())
        .option("enforceSchema", str(not header).lower())
        .option("delimiter", delimiter)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", str(quoted_newlines).lower())
        .option("recursiveFileLookup", "true")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(root)


def scan_parquet(
    spark: SparkSession, root: str, schema: StructType | None = None, base_path: str | None = None
) -> DataFrame:
    """A Parquet table; directory levels such as ``year=2018`` come back as columns.

    With ``schema`` the partition columns get declared types instead of guessed
    ones. ``base_path`` keeps the partition columns when ``root`` names
    directories inside a table.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.parquet(root)


def require_files(df: DataFrame, source: str) -> DataFrame:
    """``df`` if it reads at least one file; a path or pattern that matches none is a mistake."""
    if not df.inputFiles():
        raise FileNotFoundError(f"no file below {source} matches")
    return df


def file_count(df: DataFrame) -> DataFrame:
    """One row: how many files ``df`` was read from, and how many rows they gave."""
    per_file = df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    return per_file.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    )


def preview(df: DataFrame, order: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in a fixed order."""
    return df.orderBy(*order).limit(rows)
