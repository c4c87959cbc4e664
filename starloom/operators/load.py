"""Writing tables: overwrite, append, truncate-and-load, partitioned layouts, quoted CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.keys import monotonic_key
from starloom.operators.quality import Watch


# Rows that compress well fill small files; reading them back is work per row.
ROWS_PER_FILE = 1_000_000


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    only_touched_partitions: bool = False,
    number: str | None = None,
    watch: Watch | None = None,
) -> None:
    """Write Parquet files of a sensible size.

    For a partitioned table, rows are first brought together by partition value,
    so each directory gets few files; adaptive execution splits a value that holds
    too much for one task and joins small ones. With ``only_touched_partitions``
    an overwrite replaces just the partitions that ``df`` has rows for.

    ``number`` adds a unique number under that name. Each task numbers the rows
    it writes, so a task that runs again cannot give a number twice.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
    if number:
        df = df.select(monotonic_key().alias(number), "*")
    if watch:
        df = watch.on(df)
    writer = df.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_touched_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def append_fact(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a fact table; loading the same rows twice stores them twice."""
    write_table(df, path, "append", partition_by)


def load_dim(df: DataFrame, path: str, truncate: bool, partition_by: Sequence[str] = ()) -> None:
    """Load a dimension, emptying it first or adding to what it has.

    ``df`` must not read from ``path`` when ``truncate`` is set.
    """
    write_table(df, path, "overwrite" if truncate else "append", partition_by)


def write_quoted_csv(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none"
) -> None:
    """CSV with a header per file, every field quoted, a quote written twice.

    A NULL and an empty text both read back as NULL. A compressed file is read by
    one task, so no file gets more than ``ROWS_PER_FILE`` rows.
    """
    (
        df.write.mode(mode)
        .option("compression", compression)
        .option("maxRecordsPerFile", 0 if compression == "none" else ROWS_PER_FILE)
        .option("header", "true")
        .option("quoteAll", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
