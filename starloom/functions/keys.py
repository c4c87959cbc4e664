"""Surrogate and natural keys for fact rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.storage import materialize

# ``monotonically_increasing_id`` documents this layout: partition above, row below.
ROW_BITS = 33
ROW_MASK = (1 << ROW_BITS) - 1


def monotonic_key() -> Column:
    """Unique, with gaps, and different on every run.

    The number depends on where a row is processed. Add it in the step that
    writes the rows (:func:`starloom.operators.load.write_table` does): with a
    shuffle behind it, a lost task that runs again may number rows differently.
    """
    return F.monotonically_increasing_id()


def hash_key(*parts: Column) -> Column:
    """MD5 hex of the parts' text put together; NULL when a part is NULL.

    Zone-less times read ``yyyy-MM-dd HH:mm:ss`` plus a fraction only if there
    is one. Two plays of one session in one second get the same key.
    """
    return F.md5(F.concat(*[part.cast("string") for part in parts]))


def in_number_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` sorted over all its partitions, ready to be numbered by the job that writes it.

    Rows that tie, however many, may fall into several partitions.
    """
    if not order:
        return df
    parted = df.withColumn("_origin", F.spark_partition_id())
    return parted.repartitionByRange(*order, "_origin").sortWithinPartitions(*order, "_origin").drop("_origin")


def range_of(mark: str) -> Column:
    """The partition that a row was written by, from its :func:`monotonic_key`."""
    return F.shiftright(mark, ROW_BITS)


def place_in_range(mark: str) -> Column:
    return F.col(mark).bitwiseAND(F.lit(ROW_MASK))


def range_starts(stored: DataFrame, mark: str, start: int = 1) -> DataFrame:
    """For each range of stored rows its first number, if all are numbered from ``start`` on, and its rows.

    One row per partition that wrote: ``_range``, ``_first``, ``_rows``.
    """
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy(range_of(mark).alias("_range")).agg(F.count(F.lit(1)).alias("_rows"))
    first = F.coalesce(F.sum("_rows").over(before), F.lit(0)) + F.lit(start)
    return counts.select("_range", first.alias("_first"), "_rows")


def dense_key(
    df: DataFrame, order: Sequence[str] = (), name: str = "songplay_id", start: int = 1
) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, ... in the given order, if any.

    Rows are range-partitioned on ``order`` and stored with their partition and
    position. The counts per partition then turn positions into numbers, so no
    task sees more than one range. The starts have one row per partition of the
    stored table, which bounds the side that is broadcast. Without an order rows
    are stored as they come, and nothing is shuffled. A table that is written anyway
    can keep the marks and be numbered when it is read: see ``publish.write_numbered``.
    """
    columns = df.columns
    marked = in_number_order(df, order).withColumn("_mark", monotonic_key())
    stored = materialize(marked, "dense-key")
    starts = range_starts(stored, "_mark", start)
    return stored.withColumn("_range", range_of("_mark")).join(F.broadcast(starts), "_range").select(
        (place_in_range("_mark") + F.col("_first")).alias(name), *columns
    )
