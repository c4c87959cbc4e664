"""A file order that serves filters on several columns.

A directory per value of two columns gives as many directories as there are pairs.
Here rows are sorted by a number whose bits come from the columns in turn, so that a
file holds a small range of each column and its statistics answer for it. Files have
the size that rows need, whatever the number of values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Bits of each column in the sort number: it is cut into so many ranges as these can count.
RANGE_BITS = 6

#: Values of each column by which the ranges are drawn; the driver holds so many.
SAMPLED = 20_000


def borders(df: DataFrame, name: str, bits: int = RANGE_BITS, seed: int = 7) -> list:
    """Values that cut a column into at most ``2 ** bits`` ranges of about equally many rows.

    They are drawn from a sample and only decide how well rows are spread, not where they can be found.
    """
    rows = df.select(name).filter(F.col(name).isNotNull())
    kept = rows.orderBy(F.xxhash64(F.lit(seed), F.col(name), F.monotonically_increasing_id())).limit(SAMPLED)
    values = sorted(row[0] for row in kept.collect())
    ranges = 1 << bits
    return sorted({values[len(values) * i // ranges] for i in range(1, ranges)}) if values else []


def _range_of(name: str, cuts: Sequence, kind) -> Column:
    """The number of the range that a value is in; NULL is in the first."""
    if not cuts:
        return F.lit(0)
    if isinstance(kind, NumericType):
        known = F.array(*[F.lit(cut).cast(kind) for cut in cuts])
    else:
        known = F.array(*[F.lit(cut) for cut in cuts])
    return F.coalesce(F.size(F.filter(known, lambda cut: cut <= F.col(name))), F.lit(0))


def interleaved(df: DataFrame, names: Sequence[str], bits: int = RANGE_BITS) -> Column:
    """The sort number: the bits of all columns' ranges in turn, the highest first."""
    numbers = [_range_of(name, borders(df, name, bits), df.schema[name].dataType) for name in names]
    number = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for each in numbers:
            number = F.shiftleft(number, 1).bitwiseOR(F.shiftright(each, bit).bitwiseAND(F.lit(1)).cast("long"))
    return number


def by_several(df: DataFrame, names: Sequence[str], files: int | None = None, bits: int = RANGE_BITS) -> DataFrame:
    """``df`` in an order that keeps ranges of all the named columns together, ready to be written.

    Rows of one range of every column go by the columns' own values, so that a pair of
    values with very many rows may span several files. ``files`` asks for that many; without
    it adaptive execution chooses.
    """
    marked = df.withColumn("_order", interleaved(df, names, bits)).withColumn("_origin", F.spark_partition_id())
    order = ["_order", *names, "_origin"]
    ranged = marked.repartitionByRange(files, *order) if files else marked.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop("_order", "_origin")


def replace_groups(stored: DataFrame, incoming: DataFrame, names: Sequence[str]) -> DataFrame:
    """``incoming``, and the rows of ``stored`` whose values of ``names`` it does not bring."""
    mine = [F.col(f"stored.{name}").eqNullSafe(F.col(f"incoming.{name}")) for name in names]
    brought = incoming.select(*names).distinct().alias("incoming")
    kept = stored.alias("stored").join(brought, mine, "left_anti")
    return kept.select(*stored.columns).unionByName(incoming.select(*stored.columns))
