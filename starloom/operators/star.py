"""Reading a star: a fact table with its dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DecimalType, StringType

# Far below the 8 GB Spark allows, and small next to an executor's memory.
REPLICATE_LIMIT = 64 * 1024 * 1024


@dataclass(frozen=True)
class Dimension:
    """A dimension and how the fact refers to it: ``{fact column: dimension column}``.

    Its other columns appear as ``prefix`` + name. ``replicate`` asks for a copy
    on every executor if the table proves small enough.
    """

    df: DataFrame
    on: Mapping[str, str]
    prefix: str = ""
    replicate: bool = False


def _width(field) -> Column:
    """Upper bound of a value's size in a row."""
    if isinstance(field.dataType, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(16)
    return F.lit(24 if isinstance(field.dataType, DecimalType) else 8)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of a flat table, measured in one distributed pass."""
    widths = [_width(field) for field in df.schema]
    row = sum(widths[1:], widths[0]) + F.lit(16)
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0]


def replicate(df: DataFrame, limit: int = REPLICATE_LIMIT) -> DataFrame:
    """Ask Spark to copy ``df`` to every executor, if it measures at most ``limit`` bytes.

    A larger table is returned as it is and joined by shuffling.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def star_join(fact: DataFrame, dimensions: Sequence[Dimension], limit: int = REPLICATE_LIMIT) -> DataFrame:
    """Inner join of the fact with each dimension, in the given order.

    Dimensions that do not ask to be replicated are joined as Spark sees fit: it
    broadcasts by file size or by the size it meets at run time.
    """
    joined = fact
    for dim in dimensions:
        keys = {target: source for source, target in dim.on.items()}
        side = dim.df.select(
            *[
                F.col(name).alias(f"_{name}" if name in keys else f"{dim.prefix}{name}")
                for name in dim.df.columns
            ]
        )
        if dim.replicate:
            side = replicate(side, limit)
        condition = [joined[source] == side[f"_{target}"] for source, target in dim.on.items()]
        joined = joined.join(side, condition, "inner").drop(*[f"_{name}" for name in keys])
    return joined
