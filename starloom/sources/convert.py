"""Type conversion on load: a value that does not fit its column becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, StructType


def convert(value: Column, source: DataType, target: DataType) -> Column:
    """``value`` as ``target``, NULL where that is impossible (an empty user id, say).

    Text for a whole-number column may carry a fraction (``1540919166796.0``) or
    an exponent; the fraction is cut off.
    """
    if source == target:
        return value
    if isinstance(source, StringType) and isinstance(target, IntegralType):
        return F.coalesce(value.try_cast(target), value.try_cast("decimal(38,10)").try_cast(target))
    return value.try_cast(target)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the columns of ``schema`` by name, in its order and with its types."""
    source = {field.name: field.dataType for field in df.schema}
    return df.select(
        *[convert(F.col(f.name), source[f.name], f.dataType).alias(f.name) for f in schema]
    )
