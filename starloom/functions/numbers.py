"""Fixed-point forms of fractional columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDINGS = ("half_up", "truncate")


def fixed_point(value: Column, scale: int, rounding: str = "half_up") -> Column:
    """``value`` as ``decimal(18, scale)``.

    The value becomes a decimal before its digits are cut, so that a binary
    fraction such as 0.29 is not cut to 0.28. A value that does not fit gives NULL,
    as in type conversion; it does not end the load.
    """
    target = f"decimal(18,{scale})"
    if rounding == "half_up":
        return value.try_cast(target)
    if rounding == "truncate":
        exact = value.try_cast("decimal(38,18)")
        digits = F.lit(scale)
        cut = F.when(exact >= 0, F.floor(exact, digits)).otherwise(F.ceil(exact, digits))
        return cut.try_cast(target)
    raise ValueError(f"rounding {rounding!r} is not one of {ROUNDINGS}")
