"""Event times and calendar columns.

Times are zone-less (``timestamp_ntz``), so results do not depend on the
session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"

# English weekday names, Sunday first, as ``dayofweek`` counts.
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
LONGEST_NAME = 9

WEEKDAY_STYLES = ("name", "padded", "sunday1", "sunday0")


def start_time(ts: str, whole_seconds: bool = False) -> Column:
    """Epoch milliseconds to a time, keeping or cutting off the milliseconds."""
    if whole_seconds:
        return F.expr(f"timestampadd(SECOND, {ts} div 1000, {EPOCH})")
    return F.expr(f"timestampadd(MILLISECOND, {ts}, {EPOCH})")


def epoch_ms(moment: str) -> Column:
    """Zone-less time to whole epoch milliseconds, fraction cut off.

    Taken apart by date and clock, because differences of times are computed in
    the session's zone.
    """
    return F.expr(
        f"unix_date(CAST({moment} AS DATE)) * 86400000L + hour({moment}) * 3600000L"
        f" + minute({moment}) * 60000L + CAST(extract(SECOND FROM {moment}) * 1000 AS BIGINT)"
    )


def weekday(moment: Column, style: str = "name") -> Column:
    """Day of week as ``name`` (Thursday), ``padded`` to nine characters,
    ``sunday1`` (1 to 7) or ``sunday0`` (0 to 6)."""
    number = F.dayofweek(moment)
    if style == "sunday1":
        return number
    if style == "sunday0":
        return number - 1
    name = F.element_at(F.array(*map(F.lit, WEEKDAY_NAMES)), number)
    if style == "name":
        return name
    if style == "padded":
        return F.rpad(name, LONGEST_NAME, " ")
    raise ValueError(f"weekday style {style!r} is not one of {WEEKDAY_STYLES}")


def time_parts(moment: Column, weekday_style: str = "name", month_as_text: bool = False) -> dict[str, Column]:
    """The calendar columns of the time dimension, in table order."""
    month = F.month(moment)
    return {
        "hour": F.hour(moment),
        "day": F.dayofmonth(moment),
        "week": F.weekofyear(moment),
        "month": month.cast("string") if month_as_text else month,
        "year": F.year(moment),
        "weekday": weekday(moment, weekday_style),
    }
