from starloom.functions.keys import dense_key, hash_key, monotonic_key
from starloom.functions.numbers import fixed_point
from starloom.functions.timeparts import WEEKDAY_STYLES, epoch_ms, start_time, time_parts, weekday

__all__ = [
    "WEEKDAY_STYLES",
    "dense_key",
    "epoch_ms",
    "fixed_point",
    "hash_key",
    "monotonic_key",
    "start_time",
    "time_parts",
    "weekday",
]
