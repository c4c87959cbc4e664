"""Session defaults for running the library on its own (notebooks, tests, benchmarks)."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "starloom", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(shuffled_bytes: int, bytes_per_task: int = 128 * 1024 * 1024) -> int:
    """How many partitions the largest shuffle of a job needs.

    Set it as ``spark.sql.shuffle.partitions``, or as the initial number for
    adaptive execution, which joins partitions that turn out small but does not
    split evenly large ones.
    """
    return max(1, -(-shuffled_bytes // bytes_per_task))
