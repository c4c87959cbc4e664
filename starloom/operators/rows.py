"""Row filters and duplicate removal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the page name that marks a play.
PLAY_PAGE = "NextSong"


def plays_only(events: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    """Events that are plays."""
    return events.filter(F.col("page") == page)


def with_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose business keys are all present."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def non_empty(df: DataFrame, *names: str) -> DataFrame:
    """Rows where each text column is present and not empty."""
    for name in names:
        df = df.filter(F.col(name).isNotNull() & (F.col(name) != ""))
    return df


def distinct_projection(
    df: DataFrame, columns: Mapping[str, str], required: Sequence[str] = ()
) -> DataFrame:
    """Distinct rows over ``{new name: source column}``; ``required`` new names are not NULL.

    The projection comes before the duplicate removal, so only its columns are
    read and shuffled.
    """
    picked = df.select(*[F.col(source).alias(name) for name, source in columns.items()])
    if required:
        picked = with_keys(picked, *required)
    return picked.distinct()


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row duplicate removal."""
    return df.dropDuplicates()


def row_hash(columns: Sequence[str]) -> list[Column]:
    """128 bits that stand for the values of a row, as two columns ``_row0`` and ``_row1``.

    Hash functions pass over NULLs, so which columns are NULL is hashed along.
    """
    values = [F.col(name) for name in columns] + [F.col(name).isNull() for name in columns]
    return [F.xxhash64(F.lit(seed), *values).alias(f"_row{seed}") for seed in (0, 1)]


ROW_HASH = ("_row0", "_row1")
