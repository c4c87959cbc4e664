"""Insert-if-absent and partial-column upsert by key.

Both reduce each key on the map side before anything is shuffled, so a key that
holds a large share of the rows sends one row per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.rows import with_keys

FIRST = "_first"
LAST = "_last"


def _ranked(order: Sequence[str], values: Sequence[str]) -> Column:
    """Values behind their sort key; rows that tie on ``order`` are told apart by values."""
    return F.struct(*[F.col(name) for name in dict.fromkeys([*order, *values])])


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``."""
    return _one_by_key(df, keys, order, F.min)


def last_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order``: a keyed overwrite."""
    return _one_by_key(df, keys, order, F.max)


def _one_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    values = [name for name in df.columns if name not in keys]
    chosen = df.groupBy(*keys).agg(pick(_ranked(order, values)).alias("_row"))
    return chosen.select(*[F.col(n) if n in keys else F.col(f"_row.{n}") for n in df.columns])


def upsert_state(
    df: DataFrame, keys: Sequence[str], keep: Sequence[str], update: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Per key: its first row's ``keep`` columns and its last row's ``update`` columns.

    Each sits behind its sort key, so states of several batches can be merged
    later with :func:`merge_states`, in any grouping.
    """
    return df.groupBy(*keys).agg(
        F.min(_ranked(order, keep)).alias(FIRST), F.max(_ranked(order, update)).alias(LAST)
    )


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fold several states per key into one."""
    return states.groupBy(*keys).agg(F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST))


def rows_of(
    states: DataFrame, keys: Sequence[str], keep: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """The plain rows of one state per key."""
    return states.select(
        *keys,
        *[F.col(f"{FIRST}.{name}") for name in keep],
        *[F.col(f"{LAST}.{name}") for name in update],
    )


def upsert_rows(
    df: DataFrame, keys: Sequence[str], keep: Sequence[str], update: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key: ``keep`` from the first row in ``order``, ``update`` from the last."""
    return rows_of(upsert_state(df, keys, keep, update, order), keys, keep, update)


def insert_absent(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], within: str | None = None
) -> DataFrame:
    """The rows of ``incoming`` (one per key) whose key ``existing`` does not have.

    Rows without a whole key are left out: NULL never equals what is there, so every
    load would add them again.

    ``within`` names a key column that loads fill in roughly ascending order, such
    as a time: only the part of ``existing`` between the smallest and the largest
    incoming value is then read and compared.
    """
    incoming = with_keys(incoming, *keys)
    if within:
        low, high = incoming.agg(F.min(within), F.max(within)).first()
        existing = existing.filter(F.col(within).between(low, high))
    return incoming.join(existing.select(*keys), list(keys), "left_anti").select(*incoming.columns)


def merge_upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """``existing`` after upserting ``incoming``; both have one row per key.

    Keys on both sides take their ``update`` columns from ``incoming`` and
    everything else from ``existing``.
    """
    old, new = existing.alias("old"), incoming.alias("new")
    same = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    known = F.col(f"old.{keys[0]}").isNotNull()
    arrived = F.col(f"new.{keys[0]}").isNotNull()

    def value(name: str) -> Column:
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in keys:
            return F.coalesce(before, after)
        if name in update:
            return F.when(arrived, after).otherwise(before)
        return F.when(known, before).otherwise(after)

    return old.join(new, same, "full_outer").select(*[value(n).alias(n) for n in existing.columns])
