"""Query-first lookup tables: stored in key order, read by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.rows import with_keys
from starloom.operators.upsert import last_by_key


@dataclass(frozen=True)
class Lookup:
    """A lookup table's layout.

    ``keys`` find the rows, ``cluster`` orders them within a key; together they
    identify a row. ``columns`` maps table columns to staged ones.
    """

    name: str
    keys: tuple[str, ...]
    cluster: tuple[str, ...]
    columns: Mapping[str, str]

    @property
    def primary_key(self) -> list[str]:
        return [*self.keys, *self.cluster]


SESSION_ITEM = Lookup(
    "artist_song_lookup",
    keys=("session_id",),
    cluster=("item_in_session",),
    columns={
        "session_id": "sessionId",
        "item_in_session": "itemInSession",
        "artist_name": "artist",
        "song_title": "song",
        "song_length": "length",
    },
)

USER_SESSION = Lookup(
    "user_activity",
    keys=("session_id", "user_id"),
    cluster=("item_in_session",),
    columns={
        "session_id": "sessionId",
        "user_id": "userId",
        "item_in_session": "itemInSession",
        "artist_name": "artist",
        "song_title": "song",
        "first_name": "firstName",
        "last_name": "lastName",
    },
)

# The last name comes from the last-name field; a load that numbers the staged
# fields by hand can easily take the position in the session instead.
SONG_USERS = Lookup(
    "user_songs",
    keys=("song_title",),
    cluster=("user_id",),
    columns={
        "song_title": "song",
        "user_id": "userId",
        "first_name": "firstName",
        "last_name": "lastName",
    },
)

LOOKUP_TABLES = (SESSION_ITEM, USER_SESSION, SONG_USERS)


def build_lookup(staged: DataFrame, lookup: Lookup, order: Sequence[str] = ()) -> DataFrame:
    """One row per primary key; of several, the last in ``order`` stays."""
    extra = [name for name in order if name not in lookup.columns]
    rows = staged.select(
        *[F.col(source).alias(name) for name, source in lookup.columns.items()], *extra
    )
    rows = with_keys(rows, *lookup.primary_key)
    return last_by_key(rows, lookup.primary_key, order).select(*lookup.columns)


def store_lookup(staged: DataFrame, path: str, lookup: Lookup, order: Sequence[str] = ()) -> None:
    """:func:`build_lookup` and :func:`write_lookup` with one shuffle: staged rows go to their key's range.

    Rows of one primary key meet in one task, which sorts them on disk if they are many.
    """
    names = dict.fromkeys([*lookup.columns.values(), *[name for name in order if name not in lookup.columns]])
    rows = with_keys(staged.select(*names), *[lookup.columns[name] for name in lookup.primary_key])
    ranged = rows.repartitionByRange(*[lookup.columns[name] for name in lookup.primary_key])
    _write(build_lookup(ranged, lookup, order), path, lookup, "overwrite")


def write_lookup(
    df: DataFrame, path: str, lookup: Lookup, files: int | None = None, mode: str = "overwrite"
) -> None:
    """Store in key order, so that file statistics lead a read to few row groups.

    Ranges are drawn over key and clustering columns, so a key with very many
    rows spans several files instead of one task. The order serves the first column;
    for the others each row group has a Bloom filter (or a dictionary, where values
    are few), so that a read by any of them opens only row groups that may hold it.
    """
    columns = lookup.primary_key
    ranged = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    _write(ranged, path, lookup, mode)


def _write(ranged: DataFrame, path: str, lookup: Lookup, mode: str) -> None:
    columns = lookup.primary_key
    writer = ranged.sortWithinPartitions(*columns).write.mode(mode)
    # As large as a row group's distinct values need, chosen while it is written.
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for name in columns[1:]:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(path)


def read_lookup(
    table: DataFrame, lookup: Lookup, values: Mapping[str, Any], columns: Sequence[str] = ()
) -> DataFrame:
    """Rows for the given key (and, if given, clustering) values, in clustering order."""
    missing = set(lookup.keys) - set(values)
    unknown = set(values) - set(lookup.primary_key)
    if missing or unknown:
        raise ValueError(f"{lookup.name}: missing {sorted(missing)}, unknown {sorted(unknown)}")
    for name, value in values.items():
        table = table.filter(F.col(name) == F.lit(value))
    ordered = table.orderBy(*lookup.cluster)
    return ordered.select(*columns) if columns else ordered
