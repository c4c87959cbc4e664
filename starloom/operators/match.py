"""Matching events to the song catalogue."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.numbers import fixed_point
from starloom.operators.rows import with_keys
from starloom.operators.skew import join_spreading_hot_keys


@dataclass(frozen=True)
class MatchKey:
    """An event column that must equal a catalogue column.

    With ``scale`` both sides are compared as decimals of that many places,
    rounded or truncated; binary fractions should never be compared as they are.
    """

    event: str
    song: str
    scale: int | None = None
    rounding: str = "half_up"

    def of_event(self) -> Column:
        return self._comparable(F.col(self.event))

    def of_song(self) -> Column:
        return self._comparable(F.col(self.song))

    def _comparable(self, value: Column) -> Column:
        return value if self.scale is None else fixed_point(value, self.scale, self.rounding)


TITLE = MatchKey("song", "title")
ARTIST = MatchKey("artist", "artist_name")
LENGTH = MatchKey("length", "duration", scale=5)
WHOLE_LENGTH = MatchKey("length", "duration", scale=0, rounding="truncate")
ROUNDED_LENGTH = MatchKey("length", "duration", scale=0, rounding="half_up")


def match(
    events: DataFrame,
    catalogue: DataFrame,
    keys: Sequence[MatchKey],
    how: str = "inner",
    duplicates: str = "all",
    add: Sequence[str] = ("song_id", "artist_id"),
    hot_share: float | None = None,
    spread: int = 64,
) -> DataFrame:
    """Add the catalogue columns ``add`` to each event.

    ``how`` is ``inner`` or ``left`` (unmatched events get NULLs). An event with
    several matches is repeated for each (``duplicates="all"``) or gets the one
    smallest in ``add`` (``"first"``), which the reduced catalogue decides before
    the join.

    Which side is broadcast, if any, is left to Spark, which knows the sizes.
    Adaptive execution splits keys with much input at run time; ``hot_share`` splits
    keys with much output in the plan (see :mod:`starloom.operators.skew`).
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    if duplicates not in ("all", "first"):
        raise ValueError("duplicates is 'all' or 'first'")
    taken = set(add) & set(events.columns)
    if taken:
        raise ValueError(f"events already have {sorted(taken)}")

    names = _key_names(keys)
    left = events.withColumns({name: key.of_event() for name, key in zip(names, keys)})
    right = _song_side(catalogue, keys, add)
    if duplicates == "first":
        right = right.groupBy(*names).agg(F.min(F.struct(*add)).alias("_pick")).select(*names, "_pick.*")
    return _joined(left, right, names, how, hot_share, spread).select(*events.columns, *add)


def distinct_matches(
    events: DataFrame,
    catalogue: DataFrame,
    keys: Sequence[MatchKey],
    columns: Sequence[str],
    add: Sequence[str] = ("song_id", "artist_id"),
    hot_share: float | None = None,
    spread: int = 64,
) -> DataFrame:
    """The distinct rows of ``columns`` and ``add`` that an inner :func:`match` gives.

    Duplicates are removed on both sides, before the join repeats events for each
    of their songs. A joined row can then only appear twice if the catalogue has
    the same ``add`` values under several keys. That is looked up in the
    catalogue; only if it is so must the joined rows be shuffled once more.
    """
    names = _key_names(keys)
    left = events.select(*columns, *[key.of_event().alias(n) for n, key in zip(names, keys)]).distinct()
    right = _song_side(catalogue, keys, add).distinct()
    joined = _joined(left, right, names, "inner", hot_share, spread).select(*columns, *add)
    several = right.groupBy(*add).agg(F.count(F.lit(1)).alias("_keys")).filter(F.col("_keys") > 1)
    return joined if several.isEmpty() else joined.distinct()


def _key_names(keys: Sequence[MatchKey]) -> list[str]:
    return [f"_key{i}" for i in range(len(keys))]


def _song_side(catalogue: DataFrame, keys: Sequence[MatchKey], add: Sequence[str]) -> DataFrame:
    names = _key_names(keys)
    side = catalogue.select(*[key.of_song().alias(name) for name, key in zip(names, keys)], *add)
    return with_keys(side, *names)


def _joined(
    left: DataFrame, right: DataFrame, names: list[str], how: str, hot_share: float | None, spread: int
) -> DataFrame:
    if hot_share is None:
        return left.join(right, names, how)
    return join_spreading_hot_keys(left, right, names, how, hot_share, spread)


def join_catalogue(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Songs with the name of their artist, as events mention it."""
    named = artists.select("artist_id", F.col("name").alias("artist_name"))
    return songs.join(named, "artist_id").select(*songs.columns, "artist_name")


def join_time(plays: DataFrame, time: DataFrame, add: Sequence[str] = ("year", "month")) -> DataFrame:
    """Plays with calendar columns of the time dimension."""
    return plays.join(time.select("start_time", *add), "start_time").select(*plays.columns, *add)
