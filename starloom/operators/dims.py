"""The four dimensions, each in the styles a load may ask for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.numbers import fixed_point
from starloom.functions.timeparts import start_time, time_parts
from starloom.operators.rows import distinct_projection, plays_only, with_keys
from starloom.operators.upsert import first_by_key, upsert_rows, upsert_state

USER_COLUMNS = {
    "user_id": "userId",
    "first_name": "firstName",
    "last_name": "lastName",
    "gender": "gender",
    "level": "level",
}
SONG_COLUMNS = {name: name for name in ("song_id", "title", "artist_id", "year", "duration")}
ARTIST_COLUMNS = {
    "artist_id": "artist_id",
    "name": "artist_name",
    "location": "artist_location",
    "latitude": "artist_latitude",
    "longitude": "artist_longitude",
}

USER_KEEP, USER_UPDATE = ("first_name", "last_name", "gender"), ("level",)
ARTIST_KEEP, ARTIST_UPDATE = ("name",), ("location", "latitude", "longitude")

# Event time alone is not unique; session and position settle ties.
EVENT_ORDER = ("ts", "sessionId", "itemInSession")


def users_distinct(plays: DataFrame, require_id: bool = True) -> DataFrame:
    """Distinct user rows: a user whose level changed has several."""
    return distinct_projection(plays, USER_COLUMNS, ("user_id",) if require_id else ())


def _user_rows(plays: DataFrame, order: Sequence[str]) -> DataFrame:
    named = [F.col(source).alias(name) for name, source in USER_COLUMNS.items()]
    return with_keys(plays.select(*named, *order), "user_id")


def users_upsert(plays: DataFrame, order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """One row per user: first names seen, last level seen."""
    rows = _user_rows(plays, order)
    return upsert_rows(rows, ["user_id"], USER_KEEP, USER_UPDATE, order).select(*USER_COLUMNS)


def users_state(plays: DataFrame, order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """As :func:`users_upsert`, in a form that later batches can be merged into."""
    return upsert_state(_user_rows(plays, order), ["user_id"], USER_KEEP, USER_UPDATE, order)


def songs_distinct(raw_songs: DataFrame, require_id: bool = True) -> DataFrame:
    return distinct_projection(raw_songs, SONG_COLUMNS, ("song_id",) if require_id else ())


def songs_first(raw_songs: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One row per song; the first in ``order``, or the smallest row without one."""
    rows = with_keys(raw_songs, "song_id").select(*SONG_COLUMNS)
    return first_by_key(rows, ["song_id"], order)


def artists_distinct(raw_songs: DataFrame, require_id: bool = True) -> DataFrame:
    return distinct_projection(raw_songs, ARTIST_COLUMNS, ("artist_id",) if require_id else ())


def artists_upsert(raw_songs: DataFrame, order: Sequence[str] = ("song_id",)) -> DataFrame:
    """One row per artist: first name seen, last location and coordinates seen."""
    named = [F.col(source).alias(name) for name, source in ARTIST_COLUMNS.items()]
    rows = with_keys(raw_songs.select(*named, *order), "artist_id")
    return upsert_rows(rows, ["artist_id"], ARTIST_KEEP, ARTIST_UPDATE, order).select(*ARTIST_COLUMNS)


def with_scales(
    df: DataFrame, scales: dict[str, int], rounding: str = "half_up"
) -> DataFrame:
    """Turn the named columns into decimals of the given scale."""
    return df.withColumns({n: fixed_point(F.col(n), s, rounding) for n, s in scales.items()})


def time_dim(
    events: DataFrame,
    scope: str = "plays",
    whole_seconds: bool = False,
    distinct: bool = True,
    weekday_style: str = "name",
    month_as_text: bool = False,
    keep_epoch: bool = False,
    play_page: str | None = None,
) -> DataFrame:
    """Calendar rows of event times.

    ``scope`` is ``plays`` (play events), ``all`` (every event) or ``fact``:
    ``events`` is then a fact table that has ``start_time``. Duplicates go before
    the calendar columns are computed, since those follow from the time.
    ``distinct=False`` keeps one row per input row, which makes a later join on
    the time repeat fact rows. Events without a time have no row: the time is the
    key. (A play without a time stays in the fact, with NULL; required columns are
    checked by ``enforce``.)
    """
    if scope == "fact":
        if keep_epoch:
            raise ValueError("a fact table has no epoch column to keep")
        moments = events.select("start_time")
    elif scope in ("plays", "all"):
        if scope == "plays":
            events = plays_only(events, play_page) if play_page else plays_only(events)
        epoch = ["ts"] if keep_epoch else []
        moments = events.select(*epoch, start_time("ts", whole_seconds).alias("start_time"))
    else:
        raise ValueError("scope is 'plays', 'all' or 'fact'")
    moments = with_keys(moments, "start_time")
    if distinct:
        moments = moments.distinct()
    parts = time_parts(F.col("start_time"), weekday_style, month_as_text)
    return moments.select("*", *[part.alias(name) for name, part in parts.items()])
