"""Star tables from staged rows, as a profile describes them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.keys import dense_key, hash_key, in_number_order, monotonic_key
from starloom.functions.timeparts import start_time, time_parts
from starloom.operators import dims
from starloom.operators.match import distinct_matches, join_catalogue, match
from starloom.operators.rows import distinct_rows, plays_only
from starloom.plans.profiles import Profile

# Of a play: what it brings itself, and what the fact stores.
PLAY_VALUES = ("start_time", "user_id", "level", "session_id", "location", "user_agent")
FACT_COLUMNS = (
    "start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent"
)
PLAY_ORDER = ("start_time", "session_id", "_item", "song_id", "artist_id")


def _scales(profile: Profile, prefix: str = "") -> dict[str, int]:
    if profile.coordinate_scale is None:
        return {}
    return {f"{prefix}{name}": profile.coordinate_scale for name in ("latitude", "longitude")}


def build_catalogue(raw_songs: DataFrame, profile: Profile) -> dict[str, DataFrame]:
    """``songs`` and ``artists`` from raw song rows."""
    duration = {"duration": profile.duration_scale}
    if profile.scaled_in_staging:
        scales = duration | _scales(profile, "artist_")
        raw_songs = dims.with_scales(raw_songs, scales, profile.rounding)
    # Repeated raw rows change none of these, so they are not looked for.
    if profile.songs == "first":
        songs = dims.songs_first(raw_songs)
    else:
        songs = dims.songs_distinct(raw_songs, profile.require_ids)
    if profile.artists == "upsert":
        artists = dims.artists_upsert(raw_songs)
    else:
        artists = dims.artists_distinct(raw_songs, profile.require_ids)
    if not profile.scaled_in_staging:
        songs = dims.with_scales(songs, duration, profile.rounding)
        artists = dims.with_scales(artists, _scales(profile), profile.rounding)
    return {"songs": songs, "artists": artists}


def build_users(events: DataFrame, profile: Profile) -> DataFrame:
    plays = plays_only(events, profile.play_page)
    if profile.users == "upsert":
        return dims.users_upsert(plays)
    return dims.users_distinct(plays, profile.require_ids)


def build_time(events: DataFrame, songplays: DataFrame | None, profile: Profile) -> DataFrame:
    """Calendar rows of events, or of ``songplays`` where the profile says so."""
    return dims.time_dim(
        songplays if profile.time_scope == "fact" else events,
        scope=profile.time_scope,
        whole_seconds=profile.whole_seconds,
        distinct=profile.time_distinct,
        weekday_style=profile.weekday_style,
        month_as_text=profile.month_as_text,
        keep_epoch=profile.time_keeps_epoch,
        play_page=profile.play_page,
    )


def build_songplays(
    events: DataFrame,
    raw_songs: DataFrame,
    catalogue: dict[str, DataFrame],
    profile: Profile,
    first_id: int = 1,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The fact: play events with their song, in the registry's columns.

    ``keep`` names further columns of the events to carry along; the fact's own
    duplicates cannot be removed then.
    """
    if keep and profile.dedup_fact:
        raise ValueError("further columns tell rows of the fact apart")
    if profile.match_against == "dimensions":
        songs = catalogue["songs"]
        if any(key.song == "artist_name" for key in profile.match_keys):
            songs = join_catalogue(songs, catalogue["artists"])
    else:
        songs = raw_songs
    plays = plays_only(events, profile.play_page)
    if profile.dedup_raw and not profile.dedup_fact:
        # Otherwise the fact's own duplicate removal covers it, on fewer columns.
        plays = distinct_rows(plays)
        if profile.match_against == "raw":
            songs = distinct_rows(songs)
    plays = plays.select(
        start_time("ts", profile.whole_seconds).alias("start_time"),
        F.col("userId").alias("user_id"),
        "level",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        F.col("itemInSession").alias("_item"),
        *dict.fromkeys([*[key.event for key in profile.match_keys], *keep]),
    )
    how, spread = profile.match_how, {"hot_share": profile.hot_share, "spread": profile.spread}
    if profile.dedup_fact and how == "inner" and profile.match_duplicates == "all":
        fact = distinct_matches(plays, songs, profile.match_keys, PLAY_VALUES, **spread)
    else:
        fact = match(plays, songs, profile.match_keys, how, profile.match_duplicates, **spread)
        if profile.dedup_fact:
            fact = distinct_rows(fact.select(*PLAY_VALUES, "song_id", "artist_id"))
    if profile.dedup_fact:
        fact = fact.withColumn("_item", F.lit(0))
    fact = fact.select(*FACT_COLUMNS, "_item", *keep)
    if profile.play_key == "dense":
        order = PLAY_ORDER if profile.numbered_in_order else ()
        keyed = dense_key(fact, order, "songplay_id", first_id)
    elif profile.play_key == "monotonic":
        keyed = fact.select(monotonic_key().alias("songplay_id"), "*")
    elif profile.play_key == "none":
        keyed = fact
    elif profile.play_key == "ranged":
        keyed = in_number_order(fact, PLAY_ORDER if profile.numbered_in_order else ())
    elif profile.play_key == "hash":
        key = hash_key(F.col("session_id"), F.col("start_time"))
        keyed = fact.select(key.alias("songplay_id"), "*")
    else:
        raise ValueError(f"unknown key style {profile.play_key!r}")
    keyed = keyed.drop("_item")
    if profile.calendar_columns:
        # The calendar follows from the play's own time; no join is needed.
        parts = time_parts(F.col("start_time"))
        keyed = keyed.withColumns({name: parts[name] for name in profile.calendar_columns})
    return keyed


def build_plays(
    events: DataFrame,
    raw_songs: DataFrame,
    catalogue: dict[str, DataFrame],
    profile: Profile,
    first_id: int = 1,
) -> dict[str, DataFrame]:
    """``songplays``, ``users`` and ``time`` from staged events."""
    songplays = build_songplays(events, raw_songs, catalogue, profile, first_id)
    return {
        "songplays": songplays,
        "users": build_users(events, profile),
        "time": build_time(events, songplays, profile),
    }
