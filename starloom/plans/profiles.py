"""The ways to build the star schema, as sets of choices.

The four profiles produce the same tables with different meanings; every choice
is a field, so others can be put together with ``dataclasses.replace``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from starloom.operators.match import ARTIST, LENGTH, TITLE, WHOLE_LENGTH, MatchKey
from starloom.operators.rows import PLAY_PAGE


@dataclass(frozen=True)
class Profile:
    name: str

    # Events and their songs
    match_keys: tuple[MatchKey, ...]
    match_how: str  # inner, left
    match_duplicates: str = "all"  # all, first
    match_against: str = "raw"  # raw catalogue rows, or the songs (and artists) dimensions
    play_page: str = PLAY_PAGE
    dedup_raw: bool = False
    hot_share: float | None = None  # see operators.match
    spread: int = 64  # partitions for a hot title, at most

    # Fact
    whole_seconds: bool = False
    play_key: str = "dense"  # dense, monotonic, hash, or left to the writer: ranged (in order), none
    numbered_in_order: bool = True  # dense keys follow the event time
    dedup_fact: bool = False
    calendar_columns: tuple[str, ...] = ()  # of the fact, for its partitions

    # Dimensions
    users: str = "distinct"  # distinct, upsert
    songs: str = "distinct"  # distinct, first
    artists: str = "distinct"  # distinct, upsert
    require_ids: bool = True
    time_scope: str = "plays"  # plays, all, fact
    time_distinct: bool = True
    time_keeps_epoch: bool = False
    weekday_style: str = "name"
    month_as_text: bool = False
    duration_scale: int = 5
    coordinate_scale: int | None = None
    rounding: str = "half_up"
    scaled_in_staging: bool = False  # before duplicates are judged, or after

    # Storage
    load_modes: Mapping[str, str] = field(default_factory=dict)  # overwrite unless named
    partition_by: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    check: bool = False  # every table must have rows
    enforce: bool = False  # the registry's required columns, unique and foreign keys hold

    # Column headings other than the registry's, for readers that expect them
    labels: Mapping[str, Mapping[str, str]] = field(default_factory=dict)


# Rows arrive by upsert: dimensions can be loaded again, the fact grows with each load.
UPSERT = Profile(
    "upsert",
    match_keys=(TITLE, ARTIST, LENGTH),
    match_how="left",
    match_duplicates="first",
    match_against="dimensions",
    users="upsert",
    songs="first",
    artists="upsert",
    load_modes={
        "songplays": "append",
        "users": "merge",
        "songs": "insert",
        "artists": "merge",
        "time": "insert",
    },
)

# Staging tables, then set-based inserts that add to what is there. A duration
# has no fraction in this store's ``songs``.
STAGED_INNER = Profile(
    "staged_inner",
    match_keys=(ARTIST, TITLE),
    match_how="inner",
    whole_seconds=True,
    numbered_in_order=False,
    time_scope="all",
    weekday_style="padded",
    duration_scale=0,
    load_modes={
        "songplays": "append",
        "users": "append",
        "songs": "append",
        "artists": "append",
        "time": "append",
    },
)

# Partitioned Parquet files, rewritten by every load. Songs are partitioned by
# year only: a level per artist would give about one directory per row.
LAKE = Profile(
    "lake",
    match_keys=(TITLE,),
    match_how="inner",
    match_against="dimensions",
    dedup_raw=True,
    play_key="monotonic",
    hot_share=0.01,
    calendar_columns=("year", "month"),
    require_ids=False,
    time_keeps_epoch=True,
    weekday_style="sunday1",
    partition_by={"songs": ("year",), "time": ("year", "month"), "songplays": ("year", "month")},
    labels={
        "users": {"user_id": "userId", "first_name": "firstName", "last_name": "lastName"},
        "artists": {
            "name": "artist_name",
            "location": "artist_location",
            "latitude": "artist_latitude",
            "longitude": "artist_longitude",
        },
    },
)

# Recreated tables, staging, fact, dimensions, checks. The time rows follow from
# the fact and are distinct, so that joining them does not repeat plays.
STAGED_LEFT = Profile(
    "staged_left",
    match_keys=(TITLE, ARTIST, WHOLE_LENGTH),
    match_how="left",
    whole_seconds=True,
    play_key="hash",
    require_ids=False,
    time_scope="fact",
    weekday_style="sunday0",
    month_as_text=True,
    duration_scale=0,
    coordinate_scale=0,
    rounding="truncate",
    scaled_in_staging=True,
    check=True,
    labels={
        "songplays": {
            "songplay_id": "playid",
            "user_id": "userid",
            "song_id": "songid",
            "artist_id": "artistid",
            "session_id": "sessionid",
        },
        "users": {"user_id": "userid"},
        "songs": {"song_id": "songid", "artist_id": "artistid"},
        "artists": {"artist_id": "artistid", "latitude": "lattitude"},
    },
)

PROFILES = {profile.name: profile for profile in (UPSERT, STAGED_INNER, LAKE, STAGED_LEFT)}
