"""Table registry: column types, keys and constraints of every table the library knows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT = StringType()
INT = IntegerType()
LONG = LongType()
REAL = DoubleType()
MOMENT = TimestampNTZType()
SECONDS = DecimalType(10, 5)


def columns(**types: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


# The field names and kinds of the raw files.
RAW_SONG = columns(
    num_songs=INT,
    artist_id=TEXT,
    artist_latitude=REAL,
    artist_longitude=REAL,
    artist_location=TEXT,
    artist_name=TEXT,
    song_id=TEXT,
    title=TEXT,
    duration=REAL,
    year=INT,
)

# ``registration`` is written with a fraction and ``userId`` as text, empty when
# logged out; ``STAGED_EVENT`` is the typed form.
RAW_EVENT = columns(
    artist=TEXT,
    auth=TEXT,
    firstName=TEXT,
    gender=TEXT,
    itemInSession=INT,
    lastName=TEXT,
    length=REAL,
    level=TEXT,
    location=TEXT,
    method=TEXT,
    page=TEXT,
    registration=REAL,
    sessionId=INT,
    song=TEXT,
    status=INT,
    ts=LONG,
    userAgent=TEXT,
    userId=TEXT,
)

STAGED_EVENT = columns(
    artist=TEXT,
    auth=TEXT,
    firstName=TEXT,
    gender=TEXT,
    itemInSession=INT,
    lastName=TEXT,
    length=REAL,
    level=TEXT,
    location=TEXT,
    method=TEXT,
    page=TEXT,
    registration=LONG,
    sessionId=INT,
    song=TEXT,
    status=INT,
    ts=LONG,
    userAgent=TEXT,
    userId=INT,
)

STAGED_SONG = RAW_SONG

# The CSV logs have no ``userAgent`` and carry rounded epochs, which are not event times.
RAW_EVENT_CSV = columns(
    artist=TEXT,
    auth=TEXT,
    firstName=TEXT,
    gender=TEXT,
    itemInSession=INT,
    lastName=TEXT,
    length=REAL,
    level=TEXT,
    location=TEXT,
    method=TEXT,
    page=TEXT,
    registration=REAL,
    sessionId=INT,
    song=TEXT,
    status=INT,
    ts=REAL,
    userId=INT,
)

# Column order of the staged listening file behind the lookup tables.
STAGED_LISTEN = columns(
    artist=TEXT,
    firstName=TEXT,
    gender=TEXT,
    itemInSession=INT,
    lastName=TEXT,
    length=REAL,
    level=TEXT,
    location=TEXT,
    sessionId=INT,
    song=TEXT,
    userId=INT,
)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    references: str


@dataclass(frozen=True)
class Table:
    """One stored table. ``required`` columns must not be NULL, texts no longer than ``longest``."""

    name: str
    schema: StructType
    primary_key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    longest: Mapping[str, int] = field(default_factory=dict)


USERS = Table(
    "users",
    columns(user_id=INT, first_name=TEXT, last_name=TEXT, gender=TEXT, level=TEXT),
    primary_key=("user_id",),
    required=("user_id", "first_name", "last_name", "gender", "level"),
)

SONGS = Table(
    "songs",
    columns(song_id=TEXT, title=TEXT, artist_id=TEXT, year=INT, duration=SECONDS),
    primary_key=("song_id",),
    required=("song_id", "title", "artist_id", "year", "duration"),
)

# Coordinates are unknown for most artists, so they are not required.
ARTISTS = Table(
    "artists",
    columns(artist_id=TEXT, name=TEXT, location=TEXT, latitude=REAL, longitude=REAL),
    primary_key=("artist_id",),
    required=("artist_id", "name", "location"),
)

TIME = Table(
    "time",
    columns(start_time=MOMENT, hour=INT, day=INT, week=INT, month=INT, year=INT, weekday=TEXT),
    primary_key=("start_time",),
    required=("start_time", "hour", "day", "week", "month", "year", "weekday"),
)

SONGPLAYS = Table(
    "songplays",
    columns(
        songplay_id=LONG,
        start_time=MOMENT,
        user_id=INT,
        level=TEXT,
        song_id=TEXT,
        artist_id=TEXT,
        session_id=INT,
        location=TEXT,
        user_agent=TEXT,
    ),
    primary_key=("songplay_id",),
    required=("songplay_id", "start_time", "user_id", "level", "session_id", "location", "user_agent"),
    foreign_keys=(
        ForeignKey("start_time", "time", "start_time"),
        ForeignKey("user_id", "users", "user_id"),
        ForeignKey("song_id", "songs", "song_id"),
        ForeignKey("artist_id", "artists", "artist_id"),
    ),
)

STAGING_EVENTS = Table("staging_events", STAGED_EVENT, longest={"gender": 1, "method": 3})
STAGING_SONGS = Table("staging_songs", STAGED_SONG)

ARTIST_SONG_LOOKUP = Table(
    "artist_song_lookup",
    columns(session_id=INT, item_in_session=INT, artist_name=TEXT, song_title=TEXT, song_length=REAL),
    primary_key=("session_id", "item_in_session"),
)

USER_ACTIVITY = Table(
    "user_activity",
    columns(
        session_id=INT,
        user_id=INT,
        item_in_session=INT,
        artist_name=TEXT,
        song_title=TEXT,
        first_name=TEXT,
        last_name=TEXT,
    ),
    primary_key=("session_id", "user_id", "item_in_session"),
)

USER_SONGS = Table(
    "user_songs",
    columns(song_title=TEXT, user_id=INT, first_name=TEXT, last_name=TEXT),
    primary_key=("song_title", "user_id"),
)

DIMENSIONS = (USERS, SONGS, ARTISTS, TIME)
LOOKUPS = (ARTIST_SONG_LOOKUP, USER_ACTIVITY, USER_SONGS)

# Creation order: whatever a foreign key points at comes first. Dropping goes backwards.
STAR = (*DIMENSIONS, SONGPLAYS)
WAREHOUSE = (STAGING_EVENTS, STAGING_SONGS, *STAR)
