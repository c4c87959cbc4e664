"""One session for all tests, and the small fixture log and catalogue."""

from __future__ import annotations

import contextlib
import io
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from starloom import schemas  # noqa: E402
from starloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# song_id, title, artist_id, artist_name, duration, year
CATALOGUE = [
    ("S1", "Alpha", "A1", "Ann", 218.93179, 1999),
    ("S2", "Alpha", "A2", "Bob", 100.0, 0),
    ("S3", "Alpha", "A1", "Ann", 218.1, 2001),
    ("S4", "Beta", "A2", "Bob", 55.5, 2001),
    ("S5", "Gamma", "A3", "Cyd", 10.0, None),
]

# event, ts, user, level, session, item, song, artist, length, page
EVENTS = [
    ("E1", 1541106106796, "8", "free", 139, 1, "Alpha", "Ann", 218.93179, "NextSong"),
    ("E2", 1541106106999, "8", "free", 139, 2, "Alpha", "Ann", 218.5, "NextSong"),
    ("E3", 1541106400000, "8", "paid", 140, 0, "Beta", "Bob", 55.5, "NextSong"),
    ("E4", 1541200000000, "10", "free", 182, 0, "Alpha", "Zed", 1.0, "NextSong"),
    ("E5", 1541200000001, "10", "free", 182, 1, "Nope", "Ann", 2.0, "NextSong"),
    ("E6", 1541200500000, "", "free", 183, 0, None, None, None, "Home"),
]

NAMES = {"8": ("Kay", "Sun", "F"), "10": ("Syl", "Cruz", "F"), "": (None, None, None)}


@pytest.fixture(scope="session")
def raw_songs(spark):
    rows = [
        (1, artist_id, None, None, f"home of {name}", name, song_id, title, duration, year)
        for song_id, title, artist_id, name, duration, year in CATALOGUE
    ]
    return spark.createDataFrame(rows, schemas.RAW_SONG)


def event_rows(events=EVENTS):
    for event, ts, user, level, session, item, song, artist, length, page in events:
        first, last, gender = NAMES[user]
        yield (
            artist, "Logged In", first, gender, item, last, length, level, f"at {event}", "PUT", page,
            1540919166796.0, session, song, 200, ts, f"agent {event}", user,
        )


@pytest.fixture(scope="session")
def raw_events(spark):
    """As read from JSON: the user is text."""
    return spark.createDataFrame(list(event_rows()), schemas.RAW_EVENT)


@pytest.fixture(scope="session")
def events(raw_events):
    from starloom.sources import conform

    return conform(raw_events, schemas.STAGED_EVENT)


@pytest.fixture(scope="session")
def plays(events):
    from starloom.operators.rows import plays_only

    return plays_only(events)


@pytest.fixture
def raw_files(tmp_path, raw_songs, raw_events):
    """The fixture as JSON files below two folders."""
    from starloom.plans import Sources

    raw_songs.repartition(3).write.json(str(tmp_path / "songs" / "A" / "B"))
    raw_events.coalesce(1).write.json(str(tmp_path / "events" / "2018"))
    return Sources(songs=str(tmp_path / "songs"), events=str(tmp_path / "events"))


def plan_of(df, mode="formatted") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
