"""Batches of songs and events in any order, against one look at everything."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starloom import plans, schemas
from starloom.streaming import IncrementalStar
from tests.conftest import event_rows

TITLES = ["Alpha", "Beta", "Gamma", "Delta", None]
ARTISTS = ["Ann", "Bob"]


def some_songs(rng, n):
    """Few titles, so that keys have several songs, and songs that come twice."""
    rows = []
    for _ in range(n):
        k = rng.randrange(12)
        title, artist = TITLES[k % 4], ARTISTS[k % 2]
        rows.append((1, f"A{k % 2}", None, None, "home", artist, f"S{k}", title, 100.0 + k % 3 + 0.25, 2000))
    return rows


def some_events(rng, n):
    rows = []
    for i in range(n):
        at = 1541106106796 + rng.randrange(40) * 5_000_000
        length = 100.0 + rng.randrange(4) + 0.5
        page = "NextSong" if rng.random() < 0.8 else "Home"
        rows.append((f"E{i}", at, "8", rng.choice(["free", "paid"]), rng.randrange(5), i % 3, rng.choice(TITLES), rng.choice(ARTISTS), length, page))
    return rows


def expected(songs, events, once, first):
    """(time, session, song id) of every row of the fact."""
    catalogue = {(s[7], s[5], int(s[8]), s[6], s[1]) for s in songs}
    rows = []
    for event in sorted({e[1:] for e in events}) if once else [e[1:] for e in events]:
        at, _, _, session, _, title, artist, length, page = event
        if page == "NextSong":
            found = sorted(s[3] for s in catalogue if s[:3] == (title, artist, int(length)))
            rows += [(at // 1000, session, song) for song in (found[:1] if first else found) or [None]]
    return sorted(rows, key=repr)


def stored(star, spark):
    rows = star.songplays(spark).select(F.unix_timestamp(F.col("start_time").cast("timestamp")), "session_id", "song_id")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def unique(rows, once):
    # Names must not depend on the position, or no event would come twice.
    return list(dict.fromkeys(rows)) if once else rows


@pytest.mark.parametrize(("once", "against"), [(True, "raw"), (False, "first"), (False, "dimensions")])
def test_any_order_of_batches_gives_one_load(spark, tmp_path, once, against):
    rng = random.Random(f"{once}{against}")
    profile = replace(plans.STAGED_LEFT, dedup_raw=once)
    if against == "first":
        profile = replace(profile, match_duplicates="first")
    if against == "dimensions":
        profile = replace(profile, match_against="dimensions")
    star = IncrementalStar(str(tmp_path / "star"), profile, schemas.STAGED_EVENT)
    take_songs, take_events = star.song_loader(spark), star.loader(spark=spark)
    songs, events, last, n_songs, n_events = [], [], None, 0, 0
    for step in ["events", "songs", "events", "again", "compact", "again songs", "events", "songs"]:
        if step == "songs":
            batch = some_songs(rng, 4)
            last_songs = spark.createDataFrame(batch, schemas.RAW_SONG)
            take_songs(last_songs, n_songs)
            songs += batch
            n_songs += 1
        elif step == "events":
            batch = some_events(rng, 8)
            if once and events:
                batch += rng.sample(events, 4) + batch[:2]
            last = spark.createDataFrame(list(event_rows(batch)), schemas.RAW_EVENT)
            take_events(last, n_events)
            events += batch
            n_events += 1
        elif step == "again":
            # The last batch of events was not recorded as done and comes again, after songs.
            last_songs = spark.createDataFrame(more := some_songs(rng, 3), schemas.RAW_SONG)
            take_songs(last_songs, n_songs)
            songs += more
            n_songs += 1
            take_events(last, n_events - 1)
        elif step == "again songs":
            take_songs(last_songs, n_songs - 1)
        else:
            star.compact(spark, through=0)
            gone = star.vacuum(spark)
            assert "songplays/batch_id=0" in gone
        if step not in ("events", "compact"):
            assert stored(star, spark) == expected(songs, events, once, against == "first"), step
    assert star.raw_songs(spark).count() == len({s[5:9] for s in songs})
    star.compact(spark, through=n_events - 1)
    gone = star.vacuum(spark)
    assert {f"corrections/batch_id={n}" for n in range(n_songs)} & set(gone)
    assert stored(star, spark) == expected(songs, events, once, against == "first")


def test_inner_plays_appear_when_their_song_does(spark, tmp_path):
    profile = replace(plans.STAGED_LEFT, match_how="inner")
    star = IncrementalStar(str(tmp_path / "star"), profile, schemas.STAGED_EVENT)
    events = [("E0", 1541106106796, "8", "free", 1, 0, "Alpha", "Ann", 100.5, "NextSong")]
    star.loader(spark=spark)(spark.createDataFrame(list(event_rows(events)), schemas.RAW_EVENT), 0)
    assert star.songplays(spark).count() == star.time(spark).count() == 0
    songs = [(1, "A0", None, None, "home", "Ann", "S0", "Alpha", 100.25, 2000)]
    star.song_loader(spark)(spark.createDataFrame(songs, schemas.RAW_SONG), 0)
    assert [r.song_id for r in star.songplays(spark).collect()] == ["S0"]
    assert star.time(spark).count() == 1


def test_an_event_that_comes_again_reads_its_days_only(spark, tmp_path):
    profile = replace(plans.STAGED_LEFT, dedup_raw=True)
    star = IncrementalStar(str(tmp_path / "star"), profile, schemas.STAGED_EVENT)
    take = star.loader(spark.createDataFrame([], schemas.STAGED_SONG))
    day = 24 * 60 * 60 * 1000
    rows = [("E", 1541106106796 + k * day, "8", "free", 1, k, "Alpha", "Ann", 100.5, "NextSong") for k in range(6)]
    undated = ("E", None, "8", "free", 1, 0, "Alpha", "Ann", 100.5, "NextSong")
    frames = [spark.createDataFrame(list(event_rows(part)), schemas.RAW_EVENT) for part in (rows[:4] + [undated], rows[2:] + [undated])]
    for number, frame in enumerate(frames):
        take(frame, number)
    days = sorted((tmp_path / "star" / "events").glob("batch_id=*/_day=*"))
    assert [str(d).split("star/events/")[1].split("/")[0] for d in days] == ["batch_id=0"] * 5 + ["batch_id=1"] * 2
    assert star.songplays(spark).count() == 7
    star.compact(spark, through=1)
    star.vacuum(spark)
    take(frames[1], 2)
    assert star.songplays(spark).count() == 7 and star.users(spark).count() == 1
