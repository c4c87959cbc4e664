"""Whole loads over the fixture, their second run, and the incremental load."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starloom import plans, schemas
from starloom.operators import quality, tables
from starloom.plans import build_catalogue
from starloom.sources import conform, scan_csv
from starloom.streaming import IncrementalStar, load_available
from starloom.storage import children, shared_root
from starloom.workloads.loads import numbers
from starloom.workloads.standin import raw_events
from tests.conftest import EVENTS, event_rows, plan_of, rows_of

TABLES = ("songplays", "users", "songs", "artists", "time")


def counts(spark, output):
    return {name: plans.read_table(spark, output, name).count() for name in TABLES}


def played(spark, output):
    fact = plans.read_table(spark, output, "songplays")
    agent = F.substring("user_agent", 7, 2)
    return sorted((r[0], r[1]) for r in fact.select(agent, F.coalesce("song_id", F.lit("-"))).collect())


def test_upsert(spark, tmp_path, raw_files):
    output = str(tmp_path / "star")
    plans.run(spark, raw_files, output, plans.UPSERT)
    assert counts(spark, output) == {"songplays": 5, "users": 2, "songs": 5, "artists": 3, "time": 5}
    assert played(spark, output) == [("E1", "S1"), ("E2", "-"), ("E3", "S4"), ("E4", "-"), ("E5", "-")]
    time = plans.read_table(spark, output, "time")
    assert {r.weekday for r in time.collect()} == {"Thursday", "Friday"}

    # Again: dimensions stay, the fact grows and its numbers go on.
    plans.run(spark, raw_files, output, plans.UPSERT)
    assert counts(spark, output) == {"songplays": 10, "users": 2, "songs": 5, "artists": 3, "time": 5}
    ids = [r.songplay_id for r in plans.read_table(spark, output, "songplays").collect()]
    assert sorted(ids) == list(range(1, 11))


def test_upsert_updates_what_a_later_load_brings(spark, tmp_path, raw_files):
    output = str(tmp_path / "star")
    plans.run(spark, raw_files, output, plans.UPSERT)
    later = [("E7", 1541300000000, "10", "paid", 190, 0, "Delta", "Ann", 7.0, "NextSong")]
    spark.createDataFrame(list(event_rows(later)), schemas.RAW_EVENT).write.json(str(tmp_path / "e2"))
    song = (1, "A1", 9.0, 8.0, "new place", "Ann Two", "S6", "Delta", 7.0, 2018)
    spark.createDataFrame([song], schemas.RAW_SONG).write.json(str(tmp_path / "s2"))
    more = plans.Sources(songs=str(tmp_path / "s2"), events=str(tmp_path / "e2"))
    plans.run(spark, more, output, plans.UPSERT)
    users = {r.user_id: r.level for r in plans.read_table(spark, output, "users").collect()}
    assert users == {8: "paid", 10: "paid"}
    ann = plans.read_table(spark, output, "artists").filter("artist_id = 'A1'").first()
    assert (ann.name, ann.location, ann.latitude) == ("Ann", "new place", 9.0)
    # The artist is known as Ann, under which the play finds the new song.
    assert ("E7", "S6") in played(spark, output)
    assert counts(spark, output)["songs"] == 6


def test_staged_inner(spark, tmp_path, raw_files):
    output = str(tmp_path / "star")
    plans.run(spark, raw_files, output, plans.STAGED_INNER)
    assert counts(spark, output) == {"songplays": 5, "users": 3, "songs": 5, "artists": 3, "time": 4}
    assert played(spark, output) == [
        ("E1", "S1"), ("E1", "S3"), ("E2", "S1"), ("E2", "S3"), ("E3", "S4")
    ]
    durations = {r.song_id: int(r.duration) for r in plans.read_table(spark, output, "songs").collect()}
    assert durations["S1"] == 219 and durations["S4"] == 56
    assert "Thursday " in {r.weekday for r in plans.read_table(spark, output, "time").collect()}
    plans.run(spark, raw_files, output, plans.STAGED_INNER)
    assert counts(spark, output) == {"songplays": 10, "users": 6, "songs": 10, "artists": 6, "time": 8}


def test_lake(spark, tmp_path, raw_files):
    output = str(tmp_path / "star")
    expected = {"songplays": 10, "users": 3, "songs": 5, "artists": 3, "time": 5}
    for _ in range(2):
        plans.run(spark, raw_files, output, plans.LAKE)
        assert counts(spark, output) == expected
    fact = plans.read_table(spark, output, "songplays")
    assert fact.select("songplay_id").distinct().count() == 10
    assert rows_of(fact.select("year", "month").distinct()) == [(2018, 11)]
    assert {r.weekday for r in plans.read_table(spark, output, "time").collect()} == {5, 6}
    users = plans.labelled(plans.read_table(spark, output, "users"), "users", plans.LAKE)
    assert users.columns == ["userId", "firstName", "lastName", "gender", "level"]


def test_repeated_files_change_nothing_where_raw_rows_are_distinct(spark, tmp_path, raw_files):
    twice = str(tmp_path / "twice")
    for _ in range(2):
        spark.read.schema(schemas.RAW_EVENT).option("recursiveFileLookup", "true").json(
            raw_files.events
        ).write.mode("append").json(twice)
    expected = [
        (plans.LAKE, {"songplays": 10, "users": 3, "time": 5}),
        (replace(plans.LAKE, dedup_fact=False), {"songplays": 10, "users": 3, "time": 5}),
        (replace(plans.LAKE, dedup_fact=False, dedup_raw=False), {"songplays": 20, "users": 3, "time": 5}),
    ]
    for i, (profile, rows) in enumerate(expected):
        output = str(tmp_path / f"star{i}")
        plans.run(spark, replace(raw_files, events=twice), output, profile)
        assert {name: counts(spark, output)[name] for name in rows} == rows


def test_staged_left(spark, tmp_path, raw_files):
    output = str(tmp_path / "star")
    for _ in range(2):
        plans.run(spark, raw_files, output, plans.STAGED_LEFT)
        assert counts(spark, output) == {
            "songplays": 7, "users": 3, "songs": 5, "artists": 3, "time": 3
        }
    assert played(spark, output) == [
        ("E1", "S1"), ("E1", "S3"), ("E2", "S1"), ("E2", "S3"), ("E3", "S4"), ("E4", "-"), ("E5", "-")
    ]
    fact = plans.read_table(spark, output, "songplays")
    assert rows_of(quality.duplicate_keys(fact, ["songplay_id"]).select("row_count")) == [(2,), (4,)]
    time = plans.read_table(spark, output, "time")
    assert dict(time.dtypes)["month"] == "string"
    assert {r.weekday for r in time.collect()} == {4, 5}
    songs = plans.labelled(plans.read_table(spark, output, "songs"), "songs", plans.STAGED_LEFT)
    assert songs.columns[0] == "songid"
    assert {int(r.duration) for r in songs.collect()} == {218, 100, 55, 10}


def test_a_load_leaves_no_intermediates(spark, tmp_path, raw_files):
    folder = shared_root(spark)
    before = children(spark, folder)
    for profile in plans.PROFILES.values():
        plans.run(spark, raw_files, str(tmp_path / profile.name), profile)
    assert children(spark, folder) == before


def test_numbers_go_on_after_an_empty_load(spark, tmp_path, raw_files):
    output = str(tmp_path / "star")
    spark.createDataFrame([], schemas.RAW_EVENT).write.json(str(tmp_path / "nothing"))
    empty = replace(raw_files, events=str(tmp_path / "nothing"))
    for sources in (raw_files, empty, raw_files):
        plans.run(spark, sources, output, plans.UPSERT)
    ids = [r.songplay_id for r in plans.read_table(spark, output, "songplays").collect()]
    assert sorted(ids) == list(range(1, 11))
    assert counts(spark, output)["time"] == 5


def test_constraints_can_be_enforced(spark, tmp_path, raw_files, raw_songs):
    strict = replace(plans.UPSERT, enforce=True)
    with pytest.raises(quality.QualityError, match=r"songs: not_null year \(1\)"):
        plans.run(spark, raw_files, str(tmp_path / "star"), strict)
    raw_songs.filter("year IS NOT NULL").write.json(str(tmp_path / "dated"))
    dated = replace(raw_files, songs=str(tmp_path / "dated"))
    for _ in range(2):
        plans.run(spark, dated, str(tmp_path / "star"), strict)
    # Users of several rows break the users' key, as does a hash that collides.
    with pytest.raises(quality.QualityError, match="users: unique_key user_id"):
        plans.run(spark, dated, str(tmp_path / "other"), replace(plans.STAGED_LEFT, enforce=True))


def test_songs_by_year_and_artist(spark, tmp_path, raw_files):
    layout = {"songs": ("year", "artist_id")}
    output = str(tmp_path / "star")
    version = plans.run(spark, raw_files, output, replace(plans.LAKE, partition_by=layout))
    assert (tmp_path / "star" / "songs" / f"version={version}" / "year=1999" / "artist_id=A1").is_dir()
    songs = plans.read_table(spark, output, "songs")
    assert songs.columns == schemas.SONGS.schema.names
    assert songs.filter("year IS NULL AND artist_id = 'A3'").count() == 1
    assert songs.filter("title = 'Alpha'").count() == 3


def test_star_retrieval_in_sql(spark, tmp_path, raw_files):
    output = str(tmp_path / "star")
    plans.run(spark, raw_files, output, plans.UPSERT)
    assert plans.create_views(spark, output) == sorted(TABLES)
    answer = spark.sql(
        """
        SELECT u.level AS user_level, t.weekday AS played_on, count(*) AS plays, max(s.year) AS newest
        FROM users u, time t, songplays f LEFT JOIN songs s USING (song_id)
        WHERE f.user_id = u.user_id AND f.start_time = t.start_time
        GROUP BY u.level, t.weekday
        """
    )
    assert rows_of(answer) == [("free", "Friday", 2, None), ("paid", "Thursday", 3, 2001)]
    plans.create_views(spark, output, plans.STAGED_LEFT)
    assert spark.table("songplays").columns[:3] == ["playid", "start_time", "userid"]


def test_time_duplicates_can_be_asked_for(spark, tmp_path, raw_files):
    output = str(tmp_path / "star")
    plans.run(spark, raw_files, output, replace(plans.STAGED_LEFT, time_distinct=False))
    assert counts(spark, output)["time"] == 7


def test_failed_check_keeps_the_previous_version(spark, tmp_path, raw_files):
    output = str(tmp_path / "star")
    plans.run(spark, raw_files, output, plans.STAGED_LEFT)
    spark.createDataFrame([], schemas.RAW_EVENT).write.json(str(tmp_path / "nothing"))
    empty = replace(raw_files, events=str(tmp_path / "nothing"))
    with pytest.raises(quality.QualityError, match="songplays"):
        plans.run(spark, empty, output, plans.STAGED_LEFT)
    assert counts(spark, output)["songplays"] == 7


def test_unreadable_line_gives_no_row(spark, tmp_path, raw_files):
    broken = tmp_path / "songs" / "broken.json"
    broken.write_text('{"num_songs": 1, "artist_id": "A9", "song')
    output = str(tmp_path / "star")
    plans.run(spark, raw_files, output, plans.LAKE)
    assert counts(spark, output)["songs"] == 5
    with pytest.raises(ValueError, match="do not fit"):
        plans.run(spark, replace(raw_files, on_reject="fail"), str(tmp_path / "s2"), plans.LAKE)


def test_json_paths_load_like_names(spark, tmp_path, raw_files):
    by_name, by_path = str(tmp_path / "a"), str(tmp_path / "b")
    paths = [f"$.{name}" for name in schemas.STAGED_EVENT.names]
    plans.run(spark, raw_files, by_name, plans.STAGED_LEFT)
    mapping = tmp_path / "paths.txt"
    mapping.write_text(json.dumps({"jsonpaths": paths}, indent=2))
    plans.run(spark, replace(raw_files, events_json_paths=str(mapping)), by_path, plans.STAGED_LEFT)
    for name in TABLES:
        assert rows_of(plans.read_table(spark, by_name, name)) == rows_of(
            plans.read_table(spark, by_path, name)
        )


def test_csv_and_compressed_logs_load_like_json(spark, tmp_path, raw_files, raw_events):
    plans.run(spark, raw_files, str(tmp_path / "json"), plans.STAGED_LEFT)
    raw_events.write.options(header="true", escape='"').csv(str(tmp_path / "csv"))
    raw_events.write.option("compression", "gzip").json(str(tmp_path / "gz"))
    for name, fmt in (("csv", "csv"), ("gz", "json")):
        sources = replace(raw_files, events=str(tmp_path / name), events_format=fmt)
        plans.run(spark, sources, str(tmp_path / f"from-{name}"), plans.STAGED_LEFT)
        for table in TABLES:
            assert rows_of(plans.read_table(spark, str(tmp_path / f"from-{name}"), table)) == rows_of(
                plans.read_table(spark, str(tmp_path / "json"), table)
            )


def test_a_source_without_files_raises(spark, tmp_path, raw_files):
    (tmp_path / "void").mkdir()
    for sources in (replace(raw_files, events=str(tmp_path / "void")), replace(raw_files, songs_glob="*.csv")):
        with pytest.raises(FileNotFoundError):
            plans.run(spark, sources, str(tmp_path / "star"), plans.UPSERT)


def test_csv_of_another_layout_is_not_misread(spark, tmp_path, raw_files, raw_events):
    raw_events.drop("userAgent").write.option("header", "true").csv(str(tmp_path / "csv"))
    sources = replace(raw_files, events=str(tmp_path / "csv"), events_format="csv")
    with pytest.raises(Exception, match="(?i)header"):
        plans.run(spark, sources, str(tmp_path / "star"), plans.UPSERT)


def test_plain_csv_is_split(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = spark.range(20000).select(F.col("id").alias("a"), F.lit("some text").alias("b"))
    rows.coalesce(1).write.option("header", "true").csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        schema = schemas.columns(a=schemas.LONG, b=schemas.TEXT)
        tasks = [scan_csv(spark, path, schema, quoted_newlines=q).rdd.getNumPartitions() for q in (True, False)]
        assert tasks[0] == 1 and tasks[1] > 2
        assert scan_csv(spark, path, schema, quoted_newlines=False).agg({"a": "sum"}).first()[0] == sum(range(20000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lake_keeps_plays_that_differ_only_in_their_place(spark, tmp_path, raw_files):
    play = ("E1", 1541106106796, "8", "free", 139, 1, "Beta", "Bob", 55.5, "NextSong")
    rows = list(event_rows([play, (*play[:5], 2, *play[6:]), play]))
    spark.createDataFrame(rows, schemas.RAW_EVENT).write.json(str(tmp_path / "twice"))
    output = str(tmp_path / "star")
    plans.run(spark, replace(raw_files, events=str(tmp_path / "twice")), output, plans.LAKE)
    assert counts(spark, output)["songplays"] == 2


def test_loading_the_same_again_with_checks(spark, tmp_path, raw_files, raw_events):
    undated = raw_events.limit(1).withColumn("ts", F.lit(None).cast("long")).withColumn("page", F.lit("NextSong"))
    undated.write.mode("append").json(raw_files.events)
    output = str(tmp_path / "star")
    for n in (1, 2, 3):
        plans.run(spark, raw_files, output, replace(plans.UPSERT, check=True))
        assert counts(spark, output) == {"songplays": 6 * n, "users": 2, "songs": 5, "artists": 3, "time": 5}
    assert plans.read_table(spark, output, "songplays").filter("start_time IS NULL").count() == 3


def test_an_absurd_length_is_null_and_ends_nothing(spark, tmp_path, raw_files):
    play = ("E1", 1541106106796, "8", "free", 139, 1, "Beta", "Bob", 1e14, "NextSong")
    spark.createDataFrame(list(event_rows([play])), schemas.RAW_EVENT).write.json(str(tmp_path / "odd"))
    for profile in plans.PROFILES.values():
        output = str(tmp_path / profile.name)
        plans.run(spark, replace(raw_files, events=str(tmp_path / "odd")), output, profile)
        assert counts(spark, output)["songplays"] >= 1


@pytest.mark.parametrize("name", sorted(plans.PROFILES))
def test_catalog_tables_take_what_a_load_gives(spark, tmp_path, raw_files, name):
    profile, output = plans.PROFILES[name], str(tmp_path / "star")
    plans.run(spark, raw_files, output, profile)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS star_{name}")
    try:
        plans.recreate_star(spark, profile, f"star_{name}")
        for _ in range(2):
            plans.load_catalog(spark, output, profile, f"star_{name}")
        for table in TABLES:
            stored = spark.table(f"star_{name}.{table}")
            loaded = plans.read_table(spark, output, table)
            assert sorted(stored.columns) == sorted(loaded.columns)
            assert rows_of(stored.select(*loaded.columns)) == rows_of(loaded)
    finally:
        spark.sql(f"DROP DATABASE star_{name} CASCADE")


def test_columns_that_a_table_lacks_raise(spark):
    spark.sql("CREATE TABLE narrow (a INT) USING parquet")
    try:
        wide = spark.createDataFrame([(1, 2)], "a int, b int")
        with pytest.raises(ValueError, match="no column b"):
            tables.insert_by_name(wide, "narrow")
        tables.insert_by_name(wide, "narrow", drop=["b"])
        assert rows_of(spark.table("narrow")) == [(1,)]
    finally:
        spark.sql("DROP TABLE narrow")


@pytest.fixture
def arriving(spark, tmp_path):
    """Three files, the latest events first."""
    folder = tmp_path / "arriving"
    for i, chunk in enumerate((EVENTS[4:], EVENTS[2:4], EVENTS[:2])):
        df = spark.createDataFrame(list(event_rows(chunk)), schemas.RAW_EVENT)
        df.coalesce(1).write.json(str(folder / str(i)))
    (folder / "broken.json").write_text('{"page": "NextSong", "ts": 15411')
    return str(folder)


def incremental(spark, tmp_path, raw_songs):
    star = IncrementalStar(str(tmp_path / "inc"), plans.STAGED_LEFT, schemas.STAGED_EVENT)
    return star, star.loader(raw_songs, build_catalogue(raw_songs, plans.STAGED_LEFT))


def load(spark, source, tmp_path, apply_batch):
    checkpoint = str(tmp_path / "checkpoint")
    load_available(
        spark,
        source,
        schemas.RAW_EVENT,
        checkpoint,
        apply_batch,
        max_files=1,
        glob="*.json",
        corrupt_column="corrupt_record",
    )


def test_incremental_load_equals_one_load(spark, tmp_path, raw_songs, raw_files, arriving):
    star, apply_batch = incremental(spark, tmp_path, raw_songs)
    load(spark, arriving, tmp_path, apply_batch)
    plans.run(spark, raw_files, str(tmp_path / "whole"), plans.STAGED_LEFT)
    assert rows_of(star.songplays(spark)) == rows_of(
        plans.read_table(spark, str(tmp_path / "whole"), "songplays")
    )
    assert rows_of(star.time(spark)) == rows_of(
        plans.read_table(spark, str(tmp_path / "whole"), "time")
    )
    levels = {r.user_id: r.level for r in star.users(spark).collect()}
    assert levels == {8: "paid", 10: "free"}
    assert rows_of(star.rejected(spark)) == [('{"page": "NextSong", "ts": 15411',)]

    # Nothing new: nothing changes. A batch that comes again replaces itself.
    before = rows_of(star.songplays(spark)), rows_of(star.users(spark))
    load(spark, arriving, tmp_path, apply_batch)
    first = spark.read.schema(schemas.STAGED_EVENT).parquet(f"{star.root}/staging/batch_id=0")
    first = first.select(*schemas.STAGED_EVENT.names)
    apply_batch(spark.createDataFrame(first.collect(), first.schema), 0)
    assert (rows_of(star.songplays(spark)), rows_of(star.users(spark))) == before


def test_compaction_and_later_batches(spark, tmp_path, raw_songs, arriving):
    star, apply_batch = incremental(spark, tmp_path, raw_songs)
    load(spark, arriving, tmp_path, apply_batch)
    before = rows_of(star.users(spark))
    star.compact_users(spark, through=1)
    assert rows_of(star.users(spark)) == before
    star.compact_users(spark, through=0)
    star.compact_users(spark, through=3)
    assert rows_of(star.users(spark)) == before

    more = [("E9", 1541400000000, "8", "free", 200, 0, "Beta", "Bob", 55.5, "NextSong")]
    df = spark.createDataFrame(list(event_rows(more)), schemas.RAW_EVENT)
    df.coalesce(1).write.json(f"{arriving}/later")
    load(spark, arriving, tmp_path, apply_batch)
    levels = {r.user_id: r.level for r in star.users(spark).collect()}
    assert levels == {8: "free", 10: "free"}


def test_songs_that_arrive_and_checks(spark, tmp_path, raw_songs, arriving):
    star = IncrementalStar(str(tmp_path / "inc"), plans.STAGED_LEFT, schemas.STAGED_EVENT, checked=True)
    songs = str(tmp_path / "songs-arriving")
    raw_songs.filter("song_id < 'S3'").write.json(f"{songs}/first")
    load_available(spark, songs, schemas.RAW_SONG, str(tmp_path / "c1"), star.song_loader(spark))
    load(spark, arriving, tmp_path, star.loader(spark=spark))
    assert {r.song_id for r in star.songplays(spark).collect()} == {"S1", None}
    raw_songs.write.json(f"{songs}/second")
    load_available(spark, songs, schemas.RAW_SONG, str(tmp_path / "c1"), star.song_loader(spark))
    assert star.songs(spark).count() == 5 and star.artists(spark).count() == 3
    reports = star.reports(spark)
    assert {r.batch_id for r in reports.collect()} == {0, 1, 2, 3}

    before = rows_of(star.songplays(spark)), rows_of(star.time(spark)), rows_of(star.users(spark))
    star.compact(spark, through=1)
    gone = star.vacuum(spark)
    assert {"songplays/batch_id=0", "time/batch_id=1", "users/batch_id=0"} <= set(gone)
    star.compact(spark, through=2)
    star.vacuum(spark)
    assert (rows_of(star.songplays(spark)), rows_of(star.time(spark)), rows_of(star.users(spark))) == before
    with pytest.raises(ValueError):
        star.loader()


def test_a_batch_that_fails_its_checks_ends_the_load(spark, tmp_path, arriving):
    star = IncrementalStar(str(tmp_path / "inc"), plans.STAGED_LEFT, schemas.STAGED_EVENT, checked=True)
    songs = str(tmp_path / "no-songs")
    spark.createDataFrame([], schemas.RAW_SONG).coalesce(1).write.json(f"{songs}/first")
    (tmp_path / "no-songs" / "empty.json").write_text("\n")
    load_available(spark, songs, schemas.RAW_SONG, str(tmp_path / "c1"), star.song_loader(spark))
    with pytest.raises(Exception, match="not_empty"):
        load(spark, arriving, tmp_path, star.loader(spark=spark))


def test_incremental_needs_repeatable_keys():
    with pytest.raises(ValueError):
        IncrementalStar("/nowhere", plans.UPSERT, schemas.STAGED_EVENT)


def test_numbers_are_counted_exactly(spark):
    """Repeated, absent, negative and far numbers; none at all."""
    ids = [0, 1, 63, 64, 64, None, -1, -64, 5, (1 << 33) + 5, (1 << 62) + 1, (1 << 62) + 1]
    rows = spark.createDataFrame([(each,) for each in ids], "songplay_id long")
    for some in (rows, rows.filter("false")):
        for dense, last in ((True, F.max("songplay_id")), (False, F.count(F.lit(1)))):
            plain = some.agg(F.lit("songplay_id"), F.countDistinct("songplay_id"), last.cast("string"))
            assert [tuple(row) for row in numbers(some, dense).collect()] == [tuple(plain.first())]
    shuffled = numbers(spark.range(0, 10_000, 1, 1).withColumnRenamed("id", "songplay_id"), True)
    assert "bit_or" in plan_of(shuffled)


def test_the_log_and_each_batch_are_made_without_broadcasts(spark, tmp_path, raw_songs):
    part = "id AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 't' AS p_type, 3 AS p_size, 1.5D AS p_retailprice"
    spark.range(9).selectExpr(*part.split(", ")).write.parquet(str(tmp_path / "part.parquet"))
    customer = "id AS c_custkey, 'c' AS c_name, 1 AS c_nationkey, 'm' AS c_mktsegment"
    spark.range(9).selectExpr(*customer.split(", ")).write.parquet(str(tmp_path / "customer.parquet"))
    event = "id AS event_id, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts, id AS user_id, 'purchase' AS event_type, 1D AS value, '{}' AS props"
    spark.range(12).selectExpr(*event.split(", ")).write.parquet(str(tmp_path / "events.parquet"))
    events = raw_events(spark, str(tmp_path), ("names", "artist"))
    assert "Broadcast" not in plan_of(events) and events.count() == 12
    raw_songs.write.parquet(str(tmp_path / "songs"))
    songs, profile = spark.read.parquet(str(tmp_path / "songs")), plans.STAGED_LEFT
    star = IncrementalStar(str(tmp_path / "star"), profile, schemas.STAGED_EVENT)
    conform(raw_events(spark, str(tmp_path)), schemas.STAGED_EVENT).write.parquet(str(tmp_path / "staged"))
    staged = spark.read.parquet(str(tmp_path / "staged"))
    keys = [key.of_event().alias(name) for name, key in zip(star._keys, profile.match_keys)]
    marked = staged.select("*", *keys, F.lit(0).alias("_batch"), F.lit(0).alias("_play"))
    assert "Broadcast" not in plan_of(star._matched(marked, songs, build_catalogue(songs, profile)))
