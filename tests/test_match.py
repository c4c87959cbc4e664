import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators import dims
from starloom.operators.match import (
    ARTIST,
    LENGTH,
    ROUNDED_LENGTH,
    TITLE,
    WHOLE_LENGTH,
    distinct_matches,
    join_catalogue,
    join_time,
    match,
)
from starloom.operators.skew import hot_keys, join_spreading_hot_keys
from tests.conftest import plan_of, rows_of


def matches(df):
    found = {}
    for row in df.select("userAgent", "song_id").collect():
        found.setdefault(row.userAgent.removeprefix("agent "), []).append(row.song_id)
    return {event: sorted(songs, key=str) for event, songs in sorted(found.items())}


def test_title_only_repeats_events(plays, raw_songs):
    every = ["S1", "S2", "S3"]
    assert matches(match(plays, raw_songs, [TITLE])) == {
        "E1": every, "E2": every, "E3": ["S4"], "E4": every
    }


def test_title_and_artist(plays, raw_songs):
    assert matches(match(plays, raw_songs, [ARTIST, TITLE])) == {
        "E1": ["S1", "S3"], "E2": ["S1", "S3"], "E3": ["S4"]
    }


@pytest.mark.parametrize(
    "length, e1, e2",
    [
        (LENGTH, ["S1"], [None]),
        (WHOLE_LENGTH, ["S1", "S3"], ["S1", "S3"]),
        (ROUNDED_LENGTH, ["S1"], ["S1"]),
    ],
)
def test_three_keys_at_each_precision(plays, raw_songs, length, e1, e2):
    found = matches(match(plays, raw_songs, [TITLE, ARTIST, length], "left"))
    assert found == {"E1": e1, "E2": e2, "E3": ["S4"], "E4": [None], "E5": [None]}


def test_first_match_keeps_every_event_once(plays, raw_songs):
    keys = [TITLE, ARTIST, WHOLE_LENGTH]
    found = matches(match(plays, raw_songs, keys, "left", duplicates="first"))
    assert found == {"E1": ["S1"], "E2": ["S1"], "E3": ["S4"], "E4": [None], "E5": [None]}


def test_first_match_through_the_dimensions(plays, raw_songs):
    named = join_catalogue(dims.songs_first(raw_songs), dims.artists_upsert(raw_songs))
    found = matches(match(plays, named, [TITLE, ARTIST, LENGTH], "left", "first"))
    assert found["E1"] == ["S1"] and found["E2"] == [None] and len(found) == 5


def test_missing_keys_match_nothing(spark, events, raw_songs):
    nameless = raw_songs.withColumn("title", raw_songs.title.substr(99, 1))
    none = spark.createDataFrame([(None,)], "title string").crossJoin(raw_songs.drop("title").limit(1))
    assert match(events, nameless.unionByName(none), [TITLE]).count() == 0
    assert match(events, raw_songs, [TITLE], "left").filter("page = 'Home'").count() == 1


def test_arguments_are_checked(plays, raw_songs):
    with pytest.raises(ValueError):
        match(plays, raw_songs, [TITLE], how="outer")
    with pytest.raises(ValueError):
        match(plays, raw_songs, [TITLE], duplicates="any")
    with pytest.raises(ValueError):
        match(plays, raw_songs, [TITLE], add=["level"])


def test_time_join_adds_the_calendar(plays, raw_songs):
    from starloom.functions import start_time

    fact = match(plays, raw_songs, [TITLE]).select("song_id", start_time("ts").alias("start_time"))
    joined = join_time(fact, dims.time_dim(plays, "plays"))
    assert joined.count() == fact.count()
    assert {(r.year, r.month) for r in joined.collect()} == {(2018, 11)}


@pytest.fixture
def skewed(spark):
    """A third of the left rows share one key; some have none."""
    left = spark.range(900).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('k', id % 40) END AS k"
    )
    right = spark.range(60).selectExpr("concat('k', id % 30) AS k", "id AS r")
    return left, right.unionByName(spark.sql("SELECT 'hot' AS k, 7000L AS r UNION ALL SELECT 'hot', 7001L"))


def test_hot_keys_are_few_and_right(skewed):
    left, _ = skewed
    assert rows_of(hot_keys(left, ["k"], 0.3).select("k")) == [("hot",)]
    assert hot_keys(left, ["k"], 1.0).count() == 0
    assert hot_keys(left.filter("false"), ["k"], 0.5).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(skewed, how):
    left, right = skewed
    plain = left.join(right, "k", how)
    spread = join_spreading_hot_keys(left, right, ["k"], how, share=0.1, spread=8)
    assert rows_of(spread.select("k", "id", "r")) == rows_of(plain.select("k", "id", "r"))


def test_spread_join_deals_copies_out(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(0, 300, 1, 10).selectExpr("IF(id < 200, 'hot', 'k') AS k", "1 AS v")
        right = spark.sql("SELECT 'hot' AS k, 1 AS r")
        spread = join_spreading_hot_keys(left, right, ["k"], share=0.5, spread=16)
        used = spread.selectExpr("spark_partition_id() AS p").distinct().count()
        assert spread.count() == 200 and used > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


TEXTS = st.one_of(st.none(), st.sampled_from(["a", "b", ""]))
LENGTHS = st.one_of(st.none(), st.sampled_from([1.0, 1.4, 1.5, 2.0, 2.49]))


def comparable(length, key):
    if length is None:
        return None
    if key is LENGTH:
        return round(length, 5)
    return int(length) if key is WHOLE_LENGTH else int(length + 0.5)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(TEXTS, TEXTS, LENGTHS), max_size=8),
    st.lists(st.tuples(TEXTS, TEXTS, LENGTHS, st.integers(0, 3)), max_size=8),
    st.sampled_from([LENGTH, WHOLE_LENGTH, ROUNDED_LENGTH]),
    st.sampled_from(["inner", "left"]),
    st.sampled_from(["all", "first"]),
)
def test_match_against_brute_force(spark, played, listed, length, how, duplicates):
    expected = []
    for number, (song, artist, seconds) in enumerate(played):
        mine = (song, artist, comparable(seconds, length))
        hits = sorted(
            i for t, a, d, i in listed if None not in mine and mine == (t, a, comparable(d, length))
        )
        if duplicates == "first":
            hits = hits[:1]
        expected += [(number, hit) for hit in hits]
        if not hits and how == "left":
            expected.append((number, None))
    events = spark.createDataFrame(
        [(n, *row) for n, row in enumerate(played)], "n int, song string, artist string, length double"
    )
    songs = spark.createDataFrame(
        listed, "title string, artist_name string, duration double, song_id int"
    )
    found = match(events, songs, [TITLE, ARTIST, length], how, duplicates, add=["song_id"])
    assert rows_of(found.select("n", "song_id")) == sorted(expected, key=repr)


def test_spread_join_deals_the_hot_key_over_partitions(spark, skewed):
    left, right = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = join_spreading_hot_keys(left, right, ["k"], share=0.1, spread=16)
        used = spread.filter("k = 'hot'").selectExpr("spark_partition_id() AS p").distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert used > 1


def test_spreading_matches_like_no_spreading(plays, raw_songs):
    for keys, how in (([TITLE], "inner"), ([TITLE, ARTIST], "left")):
        plain = match(plays, raw_songs, keys, how)
        spread = match(plays, raw_songs, keys, how, hot_share=0.2)
        assert rows_of(spread) == rows_of(plain)


@pytest.mark.parametrize("keys", [[TITLE], [TITLE, WHOLE_LENGTH]])
@pytest.mark.parametrize("twice", [False, True])
def test_distinct_matches(spark, plays, raw_songs, keys, twice):
    """Also where one song is listed under two titles that one user played."""
    songs = raw_songs
    if twice:
        beta = raw_songs.filter("title = 'Beta'").withColumn("song_id", F.lit("S1"))
        songs = songs.unionByName(beta.withColumn("artist_id", F.lit("A1"))).unionByName(raw_songs)
    plain = match(plays, songs, keys).select("userId", "sessionId", "song_id", "artist_id").distinct()
    less = match(plays, songs, keys).select("userId", "song_id", "artist_id").distinct()
    by_session = distinct_matches(plays, songs, keys, ["userId", "sessionId"])
    assert rows_of(by_session) == rows_of(plain)
    assert rows_of(distinct_matches(plays, songs, keys, ["userId"])) == rows_of(less)


def test_large_sides_are_not_broadcast(spark, plays, raw_songs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(match(plays, raw_songs, [TITLE, ARTIST, LENGTH], "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert "Broadcast" not in plan and "Cartesian" not in plan


def test_spread_join_gets_partitions_for_the_rows_it_makes(spark):
    """Few rows go in and many come out, most of them from keys below the share."""
    left = spark.range(200).selectExpr("concat('k', id % 4) AS k", "id")
    right = spark.range(200).selectExpr("concat('k', id % 4) AS k", "id AS r")
    spread = join_spreading_hot_keys(left, right, ["k"], share=0.9, spread=2, rows_per_task=500)
    assert rows_of(spread.select("k", "id", "r")) == rows_of(left.join(right, "k").select("k", "id", "r"))
    made = [row["count"] for row in spread.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(made) == 10_000 and len(made) > 8 and max(made) <= 2_500
