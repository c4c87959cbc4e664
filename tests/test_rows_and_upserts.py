import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starloom.operators import dims
from starloom.operators.rows import distinct_rows, non_empty, plays_only, with_keys
from starloom.operators.upsert import (
    first_by_key,
    insert_absent,
    last_by_key,
    merge_states,
    merge_upsert,
    upsert_rows,
    upsert_state,
)
from starloom.operators.upsert import rows_of as state_rows
from tests.conftest import plan_of, rows_of


def test_filters(spark, events):
    assert plays_only(events).count() == 5
    assert with_keys(events, "userId").count() == 5
    assert non_empty(events, "artist").count() == 5
    blank = spark.createDataFrame([("",), (None,), ("x",)], "a string")
    assert rows_of(non_empty(blank, "a")) == [("x",)]


def test_users_distinct_and_upserted(plays):
    kay, syl = ("Kay", "Sun", "F"), ("Syl", "Cruz", "F")
    assert rows_of(dims.users_distinct(plays)) == [
        (10, *syl, "free"), (8, *kay, "free"), (8, *kay, "paid")
    ]
    assert rows_of(dims.users_upsert(plays)) == [(10, *syl, "free"), (8, *kay, "paid")]


def test_user_without_id_is_dropped_only_if_asked(events):
    assert dims.users_distinct(events, require_id=False).filter("user_id IS NULL").count() == 1
    assert dims.users_distinct(events).filter("user_id IS NULL").count() == 0


def test_songs_and_artists(spark, raw_songs):
    again = raw_songs.unionByName(
        spark.createDataFrame(
            [(1, "A1", 1.5, 2.5, "moved", "Ann B", "S9", "Alpha", 3.0, 2005),
             (1, "A1", 1.5, 2.5, "moved", "Ann B", "S4", "Zeta", 3.0, 2005)],
            raw_songs.schema,
        )
    )
    assert dims.songs_distinct(again).count() == 7
    assert dims.songs_first(again).count() == 6
    assert dims.songs_first(again).filter("song_id = 'S4'").first().title == "Beta"
    assert dims.artists_distinct(again).count() == 4
    ann = dims.artists_upsert(again).filter("artist_id = 'A1'").first()
    # The name stays, the rest moves with the last song.
    assert (ann.name, ann.location, ann.latitude, ann.longitude) == ("Ann", "moved", 1.5, 2.5)


def test_projection_precedes_duplicate_removal(spark, tmp_path, raw_songs):
    raw_songs.write.parquet(str(tmp_path / "songs"))
    plan = plan_of(dims.songs_distinct(spark.read.parquet(str(tmp_path / "songs"))))
    assert "artist_location" not in plan


def test_distinct_rows(events):
    assert distinct_rows(events.unionAll(events)).count() == 6


ROWS = st.lists(
    st.tuples(
        st.integers(0, 3), st.integers(0, 4), st.sampled_from("ab"), st.one_of(st.none(), st.sampled_from("xyz"))
    ),
    max_size=12,
)


def key_of(value):
    return [(part is not None, part) for part in value]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS)
def test_upserts_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, a string, b string")
    first, last, upserted = {}, {}, {}
    for k in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == k]
        first[k], last[k] = min(mine, key=key_of), max(mine, key=key_of)
        kept = min(mine, key=lambda r: key_of((r[0], r[1])))[1]
        updated = max(mine, key=lambda r: key_of((r[0], r[2])))[2]
        upserted[k] = (kept, updated)
    assert rows_of(first_by_key(df, ["k"], ["t"])) == sorted(((k, *v) for k, v in first.items()), key=repr)
    assert rows_of(last_by_key(df, ["k"], ["t"])) == sorted(((k, *v) for k, v in last.items()), key=repr)
    found = upsert_rows(df, ["k"], ["a"], ["b"], ["t"])
    assert rows_of(found) == sorted(((k, *v) for k, v in upserted.items()), key=repr)


def test_states_merge_in_any_grouping(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(5), t, rng.choice("ab"), rng.choice("xyz"), rng.randrange(4)) for t in range(80)]
    df = spark.createDataFrame(rows, "k int, t int, a string, b string, batch int")
    whole = upsert_rows(df, ["k"], ["a"], ["b"], ["t"])
    states = upsert_state(df, ["k", "batch"], ["a"], ["b"], ["t"]).drop("batch")
    merged = state_rows(merge_states(states, ["k"]), ["k"], ["a"], ["b"])
    assert rows_of(merged) == rows_of(whole)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("1 AS k", "id AS t", "'a' AS a", "'b' AS b")
    plan = plan_of(upsert_rows(df, ["k"], ["a"], ["b"], ["t"]), "simple")
    assert "partial_min" in plan and "partial_max" in plan


@pytest.fixture
def existing(spark):
    return spark.createDataFrame([(1, "one", "free"), (2, "two", "free")], "id int, name string, level string")


@pytest.fixture
def incoming(spark):
    return spark.createDataFrame([(2, "zwei", "paid"), (3, "three", "paid")], "id int, name string, level string")


def test_merge_into_existing(existing, incoming):
    assert rows_of(merge_upsert(existing, incoming, ["id"], ["level"])) == [
        (1, "one", "free"), (2, "two", "paid"), (3, "three", "paid")
    ]


def test_update_to_null_is_an_update(spark, existing):
    gone = spark.createDataFrame([(1, None, None)], existing.schema)
    assert rows_of(merge_upsert(existing, gone, ["id"], ["level"]))[0] == (1, "one", None)


def test_insert_if_absent(existing, incoming):
    assert rows_of(insert_absent(existing, incoming, ["id"])) == [(3, "three", "paid")]
    assert rows_of(insert_absent(existing, incoming, ["id"], within="id")) == [(3, "three", "paid")]
    assert insert_absent(existing, incoming.filter("false"), ["id"], within="id").count() == 0
