"""Dimension builds, row filters and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import dims
from starloom.operators.rows import distinct_rows, non_empty, plays_only, with_keys
from starloom.operators.upsert import (
    first_by_key,
    insert_absent,
    merge_states,
    merge_upsert,
    rows_of,
    upsert_rows,
    upsert_state,
)
from starloom.sources import preview
from starloom.workloads.registry import query
from starloom.workloads.standin import (
    EVENTS_SQL,
    PLAY,
    PLAYS_SQL,
    SONGS_SQL,
    plays,
    raw_events,
    raw_songs,
    table,
)

SEEN = "struct_pack(a := ts, b := event_id)"


@query(f"SELECT event_id, ts, user_id, value FROM events WHERE event_type = '{PLAY}'")
def filter_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "page")
    return plays_only(events, PLAY).select("event_id", "ts", "user_id", "value")


@query(
    f"""
WITH {EVENTS_SQL}
SELECT event_id, artist FROM ev WHERE artist IS NOT NULL AND artist <> ''"""
)
def filter_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return non_empty(raw_events(spark, sf_dir, ("artist",)), "artist").select("event_id", "artist")


@query(
    f"""
WITH {PLAYS_SQL}
SELECT DISTINCT userid AS user_id, firstname AS first_name, lastname AS last_name, gender, level
FROM plays WHERE userid IS NOT NULL"""
)
def dim_users_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.users_distinct(plays(spark, sf_dir, ("names",)))


@query(
    f"""
WITH {PLAYS_SQL}
SELECT userid AS user_id, min(firstname) AS first_name, min(lastname) AS last_name,
       min(gender) AS gender,
       arg_max(level, struct_pack(a := ts, b := sessionid, c := iteminsession, d := level)) AS level
FROM plays GROUP BY userid"""
)
def dim_users_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.users_upsert(plays(spark, sf_dir, ("names",)))


@query(f"WITH {SONGS_SQL} SELECT DISTINCT song_id, title, artist_id, year, duration FROM songs")
def dim_songs_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.songs_distinct(raw_songs(spark, sf_dir))


@query(
    """
SELECT song_id, title, artist_id, year, duration FROM (
  SELECT p_name || p_brand AS song_id, p_name AS title, p_brand AS artist_id, p_size AS year,
         p_retailprice AS duration, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) AS n
  FROM part
) WHERE n = 1"""
)
def dim_songs_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    songs = table(spark, sf_dir, "part").select(
        F.concat("p_name", "p_brand").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_size").alias("year"),
        F.col("p_retailprice").alias("duration"),
        "p_partkey",
    )
    return first_by_key(songs, ["song_id"], ["p_partkey"]).drop("p_partkey")


@query(
    f"""
WITH {SONGS_SQL}
SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
       artist_latitude AS latitude, artist_longitude AS longitude
FROM songs"""
)
def dim_artists_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.artists_distinct(raw_songs(spark, sf_dir))


@query(
    f"""
WITH {SONGS_SQL}
SELECT artist_id, min(artist_name) AS name, arg_max(artist_location, song_id) AS location,
       arg_max(artist_latitude, song_id) AS latitude, arg_max(artist_longitude, song_id) AS longitude
FROM songs GROUP BY artist_id"""
)
def dim_artists_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.artists_upsert(raw_songs(spark, sf_dir))


@query(
    """
SELECT event_id, user_number FROM (
  SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_number FROM events
) WHERE user_number IS NOT NULL"""
)
def dim_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events have an empty user, as when nobody is logged in."""
    user = F.when(F.col("event_type") == "error", "").otherwise(F.col("user_id").cast("string"))
    events = table(spark, sf_dir, "events").select(
        "event_id", user.try_cast("long").alias("user_number")
    )
    return with_keys(events, "user_number")


@query("SELECT DISTINCT * FROM (SELECT * FROM events UNION ALL SELECT * FROM events)")
def dedup_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return distinct_rows(events.unionAll(events))


@query("SELECT DISTINCT text, lang, source FROM documents")
def dedup_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of long rows."""
    return distinct_rows(table(spark, sf_dir, "documents").select("text", "lang", "source"))


@query(
    f"""
SELECT user_id, arg_min(event_type, {SEEN}) AS first_type, arg_min(props, {SEEN}) AS first_props,
       arg_max(event_type, {SEEN}) AS last_type, arg_max(value, {SEEN}) AS last_value
FROM events GROUP BY user_id"""
)
def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id",
        F.col("event_type").alias("first_type"),
        F.col("props").alias("first_props"),
        F.col("event_type").alias("last_type"),
        F.col("value").alias("last_value"),
        "ts",
        "event_id",
    )
    return upsert_rows(
        events, ["user_id"], ["first_type", "first_props"], ["last_type", "last_value"], ["ts", "event_id"]
    )


@query(
    f"""
SELECT user_id, arg_min(event_id, {SEEN}) AS event_id, arg_min(event_type, {SEEN}) AS event_type,
       arg_min(value, {SEEN}) AS value, arg_min(ts, {SEEN}) AS ts
FROM events GROUP BY user_id"""
)
def upsert_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return first_by_key(events, ["user_id"], ["ts", "event_id"])


MERGED_SQL = f"""
SELECT user_id, arg_min(props, {SEEN}) AS first_props, arg_max(event_type, {SEEN}) AS last_type
FROM events GROUP BY user_id"""


@query(MERGED_SQL)
def upsert_merge_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of each event type merged: the same as one upsert of all events."""
    events = table(spark, sf_dir, "events").select(
        "user_id",
        F.col("props").alias("first_props"),
        F.col("event_type").alias("last_type"),
        "event_type",
        "ts",
        "event_id",
    )
    keep, update = ["first_props"], ["last_type"]
    states = upsert_state(events, ["user_id", "event_type"], keep, update, ["ts", "event_id"])
    merged = merge_states(states.drop("event_type"), ["user_id"])
    return rows_of(merged, ["user_id"], keep, update)


@query(
    """
SELECT coalesce(c.user_id, e.user_id) AS user_id, coalesce(c.name, 'new') AS name,
       coalesce(e.balance, c.balance) AS balance
FROM (SELECT c_custkey AS user_id, c_name AS name, c_acctbal AS balance FROM customer) c
FULL JOIN (SELECT user_id * 20 AS user_id, max(value) AS balance FROM events GROUP BY 1) e
  ON c.user_id = e.user_id"""
)
def upsert_into_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some events' users are customers, some are not: balances change, names stay."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    incoming = (
        table(spark, sf_dir, "events")
        .groupBy((F.col("user_id") * 20).alias("user_id"))
        .agg(F.lit("new").alias("name"), F.max("value").alias("balance"))
    )
    return merge_upsert(customers, incoming, ["user_id"], ["balance"])


@query(
    """
SELECT DISTINCT user_id * 20 AS user_id FROM events
WHERE user_id * 20 NOT IN (SELECT c_custkey FROM customer)"""
)
def insert_absent_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    incoming = (
        table(spark, sf_dir, "events").select((F.col("user_id") * 20).alias("user_id")).distinct()
    )
    return insert_absent(customers, incoming, ["user_id"])


@query("SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts, event_id LIMIT 5")
def preview_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return preview(events, ["ts", "event_id"], 5)
