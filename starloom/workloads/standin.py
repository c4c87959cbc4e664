"""The test tables in the shape of a song catalogue and an event log.

- ``part`` is the catalogue: name, brand and size = title (the smallest sizes have
  the name alone, so that a few titles are common), brand = artist, retail price =
  duration. The artist's name differs from its id.
- ``events`` is the log: ``purchase`` = play. The part numbered ``props.k`` gives
  its song, length and location, the part numbered like the user its artist, so
  only some plays match a song on title and artist.
- ``customer`` gives the users' names; the level follows from ``value``.
- ``lineitem`` with ``orders`` is a second, larger log: order = session, line
  number = item in session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.timeparts import epoch_ms
from starloom.operators.rows import plays_only

PLAY = "purchase"

# The same in SQL; ``ev`` and ``songs`` are the staged tables.
TITLE_SQL = "CASE WHEN {0}p_size <= 2 THEN {0}p_name ELSE {0}p_name || ' ' || {0}p_brand || ' ' || {0}p_size END"
ARTIST_SQL = "'The ' || {0}p_brand"
EVENTS_SQL = f"""
ev AS (
  SELECT {ARTIST_SQL.format('a.')} AS artist, 'Logged In' AS auth, c.c_name AS firstname,
         CAST(c.c_nationkey AS VARCHAR) AS gender,
         hour(e.ts) * 3600 + minute(e.ts) * 60 + second(e.ts) AS iteminsession,
         c.c_mktsegment AS lastname, s.p_retailprice AS length,
         CASE WHEN e.value >= 20 THEN 'paid' ELSE 'free' END AS level,
         s.p_type AS location, e.event_type AS page,
         e.user_id * 31 + day(e.ts) - 1 AS sessionid, {TITLE_SQL.format('s.')} AS song,
         epoch_us(e.ts) // 1000 AS ts, e.props AS useragent, e.user_id AS userid,
         e.event_id
  FROM events e
  LEFT JOIN part s ON s.p_partkey = CAST(json_extract_string(e.props, '$.k') AS BIGINT)
  LEFT JOIN part a ON a.p_partkey = e.user_id
  LEFT JOIN customer c ON c.c_custkey = e.user_id
)"""
PLAYS_SQL = f"{EVENTS_SQL}, plays AS (SELECT * FROM ev WHERE page = '{PLAY}')"
SONGS_SQL = f"""
songs AS (
  SELECT CAST(p_partkey AS VARCHAR) AS song_id, {TITLE_SQL.format('')} AS title, p_brand AS artist_id,
         {ARTIST_SQL.format('')} AS artist_name, p_type AS artist_location, CAST(p_size AS DOUBLE) AS artist_latitude,
         p_retailprice AS artist_longitude, p_retailprice AS duration, p_size AS year
  FROM part
)"""
BOTH_SQL = f"{PLAYS_SQL}, {SONGS_SQL}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def title() -> Column:
    whole = F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string"))
    return F.when(F.col("p_size") <= 2, F.col("p_name")).otherwise(whole)


def artist_name() -> Column:
    return F.concat(F.lit("The "), F.col("p_brand"))


def raw_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.lit(1).alias("num_songs"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_size").cast("double").alias("artist_latitude"),
        F.col("p_retailprice").alias("artist_longitude"),
        F.col("p_type").alias("artist_location"),
        artist_name().alias("artist_name"),
        F.col("p_partkey").cast("string").alias("song_id"),
        title().alias("title"),
        F.col("p_retailprice").alias("duration"),
        F.col("p_size").alias("year"),
    )


SIDES = ("names", "song", "artist")


def raw_events(spark: SparkSession, sf_dir: str, sides: tuple[str, ...] = SIDES) -> DataFrame:
    """The log in the staged columns, plus ``event_id``.

    ``sides`` names the tables that add columns to an event: the user's names,
    the song's title, length and location, the artist.
    """
    events = events_only(spark, sf_dir)
    part = table(spark, sf_dir, "part")
    if "names" in sides:
        events = with_names(events, spark, sf_dir)
    if "song" in sides:
        song = part.select(
            F.col("p_partkey").alias("_song"),
            title().alias("song"),
            F.col("p_retailprice").alias("length"),
            F.col("p_type").alias("location"),
        )
        # Only parts that events name: few meet many, and few are cheap to send.
        song = song.join(events.select("_song").distinct(), "_song", "left_semi")
        events = events.join(song, "_song", "left")
    if "artist" in sides:
        artist = part.select(F.col("p_partkey").alias("userId"), artist_name().alias("artist"))
        # As many as parts: a broadcast would bring them all to the driver.
        events = events.join(artist.hint("merge"), "userId", "left")
    return events.drop("_song")


def events_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's own columns, under their staged names."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.lit("Logged In").alias("auth"),
        (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).alias("itemInSession"),
        F.when(F.col("value") >= 20, "paid").otherwise("free").alias("level"),
        F.lit("PUT").alias("method"),
        F.col("event_type").alias("page"),
        F.lit(None).cast("long").alias("registration"),
        (F.col("user_id") * 31 + F.dayofmonth("ts") - 1).alias("sessionId"),
        F.lit(200).alias("status"),
        epoch_ms("ts").alias("ts"),
        F.col("props").alias("userAgent"),
        F.col("user_id").alias("userId"),
        F.get_json_object("props", "$.k").try_cast("long").alias("_song"),
    )


def with_names(events: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("userId"),
        F.col("c_name").alias("firstName"),
        F.col("c_mktsegment").alias("lastName"),
        F.col("c_nationkey").cast("string").alias("gender"),
    )
    # As many as customers: a broadcast would bring them all to the driver.
    return events.join(users.hint("merge"), "userId", "left")


def plays(
    spark: SparkSession, sf_dir: str, sides: tuple[str, ...] = ("song", "artist")
) -> DataFrame:
    return plays_only(raw_events(spark, sf_dir, sides), PLAY)


def listens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in the columns of the staged listening file, plus what orders them."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_extendedprice",
        "l_returnflag",
        "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    users = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").cast("string").alias("gender")
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    # Names meet the orders first: there are fewer of them than lines.
    named = orders.join(users, F.col("o_custkey") == F.col("c_custkey"))
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        named, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select(
        F.col("p_brand").alias("artist"),
        F.col("c_name").alias("firstName"),
        "gender",
        F.col("l_linenumber").alias("itemInSession"),
        F.col("c_mktsegment").alias("lastName"),
        F.col("l_extendedprice").alias("length"),
        F.col("l_returnflag").alias("level"),
        F.col("p_type").alias("location"),
        F.col("l_orderkey").alias("sessionId"),
        F.col("p_name").alias("song"),
        F.col("o_custkey").alias("userId"),
        F.col("l_shipdate").alias("heard"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
    )


LISTEN_ORDER = ("heard", "part", "supplier")
LISTENS_SQL = """
listens AS (
  SELECT p_brand AS artist_name, c_name AS first_name, l_linenumber AS item_in_session,
         c_mktsegment AS last_name, l_extendedprice AS song_length, l_orderkey AS session_id,
         p_name AS song_title, o_custkey AS user_id, l_shipdate, l_partkey, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
)"""
