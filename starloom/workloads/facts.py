"""Event-to-song matching, fact keys and star retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import dense_key, hash_key, monotonic_key, start_time
from starloom.operators import dims
from starloom.operators.colocated import forget, write_colocated
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
from starloom.operators.star import Dimension, star_join
from starloom.storage import new_path
from starloom.workloads.registry import query
from starloom.workloads.standin import (
    BOTH_SQL,
    PLAY,
    events_only,
    plays,
    raw_songs,
    table,
)

TITLE_SQL = f"""
WITH {BOTH_SQL}
SELECT event_id, song, song_id, artist_id FROM plays JOIN songs ON song = title"""


@query(TITLE_SQL)
def fact_inner_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match(plays(spark, sf_dir, ("song",)), raw_songs(spark, sf_dir), [TITLE])
    return rows.select("event_id", "song", "song_id", "artist_id")


@query(TITLE_SQL)
def fact_inner_title_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``fact_inner_title``, with titles above 1 % of the plays dealt over partitions."""
    rows = match(plays(spark, sf_dir, ("song",)), raw_songs(spark, sf_dir), [TITLE], hot_share=0.01)
    return rows.select("event_id", "song", "song_id", "artist_id")


@query(TITLE_SQL)
def fact_inner_title_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``fact_inner_title_spread``, with both sides large enough, by hint, to be shuffled."""
    rows = match(
        plays(spark, sf_dir, ("song",)),
        raw_songs(spark, sf_dir).hint("merge"),
        [TITLE],
        hot_share=0.01,
        spread=16,
    )
    return rows.select("event_id", "song", "song_id", "artist_id")


@query(
    f"""
WITH {BOTH_SQL}
SELECT event_id, make_timestamp((ts // 1000) * 1000000) AS start_time, userid AS user_id, level,
       song_id, artist_id, sessionid AS session_id, location, useragent AS user_agent
FROM plays JOIN songs ON artist = artist_name AND song = title"""
)
def fact_inner_title_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match(plays(spark, sf_dir), raw_songs(spark, sf_dir), [ARTIST, TITLE])
    return rows.select(
        "event_id",
        start_time("ts", whole_seconds=True).alias("start_time"),
        F.col("userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
    )


def _left_sql(length: str, duration: str) -> str:
    return f"""
WITH {BOTH_SQL}
SELECT event_id, make_timestamp((ts // 1000) * 1000000) AS start_time, userid AS user_id, level,
       song_id, artist_id, sessionid AS session_id, location
FROM plays LEFT JOIN songs
  ON song = title AND artist = artist_name AND {length} = {duration}"""


def _left_fact(spark: SparkSession, sf_dir: str, length_key) -> DataFrame:
    rows = match(
        plays(spark, sf_dir), raw_songs(spark, sf_dir), [TITLE, ARTIST, length_key], how="left"
    )
    return rows.select(
        "event_id",
        start_time("ts", whole_seconds=True).alias("start_time"),
        F.col("userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
    )


@query(_left_sql("CAST(length AS DECIMAL(18,5))", "CAST(duration AS DECIMAL(18,5))"))
def fact_left_3key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _left_fact(spark, sf_dir, LENGTH)


@query(_left_sql("floor(length)", "floor(duration)"))
def fact_left_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _left_fact(spark, sf_dir, WHOLE_LENGTH)


@query(_left_sql("CAST(length AS DECIMAL(18,0))", "CAST(duration AS DECIMAL(18,0))"))
def fact_left_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _left_fact(spark, sf_dir, ROUNDED_LENGTH)


@query(
    f"""
WITH {BOTH_SQL}, picked AS (
  SELECT title, artist_name, CAST(duration AS DECIMAL(18,5)) AS duration,
         min(song_id) AS song_id, min(artist_id) AS artist_id
  FROM songs GROUP BY ALL
)
SELECT event_id, song_id, artist_id
FROM plays LEFT JOIN picked
  ON song = title AND artist = artist_name AND CAST(length AS DECIMAL(18,5)) = duration"""
)
def fact_lookup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    songs = raw_songs(spark, sf_dir)
    named = join_catalogue(dims.songs_first(songs), dims.artists_upsert(songs))
    rows = match(
        plays(spark, sf_dir), named, [TITLE, ARTIST, LENGTH], how="left", duplicates="first"
    )
    return rows.select("event_id", "song_id", "artist_id")


@query(
    f"""
WITH {BOTH_SQL},
fact AS (
  SELECT event_id, song_id, make_timestamp(ts * 1000) AS start_time
  FROM plays JOIN songs ON artist = artist_name AND song = title
),
times AS (
  SELECT DISTINCT make_timestamp(ts * 1000) AS start_time,
         CAST(year(make_timestamp(ts * 1000)) AS BIGINT) AS year,
         CAST(month(make_timestamp(ts * 1000)) AS BIGINT) AS month
  FROM plays
)
SELECT event_id, song_id, start_time, year, month FROM fact JOIN times USING (start_time)"""
)
def fact_time_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match(plays(spark, sf_dir), raw_songs(spark, sf_dir), [ARTIST, TITLE])
    fact = rows.select("event_id", "song_id", start_time("ts").alias("start_time"))
    time = dims.time_dim(events_only(spark, sf_dir), scope="plays", play_page=PLAY)
    return join_time(fact, time).withColumns(
        {name: F.col(name).cast("long") for name in ("year", "month")}
    )


@query(
    f"""
WITH {BOTH_SQL}
SELECT DISTINCT userid AS user_id, level, song_id, artist_id
FROM plays JOIN songs ON song = title"""
)
def fact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    played = plays(spark, sf_dir, ("song",)).withColumnRenamed("userId", "user_id")
    return distinct_matches(played, raw_songs(spark, sf_dir), [TITLE], ["user_id", "level"])


@query(
    """
SELECT DISTINCT l_partkey AS song_id, p_name AS title, l_suppkey AS artist_id, s_name AS artist_name
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""
)
def catalogue_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    part = table(spark, sf_dir, "part")
    songs = made.join(part, made.l_partkey == part.p_partkey).select(
        F.col("l_partkey").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("l_suppkey").alias("artist_id"),
    )
    artists = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("name")
    )
    return join_catalogue(songs, artists)


@query(
    """
SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_quantity AS quantity,
       l_extendedprice AS price, l_shipdate AS ship_date, o_orderstatus AS order_status,
       o_orderdate AS order_date, p_name AS part_name, p_brand AS part_brand,
       s_name AS supplier_name, c_name AS customer_name, c_mktsegment AS customer_segment,
       n_name AS nation_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON c_nationkey = n_nationkey"""
)
def star_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with all their dimensions.

    Orders take their customers along before they meet the lines, so the largest
    table is shuffled once less; the dimension that adds most columns comes last.
    Nations do not grow with the data, so a copy for every executor is asked for,
    behind a check of their size.
    """
    fact = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("ship_date"),
        "l_partkey",
        "l_suppkey",
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_date"),
    )
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_nationkey",
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_segment"),
    )
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("part_name"), F.col("p_brand").alias("part_brand")
    )
    supplier = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_name").alias("supplier_name")
    )
    nation = table(spark, sf_dir, "nation").select(
        "n_nationkey", F.col("n_name").alias("nation_name")
    )
    buyers = star_join(
        orders,
        [
            Dimension(customer, {"o_custkey": "c_custkey"}),
            Dimension(nation, {"c_nationkey": "n_nationkey"}, replicate=True),
        ],
    ).drop("o_custkey", "c_nationkey")
    joined = star_join(
        fact,
        [
            Dimension(part, {"l_partkey": "p_partkey"}),
            Dimension(supplier, {"l_suppkey": "s_suppkey"}),
            Dimension(buyers, {"order_id": "o_orderkey"}),
        ],
    )
    return joined.drop("l_partkey", "l_suppkey")


@query(
    """
SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_extendedprice AS price,
       o_orderstatus AS order_status, o_orderdate AS order_date, s_name AS supplier_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey"""
)
def star_retrieval_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and orders from catalog tables in buckets of the order; they meet without a shuffle."""
    fact = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_extendedprice").alias("price"),
        "l_suppkey",
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("order_status"), F.col("o_orderdate").alias("order_date")
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("supplier_name"))
    root = new_path(spark, "colocated")
    names = [f"{name}_{root.rsplit('-', 1)[1]}" for name in ("lines", "orders")]
    stored = [
        write_colocated(df, name, key, 16, f"{root}/{name}")
        for df, name, key in zip((fact, orders), names, ("order_id", "o_orderkey"))
    ]
    # By size alone Spark would copy the orders of the small test tables to every executor.
    dimensions = [
        Dimension(stored[1].hint("merge"), {"order_id": "o_orderkey"}),
        Dimension(suppliers, {"l_suppkey": "s_suppkey"}),
    ]
    joined = star_join(stored[0], dimensions).drop("l_suppkey")
    forget(spark, *names)
    return joined


@query(
    f"""
WITH {BOTH_SQL},
fact AS (
  SELECT event_id, make_timestamp((ts // 1000) * 1000000) AS start_time, userid AS user_id,
         song_id, artist_id
  FROM plays JOIN songs ON artist = artist_name AND song = title
),
users AS (
  SELECT userid AS user_id, min(firstname) AS first_name,
         arg_max(level, struct_pack(a := ts, b := sessionid, c := iteminsession, d := level)) AS level
  FROM plays GROUP BY userid
),
artists AS (
  SELECT artist_id, min(artist_name) AS name, arg_max(artist_location, song_id) AS location
  FROM songs GROUP BY artist_id
),
times AS (
  SELECT DISTINCT start_time, CAST(week(start_time) AS BIGINT) AS week FROM fact
)
SELECT event_id, start_time, first_name AS user_first_name, users.level AS user_level,
       songs.title AS song_title, artists.name AS artist_name, artists.location AS artist_location,
       week AS time_week
FROM fact JOIN users USING (user_id) JOIN songs USING (song_id)
JOIN artists ON artists.artist_id = fact.artist_id JOIN times USING (start_time)"""
)
def star_retrieval_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays star, with dimensions that have one row per key."""
    songs = raw_songs(spark, sf_dir)
    fact = match(plays(spark, sf_dir), songs, [ARTIST, TITLE]).select(
        "event_id",
        start_time("ts", whole_seconds=True).alias("start_time"),
        F.col("userId").alias("user_id"),
        "song_id",
        "artist_id",
    )
    users = dims.users_upsert(plays(spark, sf_dir, ("names",))).select("user_id", "first_name", "level")
    time = dims.time_dim(events_only(spark, sf_dir), "plays", True, play_page=PLAY)
    time = time.select("start_time", F.col("week").cast("long").alias("week"))
    joined = star_join(
        fact,
        [
            Dimension(users, {"user_id": "user_id"}, "user_"),
            Dimension(dims.songs_first(songs).select("song_id", "title"), {"song_id": "song_id"}, "song_"),
            Dimension(
                dims.artists_upsert(songs).select("artist_id", "name", "location"),
                {"artist_id": "artist_id"},
                "artist_",
            ),
            Dimension(time, {"start_time": "start_time"}, "time_"),
        ],
    )
    return joined.drop("user_id", "song_id", "artist_id")


@query(
    """
SELECT event_id,
       md5(CAST(user_id AS VARCHAR) || strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S')) AS play_key
FROM events"""
)
def key_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_only(spark, sf_dir).withColumn("_start", start_time("ts", whole_seconds=True))
    return events.select("event_id", hash_key(F.col("userId"), F.col("_start")).alias("play_key"))


@query(
    """
SELECT row_number() OVER (ORDER BY ts, event_id) AS songplay_id, event_id, ts AS start_time, user_id
FROM events"""
)
def key_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("start_time"), "user_id"
    )
    return dense_key(events, ["start_time", "event_id"])


@query("SELECT count(*) AS rows, count(*) AS keys FROM events")
def key_monotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys differ from run to run; that they are unique does not."""
    keyed = events_only(spark, sf_dir).select(monotonic_key().alias("songplay_id"))
    per_key = keyed.groupBy("songplay_id").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"))
