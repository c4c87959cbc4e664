"""Event times and the time dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import fixed_point, start_time, weekday
from starloom.operators import dims
from starloom.operators.match import ARTIST, TITLE, match
from starloom.workloads.registry import query
from starloom.workloads.standin import BOTH_SQL, PLAY, events_only, plays, raw_songs, table

PARTS_SQL = """
       CAST(hour(start_time) AS BIGINT) AS hour, CAST(day(start_time) AS BIGINT) AS day,
       CAST(week(start_time) AS BIGINT) AS week, CAST(month(start_time) AS BIGINT) AS month,
       CAST(year(start_time) AS BIGINT) AS year"""


def _as_long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("long") for name in names})


@query("SELECT event_id, date_trunc('second', ts) AS start_time FROM events")
def ts_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_only(spark, sf_dir)
    return events.select("event_id", start_time("ts", whole_seconds=True).alias("start_time"))


@query("SELECT event_id, date_trunc('millisecond', ts) AS start_time FROM events")
def ts_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_only(spark, sf_dir).select("event_id", start_time("ts").alias("start_time"))


@query(
    f"""
WITH moments AS (
  SELECT DISTINCT date_trunc('millisecond', ts) AS start_time FROM events WHERE event_type = '{PLAY}'
)
SELECT start_time, {PARTS_SQL}, dayname(start_time) AS weekday FROM moments"""
)
def time_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dims.time_dim(events_only(spark, sf_dir), "plays", play_page=PLAY)
    return _as_long(rows, "hour", "day", "week", "month", "year")


@query(
    f"""
WITH moments AS (SELECT DISTINCT date_trunc('second', ts) AS start_time FROM events)
SELECT start_time, {PARTS_SQL}, rpad(dayname(start_time), 9, ' ') AS weekday FROM moments"""
)
def time_dim_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dims.time_dim(events_only(spark, sf_dir), "all", True, weekday_style="padded")
    return _as_long(rows, "hour", "day", "week", "month", "year")


@query(
    f"""
WITH {BOTH_SQL}, moments AS (
  SELECT make_timestamp((ts // 1000) * 1000000) AS start_time
  FROM plays LEFT JOIN songs ON song = title AND artist = artist_name
)
SELECT start_time, {PARTS_SQL}, CAST(dayofweek(start_time) AS VARCHAR) AS weekday FROM moments"""
)
def time_dim_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar rows of a fact without removing duplicates."""
    rows = match(plays(spark, sf_dir), raw_songs(spark, sf_dir), [TITLE, ARTIST], "left")
    fact = rows.select(start_time("ts", whole_seconds=True).alias("start_time"))
    time = dims.time_dim(fact, "fact", distinct=False, weekday_style="sunday0")
    return _as_long(time, "hour", "day", "week", "month", "year").withColumn(
        "weekday", F.col("weekday").cast("string")
    )


@query(
    """
SELECT event_id, dayname(ts) AS name, rpad(dayname(ts), 9, ' ') AS padded,
       CAST(dayofweek(ts) + 1 AS BIGINT) AS sunday1, CAST(dayofweek(ts) AS BIGINT) AS sunday0
FROM events"""
)
def weekday_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        weekday(moment, "name").alias("name"),
        weekday(moment, "padded").alias("padded"),
        weekday(moment, "sunday1").cast("long").alias("sunday1"),
        weekday(moment, "sunday0").cast("long").alias("sunday0"),
    )


@query(
    """
SELECT p_partkey AS song_id, CAST(round(p_retailprice) AS BIGINT) AS rounded,
       CAST(trunc(p_retailprice) AS BIGINT) AS truncated,
       CAST(trunc(-p_retailprice) AS BIGINT) AS truncated_negative
FROM part"""
)
def decimal_scale0(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("song_id"),
        fixed_point(price, 0).cast("long").alias("rounded"),
        fixed_point(price, 0, "truncate").cast("long").alias("truncated"),
        fixed_point(-price, 0, "truncate").cast("long").alias("truncated_negative"),
    )
