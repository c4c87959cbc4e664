"""Whole loads from raw files, one per profile, and the incremental load.

Spark writes the test tables as JSON files, a load turns those into star tables,
and the result is a row count and a checksum over all values of each table.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampNTZType

from starloom import plans, schemas
from starloom.functions import epoch_ms, start_time
from starloom.operators import quality
from starloom.plans import Profile, Sources, build_catalogue
from starloom.sources import conform
from starloom.storage import new_path
from starloom.streaming import IncrementalStar, load_available
from starloom.workloads.registry import query
from starloom.workloads.standin import BOTH_SQL, PLAY, raw_events, raw_songs

TABLES = ("songplays", "users", "songs", "artists", "time")


def write_raw_files(
    spark: SparkSession,
    sf_dir: str,
    events: DataFrame | None = None,
    songs: DataFrame | None = None,
    fmt: str = "json",
    compression: str = "none",
) -> Sources:
    """The catalogue as JSON files and the log as JSON or CSV files."""
    root = new_path(spark, "raw")
    songs = raw_songs(spark, sf_dir) if songs is None else songs
    songs.write.option("compression", compression).json(f"{root}/songs")
    events = raw_events(spark, sf_dir) if events is None else events
    writer = conform(events, schemas.RAW_EVENT).write.option("compression", compression)
    writer.options(header="true", escape='"').format(fmt).save(f"{root}/events")
    return Sources(songs=f"{root}/songs", events=f"{root}/events", events_format=fmt)


def _text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, TimestampNTZType):
        value = epoch_ms(name)
    elif isinstance(kind, DoubleType):
        value = value.cast("decimal(18,5)")
    return F.coalesce(value.cast("string"), F.lit("~"))


def checksum(name: str, df: DataFrame) -> DataFrame:
    """One row: the table's name, its row count and sums over the four parts of its rows' hashes."""
    row = F.md5(F.concat_ws("|", *[_text(df, column) for column in df.columns]))
    sums = [
        F.coalesce(F.sum(F.conv(F.substring(row, 1 + 8 * part, 8), 16, 10).cast("long")), F.lit(0))
        for part in range(4)
    ]
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.concat_ws(":", *[each.cast("string") for each in sums]).alias("checksum"),
    ).select(F.lit(name).alias("table_name"), "row_count", "checksum")


def numbers(df: DataFrame, dense: bool) -> DataFrame:
    """One row: how many different play numbers there are, and how many rows; dense ones end at that."""
    # Numbers that lie close together are bits of one word: much less to shuffle than each by itself.
    words = df.groupBy(F.shiftright("songplay_id", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(songplay_id & 63 AS INT))")).alias("_bits"),
        F.count(F.lit(1)).alias("_rows"),
        F.max("songplay_id").alias("_last"),
    )
    last = F.max("_last") if dense else F.coalesce(F.sum("_rows"), F.lit(0))
    return words.agg(
        F.lit("songplay_id").alias("table_name"),
        F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).alias("row_count"),
        last.cast("string").alias("checksum"),
    )


def star_checksums(spark: SparkSession, output: str, profile: Profile) -> DataFrame:
    """Checksums of all tables; numbers whose order is free are checked on their own."""
    parts = []
    for name in TABLES:
        rows = plans.read_table(spark, output, name)
        if name == "songplays" and (profile.play_key == "monotonic" or not profile.numbered_in_order):
            parts.append(numbers(rows, profile.play_key == "dense"))
            rows = rows.drop("songplay_id")
        parts.append(checksum(name, rows))
    return quality.report(parts)


def load(spark: SparkSession, sf_dir: str, profile: Profile, sources: Sources | None = None) -> str:
    """Run one whole load; gives where its tables are."""
    output = new_path(spark, f"star-{profile.name}")
    sources = sources or write_raw_files(spark, sf_dir)
    plans.run(spark, sources, output, replace(profile, play_page=PLAY))
    return output


def loaded(spark: SparkSession, sf_dir: str, profile: Profile, sources: Sources | None = None) -> DataFrame:
    return star_checksums(spark, load(spark, sf_dir, profile, sources), profile)


def _checksum_sql(name: str, columns: list[str]) -> str:
    row = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    sums = " || ':' || ".join(
        f"coalesce(CAST(sum(CAST('0x' || substr(h, {1 + 8 * part}, 8) AS BIGINT)) AS VARCHAR), '0')"
        for part in range(4)
    )
    return (
        f"SELECT '{name}' AS table_name, count(*) AS row_count, {sums} AS checksum "
        f"FROM (SELECT md5({row}) AS h FROM t_{name})"
    )


NUMBERS_SQL = """
UNION ALL SELECT 'songplay_id', count(*), CAST(count(*) AS VARCHAR) FROM t_songplays"""


def _star_sql(tables: dict[str, str], columns: dict[str, list[str]], before: str = "", after: str = "") -> str:
    ctes = ", ".join(f"t_{name} AS ({sql})" for name, sql in tables.items())
    sums = "\nUNION ALL ".join(_checksum_sql(name, columns[name]) for name in tables)
    return f"WITH {BOTH_SQL}{before}, {ctes}\n{sums}{after}"


USERS = ["user_id", "first_name", "last_name", "gender", "level"]
SONGS = ["song_id", "title", "artist_id", "year", "duration"]
ARTISTS = ["artist_id", "name", "location", "latitude", "longitude"]
PARTS = ["hour", "day", "week", "month", "year", "weekday"]
PLAYS = [
    "start_ms", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent"
]

MOMENT = "make_timestamp(start_ms * 1000)"
CALENDAR = (
    f"hour({MOMENT}) AS hour, day({MOMENT}) AS day, week({MOMENT}) AS week, "
    f"month({MOMENT}) AS month, year({MOMENT}) AS year"
)
LAST_LEVEL = (
    "arg_max(level, struct_pack(a := ts, b := sessionid, c := iteminsession, d := level)) AS level"
)
UPSERTED_USERS = (
    "SELECT userid AS user_id, min(firstname) AS first_name, min(lastname) AS last_name, "
    f"min(gender) AS gender, {LAST_LEVEL} FROM plays GROUP BY userid"
)
DISTINCT_USERS = (
    "SELECT DISTINCT userid AS user_id, firstname AS first_name, lastname AS last_name, "
    "gender, level FROM plays"
)
PLAY_VALUES = (
    "userid AS user_id, level, song_id, artist_id, sessionid AS session_id, location, "
    "useragent AS user_agent"
)


def _songs(duration: str) -> str:
    return f"SELECT DISTINCT song_id, title, artist_id, year, {duration} AS duration FROM songs"


def _artists(coordinate: str) -> str:
    return (
        "SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location, "
        f"CAST({coordinate.format('artist_latitude')}) AS latitude, "
        f"CAST({coordinate.format('artist_longitude')}) AS longitude FROM songs"
    )


MILLIS = "ts AS start_ms"
SECONDS = "(ts // 1000) * 1000 AS start_ms"
FIVE = "{} AS DECIMAL(18,5)"


UPSERT_SQL = (
    _star_sql(
        {
            "songplays": f"""
SELECT row_number() OVER (ORDER BY start_ms, session_id, iteminsession, song_id, artist_id)
       AS songplay_id, * FROM (
  SELECT {MILLIS}, iteminsession, {PLAY_VALUES}
  FROM plays LEFT JOIN (
    SELECT title, artist_name, CAST(duration AS DECIMAL(18,5)) AS whole, min(song_id) AS song_id,
           min(artist_id) AS artist_id FROM songs GROUP BY ALL
  ) ON song = title AND artist = artist_name AND CAST(length AS DECIMAL(18,5)) = whole
)""",
            "users": UPSERTED_USERS,
            "songs": _songs("CAST(duration AS DECIMAL(18,5))"),
            "artists": """
SELECT artist_id, min(artist_name) AS name, arg_max(artist_location, song_id) AS location,
       CAST(arg_max(artist_latitude, song_id) AS DECIMAL(18,5)) AS latitude,
       CAST(arg_max(artist_longitude, song_id) AS DECIMAL(18,5)) AS longitude
FROM songs GROUP BY artist_id""",
            "time": f"""
SELECT start_ms, {CALENDAR}, dayname({MOMENT}) AS weekday
FROM (SELECT DISTINCT {MILLIS} FROM plays)""",
        },
        {
            "songplays": ["songplay_id", *PLAYS],
            "users": USERS,
            "songs": SONGS,
            "artists": ARTISTS,
            "time": ["start_ms", *PARTS],
        },
    )
)


@query(UPSERT_SQL)
def load_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(spark, sf_dir, plans.UPSERT)


INNER_SQL = (
    _star_sql(
        {
            "songplays": f"""
SELECT {SECONDS}, {PLAY_VALUES} FROM plays JOIN songs ON artist = artist_name AND song = title""",
            "users": DISTINCT_USERS,
            "songs": _songs("CAST(duration AS DECIMAL(18,0))"),
            "artists": _artists(FIVE),
            "time": f"""
SELECT start_ms, {CALENDAR}, rpad(dayname({MOMENT}), 9, ' ') AS weekday
FROM (SELECT DISTINCT {SECONDS} FROM ev)""",
        },
        {
            "songplays": PLAYS,
            "users": USERS,
            "songs": SONGS,
            "artists": ARTISTS,
            "time": ["start_ms", *PARTS],
        },
        after=NUMBERS_SQL,
    )
)


@query(INNER_SQL)
def load_staged_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(spark, sf_dir, plans.STAGED_INNER)


RAW_PLAY = (
    "artist, auth, firstname, gender, iteminsession, lastname, length, level, location, page, "
    "sessionid, song, ts, useragent, userid"
)


def _lake_sql(before: str = "", logged: str = "plays") -> str:
    """The lake star: raw rows that repeat whole are one, everything else stays."""
    return _star_sql(
        {
            "songplays": f"""
SELECT *, year({MOMENT}) AS year, month({MOMENT}) AS month FROM (
  SELECT {MILLIS}, {PLAY_VALUES} FROM (SELECT DISTINCT {RAW_PLAY} FROM {logged})
  JOIN (SELECT DISTINCT song_id, title, artist_id FROM songs) ON song = title
)""",
            "users": DISTINCT_USERS.replace("FROM plays", f"FROM {logged}"),
            "songs": _songs("CAST(duration AS DECIMAL(18,5))"),
            "artists": _artists(FIVE),
            "time": f"""
SELECT start_ms AS ts, start_ms, {CALENDAR}, dayofweek({MOMENT}) + 1 AS weekday
FROM (SELECT DISTINCT {MILLIS} FROM {logged})""",
        },
        {
            "songplays": [*PLAYS, "year", "month"],
            "users": USERS,
            "songs": SONGS,
            "artists": ARTISTS,
            "time": ["ts", "start_ms", *PARTS],
        },
        before,
        NUMBERS_SQL,
    )


LAKE_SQL = _lake_sql()


@query(LAKE_SQL)
def load_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(spark, sf_dir, plans.LAKE)


@query(
    f"""
WITH {BOTH_SQL}, counts AS (
  SELECT (SELECT count(*) FROM (SELECT DISTINCT {RAW_PLAY} FROM plays)) AS rows_before,
         (SELECT count(*) FROM (SELECT DISTINCT {RAW_PLAY} FROM plays) JOIN songs ON song = title) AS rows_after
)
SELECT *, CAST(rows_after AS DOUBLE) / CAST(rows_before AS DOUBLE) AS ratio FROM counts"""
)
def load_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many fact rows a load made of its plays."""
    profile, output = replace(plans.LAKE, play_page=PLAY), new_path(spark, "star-fan-out")
    version = plans.run(spark, write_raw_files(spark, sf_dir), output, profile)
    return plans.fan_out(spark, output, version, profile)


@query(
    _lake_sql(
        """, logged AS (
  SELECT * FROM plays UNION ALL SELECT * FROM plays WHERE event_id % 3 = 0
  UNION ALL SELECT * REPLACE (iteminsession + 100000 AS iteminsession) FROM plays WHERE event_id % 5 = 0
)""",
        "logged",
    )
)
def load_lake_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some raw lines come twice, and some plays differ from others only in their place in the session."""
    events = raw_events(spark, sf_dir)
    other = events.filter("event_id % 5 = 0").withColumn("itemInSession", F.col("itemInSession") + 100000)
    events = events.union(events.filter("event_id % 3 = 0")).unionByName(other)
    return loaded(spark, sf_dir, plans.LAKE, write_raw_files(spark, sf_dir, events))


STAGED_LEFT_PLAYS = f"""
SELECT md5(CAST(sessionid AS VARCHAR)
           || strftime(make_timestamp((ts // 1000) * 1000000), '%Y-%m-%d %H:%M:%S')) AS songplay_id, {SECONDS}, {PLAY_VALUES}
FROM plays LEFT JOIN songs
  ON song = title AND artist = artist_name AND floor(length) = floor(duration)"""
STAGED_LEFT_TIME = f"""
SELECT start_ms, {CALENDAR}, dayofweek({MOMENT}) AS weekday
FROM (SELECT DISTINCT {SECONDS} FROM plays)"""


LEFT_SQL = (
    _star_sql(
        {
            "songplays": STAGED_LEFT_PLAYS,
            "users": DISTINCT_USERS,
            "songs": _songs("CAST(trunc(duration) AS DECIMAL(18,0))"),
            "artists": _artists("trunc({}) AS DECIMAL(18,0)"),
            "time": STAGED_LEFT_TIME,
        },
        {
            "songplays": ["songplay_id", *PLAYS],
            "users": USERS,
            "songs": SONGS,
            "artists": ARTISTS,
            "time": ["start_ms", *PARTS],
        },
    )
)


@query(LEFT_SQL)
def load_staged_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(spark, sf_dir, plans.STAGED_LEFT)


@query(LEFT_SQL)
def load_csv_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as CSV files, the catalogue as JSON files."""
    return loaded(spark, sf_dir, plans.STAGED_LEFT, write_raw_files(spark, sf_dir, fmt="csv"))


@query(INNER_SQL)
def load_gzip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed JSON files."""
    return loaded(spark, sf_dir, plans.STAGED_INNER, write_raw_files(spark, sf_dir, compression="gzip"))


def recreate_and_load(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    """A load put into recreated catalog tables twice, the second time instead of the first."""
    output, location = load(spark, sf_dir, profile), new_path(spark, "catalog")
    database = "star_" + location.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}-database'")
    for _ in range(2):
        plans.recreate_star(spark, profile, database, location)
        plans.load_catalog(spark, output, profile, database)
    parts = []
    for table in plans.star_tables(profile):
        rows = spark.read.schema(table.schema).parquet(f"{location}/{table.name}")
        if table.name == "time" and profile.time_keeps_epoch:
            rows = rows.select("ts", *[name for name in rows.columns if name != "ts"])
        if table.name == "songplays" and (profile.play_key == "monotonic" or not profile.numbered_in_order):
            parts.append(numbers(rows, profile.play_key == "dense"))
            rows = rows.drop("songplay_id")
        parts.append(checksum(table.name, rows))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return quality.report(parts)


@query(UPSERT_SQL)
def recreate_and_load_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recreate_and_load(spark, sf_dir, plans.UPSERT)


@query(INNER_SQL)
def recreate_and_load_staged_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recreate_and_load(spark, sf_dir, plans.STAGED_INNER)


@query(LAKE_SQL)
def recreate_and_load_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recreate_and_load(spark, sf_dir, plans.LAKE)


@query(LEFT_SQL)
def recreate_and_load_staged_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recreate_and_load(spark, sf_dir, plans.STAGED_LEFT)


# Two loads whose files overlap: of the first twenty days against two thirds of the songs, then of
# all days after the twelfth against all songs. Some events have no time; names change every ten days.
RELOAD_SQL = f""", dated AS (
  SELECT * REPLACE (CASE WHEN event_id % 100 = 7 THEN NULL ELSE ts END AS ts,
                    firstname || ' ' || (d // 10) AS firstname)
  FROM (SELECT *, day(make_timestamp(ts * 1000)) AS d FROM ev)
),
e1 AS (SELECT * FROM dated WHERE d <= 20), e2 AS (SELECT * FROM dated WHERE d > 12),
p1 AS (SELECT * FROM e1 WHERE page = '{PLAY}'), p2 AS (SELECT * FROM e2 WHERE page = '{PLAY}'),
s1 AS (SELECT * FROM songs WHERE CAST(song_id AS BIGINT) % 3 <> 0)"""


def reloaded(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    day = F.dayofmonth(start_time("ts"))
    events = raw_events(spark, sf_dir).withColumn("_day", day).withColumns(
        {
            "firstName": F.concat("firstName", F.lit(" "), F.floor(day / 10).cast("string")),
            "ts": F.when(F.col("event_id") % 100 != 7, F.col("ts")),
        }
    )
    songs = raw_songs(spark, sf_dir)
    output = new_path(spark, f"star-{profile.name}")
    loads = [
        (events.filter("_day <= 20"), songs.filter("CAST(song_id AS BIGINT) % 3 <> 0")),
        (events.filter("_day > 12"), songs),
    ]
    for some_events, some_songs in loads:
        sources = write_raw_files(spark, sf_dir, some_events, some_songs)
        plans.run(spark, sources, output, replace(profile, play_page=PLAY, check=True))
    return star_checksums(spark, output, profile)


def _both(sql: str) -> str:
    """The rows that each of the two loads adds."""
    second = sql.replace("p1", "p2").replace("e1", "e2").replace("s1", "songs")
    return f"{sql} UNION ALL {second}"


def _first_match(load: int, plays: str, songs: str) -> str:
    return f"""
SELECT {load} AS part, {MILLIS}, iteminsession, {PLAY_VALUES}
FROM {plays} LEFT JOIN (
  SELECT title, artist_name, CAST(duration AS DECIMAL(18,5)) AS whole, min(song_id) AS song_id,
         min(artist_id) AS artist_id FROM {songs} GROUP BY ALL
) ON song = title AND artist = artist_name AND CAST(length AS DECIMAL(18,5)) = whole"""


def _user(plays: str, columns: str, order: str) -> str:
    return f"""(
  SELECT userid AS user_id, {columns} FROM {plays}
  QUALIFY row_number() OVER (PARTITION BY userid ORDER BY {order}) = 1)"""


FIRST = "ts NULLS FIRST, sessionid, iteminsession, firstname NULLS FIRST, lastname, gender"
NEWEST = "ts DESC NULLS LAST, sessionid DESC, iteminsession DESC, level DESC"
NAMES = "firstname AS first_name, lastname AS last_name, gender"
STAR_COLUMNS = {
    "songplays": PLAYS,
    "users": USERS,
    "songs": SONGS,
    "artists": ARTISTS,
    "time": ["start_ms", *PARTS],
}


@query(
    _star_sql(
        {
            "songplays": f"""
SELECT row_number() OVER (ORDER BY part, start_ms NULLS FIRST, session_id, iteminsession,
                                   song_id NULLS FIRST, artist_id NULLS FIRST) AS songplay_id, *
FROM ({_first_match(1, 'p1', 's1')} UNION ALL {_first_match(2, 'p2', 'songs')})""",
            "users": f"""
SELECT user_id, coalesce(a.first_name, b.first_name) AS first_name,
       coalesce(a.last_name, b.last_name) AS last_name, coalesce(a.gender, b.gender) AS gender,
       coalesce(d.level, c.level) AS level
FROM {_user('p1', NAMES, FIRST)} a FULL JOIN {_user('p2', NAMES, FIRST)} b USING (user_id)
LEFT JOIN {_user('p1', 'level', NEWEST)} c USING (user_id)
LEFT JOIN {_user('p2', 'level', NEWEST)} d USING (user_id)""",
            "songs": _songs("CAST(duration AS DECIMAL(18,5))"),
            "artists": """
SELECT artist_id, min(artist_name) AS name, arg_max(artist_location, song_id) AS location,
       CAST(arg_max(artist_latitude, song_id) AS DECIMAL(18,5)) AS latitude,
       CAST(arg_max(artist_longitude, song_id) AS DECIMAL(18,5)) AS longitude
FROM songs GROUP BY artist_id""",
            "time": f"""
SELECT start_ms, {CALENDAR}, dayname({MOMENT}) AS weekday
FROM (SELECT {MILLIS} FROM p1 UNION SELECT {MILLIS} FROM p2) WHERE start_ms IS NOT NULL""",
        },
        STAR_COLUMNS | {"songplays": ["songplay_id", *PLAYS]},
        RELOAD_SQL,
    )
)
def reload_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions merge, the fact grows and its numbers go on."""
    return reloaded(spark, sf_dir, plans.UPSERT)


@query(
    _star_sql(
        {
            "songplays": _both(
                f"SELECT {SECONDS}, {PLAY_VALUES} FROM p1 JOIN s1 ON artist = artist_name AND song = title"
            ),
            "users": _both(DISTINCT_USERS.replace("FROM plays", "FROM p1")),
            "songs": _both(_songs("CAST(duration AS DECIMAL(18,0))").replace("FROM songs", "FROM s1")),
            "artists": _both(_artists(FIVE).replace("FROM songs", "FROM s1")),
            "time": _both(
                f"SELECT start_ms, {CALENDAR}, rpad(dayname({MOMENT}), 9, ' ') AS weekday "
                f"FROM (SELECT DISTINCT {SECONDS} FROM e1) WHERE start_ms IS NOT NULL"
            ),
        },
        STAR_COLUMNS,
        RELOAD_SQL,
        NUMBERS_SQL,
    )
)
def reload_staged_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every load adds its rows to all tables."""
    return reloaded(spark, sf_dir, plans.STAGED_INNER)


@query(
    _star_sql(
        {
            "songplays": STAGED_LEFT_PLAYS.replace("FROM plays", "FROM p2"),
            "users": DISTINCT_USERS.replace("FROM plays", "FROM p2"),
            "songs": _songs("CAST(trunc(duration) AS DECIMAL(18,0))"),
            "artists": _artists("trunc({}) AS DECIMAL(18,0)"),
            "time": STAGED_LEFT_TIME.replace("FROM plays", "FROM p2 WHERE ts IS NOT NULL"),
        },
        STAR_COLUMNS | {"songplays": ["songplay_id", *PLAYS]},
        RELOAD_SQL,
    )
)
def reload_staged_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load replaces the first."""
    return reloaded(spark, sf_dir, plans.STAGED_LEFT)


@query(f"WITH {BOTH_SQL} {UPSERTED_USERS}")
def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users after four loads, the first two of them compacted."""
    star = incremental_star(spark, sf_dir)
    star.compact_users(spark, through=1)
    return star.users(spark)


@query(
    _star_sql(
        {"songplays": STAGED_LEFT_PLAYS, "time": STAGED_LEFT_TIME},
        {"songplays": ["songplay_id", *PLAYS], "time": ["start_ms", *PARTS]},
    )
)
def incremental_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays and times after four loads."""
    star = incremental_star(spark, sf_dir)
    return quality.report(
        [checksum("songplays", star.songplays(spark)), checksum("time", star.time(spark))]
    )


def arrive(spark: SparkSession, rows: DataFrame, source: str, checkpoint: str, apply_batch) -> None:
    """Files that arrive, and the load that takes them."""
    rows.write.mode("append").parquet(source)
    load_available(spark, source, rows.schema, checkpoint, apply_batch, fmt="parquet", glob="*.parquet")


def incremental_star(spark: SparkSession, sf_dir: str) -> IncrementalStar:
    """The log arriving in four parts of about a week, each followed by a load."""
    profile = replace(plans.STAGED_LEFT, play_page=PLAY)
    source, root = new_path(spark, "arriving"), new_path(spark, "incremental")
    checkpoint = new_path(spark, "stream")
    star = IncrementalStar(root, profile, schemas.STAGED_EVENT)
    songs = raw_songs(spark, sf_dir)
    apply_batch = star.loader(songs, build_catalogue(songs, profile))
    for part in range(4):
        arrive(spark, week(spark, sf_dir, part), source, checkpoint, apply_batch)
    return star


def week(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    number = F.floor((F.dayofmonth(start_time("ts")) - 1) / 8)
    return conform(raw_events(spark, sf_dir).filter(number == part), schemas.STAGED_EVENT)


WEEKS_SQL = f""", weeks AS (SELECT *, (day(make_timestamp(ts * 1000)) - 1) // 8 AS w FROM ev),
w1 AS (SELECT * FROM weeks WHERE w < 2 AND page = '{PLAY}'),
w2 AS (SELECT * FROM weeks WHERE w >= 2 AND page = '{PLAY}'),
s1 AS (SELECT * FROM songs WHERE CAST(song_id AS BIGINT) % 2 = 0)"""


def _growing_star(spark: SparkSession, sf_dir: str, checked: bool = False) -> IncrementalStar:
    """Half of the songs, two weeks of the log, the other songs, and the rest of the log."""
    profile = replace(plans.STAGED_LEFT, play_page=PLAY)
    star = IncrementalStar(new_path(spark, "incremental"), profile, schemas.STAGED_EVENT, checked=checked)
    songs_at, events_at = new_path(spark, "songs"), new_path(spark, "events")
    seen_songs, seen_events = new_path(spark, "stream"), new_path(spark, "stream")
    songs = conform(raw_songs(spark, sf_dir), schemas.STAGED_SONG)
    half = F.col("song_id").cast("long") % 2
    for rest, weeks in ((0, (0, 1)), (1, (2, 3))):
        arrive(spark, songs.filter(half == rest), songs_at, seen_songs, star.song_loader(spark))
        both = week(spark, sf_dir, weeks[0]).union(week(spark, sf_dir, weeks[1]))
        arrive(spark, both, events_at, seen_events, star.loader(spark=spark))
    return star


@query(
    _star_sql(
        {"songplays": STAGED_LEFT_PLAYS.replace("FROM plays", f"FROM (SELECT DISTINCT {RAW_PLAY} FROM plays) plays"),
         "users": UPSERTED_USERS, "time": STAGED_LEFT_TIME},
        STAR_COLUMNS | {"songplays": ["songplay_id", *PLAYS]},
    )
)
def incremental_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third batch brings the first week again, the fourth the second and half of the third; each event counts once."""
    profile = replace(plans.STAGED_LEFT, play_page=PLAY, dedup_raw=True)
    star = IncrementalStar(new_path(spark, "incremental"), profile, schemas.STAGED_EVENT)
    source, checkpoint, songs = new_path(spark, "arriving"), new_path(spark, "stream"), raw_songs(spark, sf_dir)
    apply_batch = star.loader(songs, build_catalogue(songs, profile))
    for part in range(4):
        rows = week(spark, sf_dir, part)
        if part == 2:
            rows = rows.union(week(spark, sf_dir, 0))
            star.compact(spark, through=0)
            star.vacuum(spark)
        if part == 3:
            rows = rows.union(week(spark, sf_dir, 1)).union(week(spark, sf_dir, 2).filter("ts % 2 = 0"))
        arrive(spark, rows, source, checkpoint, apply_batch)
    return quality.report([checksum(name, getattr(star, name)(spark)) for name in ("songplays", "users", "time")])


def _left_plays(plays: str, songs: str) -> str:
    return STAGED_LEFT_PLAYS.replace("FROM plays LEFT JOIN songs", f"FROM {plays} LEFT JOIN {songs}")


@query(
    _star_sql(
        {
            "songplays": STAGED_LEFT_PLAYS,
            "users": UPSERTED_USERS,
            "songs": _songs("CAST(trunc(duration) AS DECIMAL(18,0))"),
            "artists": _artists("trunc({}) AS DECIMAL(18,0)"),
            "time": STAGED_LEFT_TIME,
        },
        STAR_COLUMNS | {"songplays": ["songplay_id", *PLAYS]},
    )
)
def incremental_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs arrive too, half of them after plays that name them: the star is that of one load of all files.

    All is compacted and the batches removed.
    """
    star = _growing_star(spark, sf_dir)
    star.compact(spark, through=0)
    star.vacuum(spark)
    star.compact(spark, through=1)
    star.vacuum(spark)
    return quality.report([checksum(name, getattr(star, name)(spark)) for name in TABLES])


CHECKED = ("songplay_id", "start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent")


def _checked_sql() -> str:
    """One row per batch and check; most columns are never NULL, songs are where nothing matched."""
    parts = []
    for batch, (plays, songs) in enumerate((("w1", "s1"), ("w2", "songs"))):
        parts += [
            f"SELECT {batch} AS batch_id, '{name}' AS table_name, 'not_empty' AS check_name, '' AS detail, "
            f"CAST((count(*) = 0) AS BIGINT) AS failing_rows FROM {of}"
            for name, of in (("songplays", plays), ("users", plays), ("time", plays), ("songs", songs), ("artists", songs))
        ]
        fact = _left_plays(plays, songs).replace("start_ms", "start_time")
        parts += [
            f"SELECT {batch}, 'songplays', 'not_null', '{column}', count(*) FILTER ({column} IS NULL) FROM ({fact})"
            for column in CHECKED
        ]
        parts.append(
            f"SELECT {batch}, 'songplays', 'foreign_key', 'start_time -> time.start_time', "
            f"count(*) FILTER (start_time NOT IN (SELECT (ts // 1000) * 1000 FROM {plays})) FROM ({fact})"
        )
    return f"WITH {BOTH_SQL}{WEEKS_SQL}\nSELECT *, failing_rows = 0 AS passed FROM ({' UNION ALL '.join(parts)})"


@query(_checked_sql())
def incremental_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report of every batch."""
    return _growing_star(spark, sf_dir, checked=True).reports(spark)
