"""Query-first lookup tables over order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.load import ROWS_PER_FILE
from starloom.operators.lookup import (
    SESSION_ITEM,
    SONG_USERS,
    USER_SESSION,
    Lookup,
    build_lookup,
    read_lookup,
    write_lookup,
)
from starloom.plans import load_lookups, stage_listens
from starloom.schemas import RAW_EVENT_CSV
from starloom.sources import conform
from starloom.storage import new_path
from starloom.workloads.registry import query
from starloom.workloads.standin import LISTEN_ORDER, LISTENS_SQL, listens

#: Of CSV files: a third of their size, at little cost.
COMPRESSION = "lz4"


def _sql(lookup: Lookup, where: str = "", columns: str = "") -> str:
    values = [name for name in lookup.columns if name not in lookup.primary_key]
    latest = ", ".join(f"{n} DESC" for n in ("l_shipdate", "l_partkey", "l_suppkey", *values))
    return f"""
WITH {LISTENS_SQL}
SELECT {columns or ", ".join(lookup.columns)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {", ".join(lookup.primary_key)} ORDER BY {latest}) AS n
  FROM listens
) WHERE n = 1 {where}"""


def stored_lookup(spark: SparkSession, sf_dir: str, lookup: Lookup) -> DataFrame:
    """Build and store a lookup table; gives the stored rows."""
    rows = build_lookup(listens(spark, sf_dir), lookup, LISTEN_ORDER)
    path = new_path(spark, lookup.name)
    write_lookup(rows, path, lookup)
    return spark.read.schema(rows.schema).parquet(path)


@query(_sql(SESSION_ITEM))
def lookup_session_item_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_lookup(spark, sf_dir, SESSION_ITEM)


@query(_sql(USER_SESSION))
def lookup_user_session_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_lookup(spark, sf_dir, USER_SESSION)


@query(_sql(SONG_USERS))
def lookup_song_users_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_lookup(spark, sf_dir, SONG_USERS)


def _staged_sql(lookup: Lookup) -> str:
    """As :func:`_sql`, where only the staged columns tell rows apart."""
    return _sql(lookup).replace("l_shipdate DESC, l_partkey DESC, l_suppkey DESC, ", "")


def staged_lookup(spark: SparkSession, sf_dir: str, lookup: Lookup) -> DataFrame:
    """CSV logs, staged as one quoted CSV table, read again and stored as a lookup table."""
    source = new_path(spark, "csv-log")
    heard = listens(spark, sf_dir)
    unknown = {f.name: F.lit(None).cast(f.dataType) for f in RAW_EVENT_CSV if f.name not in heard.columns}
    logged = conform(heard.withColumns(unknown), RAW_EVENT_CSV)
    packed = {"compression": COMPRESSION, "maxRecordsPerFile": ROWS_PER_FILE}
    logged.write.options(header="true", escape='"', **packed).csv(source)
    staged = stage_listens(
        spark, source, new_path(spark, "staged"), quoted_newlines=False, glob="*.csv*", compression=COMPRESSION
    )
    paths = load_lookups(staged, new_path(spark, "lookups"))
    return spark.read.parquet(paths[lookup.name])


@query(_staged_sql(SESSION_ITEM))
def lookup_staged_session_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_lookup(spark, sf_dir, SESSION_ITEM)


@query(_staged_sql(SONG_USERS))
def lookup_staged_song_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_lookup(spark, sf_dir, SONG_USERS)


@query(
    _sql(
        SESSION_ITEM,
        "AND session_id = 56 AND item_in_session = 3",
        "artist_name, song_title, song_length",
    )
)
def lookup_session_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lookup(
        stored_lookup(spark, sf_dir, SESSION_ITEM),
        SESSION_ITEM,
        {"session_id": 56, "item_in_session": 3},
        ["artist_name", "song_title", "song_length"],
    )


@query(
    _sql(
        USER_SESSION,
        "AND session_id = 56 AND user_id = (SELECT o_custkey FROM orders WHERE o_orderkey = 56)",
        "item_in_session, artist_name, song_title, first_name, last_name",
    )
)
def lookup_user_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_orderkey = 56")
    user = orders.select("o_custkey").first()
    return read_lookup(
        stored_lookup(spark, sf_dir, USER_SESSION),
        USER_SESSION,
        {"session_id": 56, "user_id": user.o_custkey if user else -1},
        ["item_in_session", "artist_name", "song_title", "first_name", "last_name"],
    )


@query(_sql(SONG_USERS, "AND song_title = 'small ring'", "user_id, first_name, last_name"))
def lookup_song_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lookup(
        stored_lookup(spark, sf_dir, SONG_USERS),
        SONG_USERS,
        {"song_title": "small ring"},
        ["user_id", "first_name", "last_name"],
    )
