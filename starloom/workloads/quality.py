"""Data quality checks over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.operators.match import TITLE, match
from starloom.schemas import ForeignKey
from starloom.workloads.registry import query
from starloom.workloads.standin import BOTH_SQL, plays, raw_songs, table


@query(
    """
SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'events', count(*) FROM events
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'part', count(*) FROM part"""
)
def dq_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("customer", "events", "lineitem", "orders", "part")
    return quality.row_counts({name: table(spark, sf_dir, name) for name in names})


# Parts of the log by type and of the orders by status; some exist and some do not.
EVENT_PARTS = {name: ("events", "event_type", name) for name in ("purchase", "error", "refund")}
ORDER_PARTS = {f"orders {name}": ("orders", "o_orderstatus", name) for name in ("F", "O", "X")}
QUALITY_PARTS = EVENT_PARTS | ORDER_PARTS


def _not_empty_sql() -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n FROM {of} WHERE {column} = '{value}'"
        for name, (of, column, value) in QUALITY_PARTS.items()
    )
    return f"""
SELECT table_name, 'not_empty' AS check_name, '' AS detail,
       CASE WHEN n = 0 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS failing_rows, n > 0 AS passed
FROM ({counts})"""


@query(_not_empty_sql())
def dq_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_not_empty(
        {
            name: table(spark, sf_dir, of).filter(F.col(column) == value)
            for name, (of, column, value) in QUALITY_PARTS.items()
        }
    )


@query(
    """
WITH staged AS (
  SELECT doc_id, text, lang, source, labels.quality, labels.toxic
  FROM documents LEFT JOIN labels USING (doc_id)
), counts AS (
  SELECT 'doc_id' AS detail, count(*) FILTER (doc_id IS NULL) AS failing_rows FROM staged
  UNION ALL SELECT 'text', count(*) FILTER (text IS NULL) FROM staged
  UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL) FROM staged
  UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM staged
)
SELECT 'documents' AS table_name, 'not_null' AS check_name, detail, failing_rows,
       failing_rows = 0 AS passed
FROM counts"""
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with labels; some have none."""
    labels = table(spark, sf_dir, "labels")
    staged = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    return quality.check_not_null("documents", staged, ["doc_id", "text", "quality", "toxic"])


@query(
    """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1"""
)
def dq_pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """
SELECT 'events' AS table_name, 'unique_key' AS check_name, 'event_id' AS detail,
       count(*) AS failing_rows, count(*) = 0 AS passed
FROM (SELECT 1 FROM events GROUP BY event_id HAVING count(*) > 1)
UNION ALL
SELECT 'lineitem', 'unique_key', 'l_orderkey, l_linenumber', count(*), count(*) = 0
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return quality.report(
        [
            quality.check_unique("events", table(spark, sf_dir, "events"), ["event_id"]),
            quality.check_unique("lineitem", lines, ["l_orderkey", "l_linenumber"]),
        ]
    )


@query(
    """
SELECT 'events' AS table_name, 'foreign_key' AS check_name,
       'user_id -> customer.c_custkey' AS detail,
       (SELECT count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)) AS failing_rows,
       (SELECT count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)) = 0 AS passed
UNION ALL
SELECT 'events', 'foreign_key', 'user_id -> supplier.s_suppkey',
       (SELECT count(*) FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)),
       (SELECT count(*) FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)) = 0"""
)
def dq_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's user is a customer; not every one is a supplier."""
    events = table(spark, sf_dir, "events")
    references = {"customer": "c_custkey", "supplier": "s_suppkey"}
    return quality.report(
        [
            quality.check_foreign_key(
                "events", events, table(spark, sf_dir, name), ForeignKey("user_id", name, key)
            )
            for name, key in references.items()
        ]
    )


@query(
    """
SELECT user_id, count(*) AS row_count FROM events
WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id"""
)
def dq_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    return quality.orphan_keys(table(spark, sf_dir, "events"), suppliers, "user_id", "s_suppkey")


@query(
    """
SELECT 'part' AS table_name, 'length' AS check_name, 'p_brand' AS detail,
       count(*) FILTER (length(p_brand) > 7) AS failing_rows,
       count(*) FILTER (length(p_brand) > 7) = 0 AS passed FROM part
UNION ALL
SELECT 'part', 'length', 'p_name', count(*) FILTER (length(p_name) > 256),
       count(*) FILTER (length(p_name) > 256) = 0 FROM part"""
)
def dq_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_lengths("part", table(spark, sf_dir, "part"), {"p_brand": 7, "p_name": 256})


@query(
    f"""
WITH {BOTH_SQL}, counts AS (
  SELECT (SELECT count(*) FROM plays) AS rows_before,
         (SELECT count(*) FROM plays JOIN songs ON song = title) AS rows_after
)
SELECT rows_before, rows_after, CAST(rows_after AS DOUBLE) / CAST(rows_before AS DOUBLE) AS ratio
FROM counts"""
)
def dq_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = plays(spark, sf_dir, ("song",))
    return quality.fan_out(before, match(before, raw_songs(spark, sf_dir), [TITLE]))
