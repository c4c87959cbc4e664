"""Tables that are joined on a key again and again without being shuffled again.

Both sides lie in the catalog in equally many buckets of the join key, sorted within
them. A join on that key then reads bucket by bucket: the shuffle has been paid for once,
when the tables were written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one key stay in one bucket and one task; no key may have a larger part of them than this
#: unless the table is small.
MOST_SHARE = 0.05
FEW_ROWS = 1_000_000


def write_colocated(
    df: DataFrame,
    table: str,
    key: str,
    buckets: int,
    path: str,
    most_share: float = MOST_SHARE,
    few_rows: int = FEW_ROWS,
) -> DataFrame:
    """Store ``df`` as the catalog table ``table`` in ``buckets`` files by ``key``; gives the table.

    Tables to be joined need the same number of buckets, about the bytes of the larger one
    by 128 MB (:func:`starloom.session.shuffle_partitions`). A key that has more than
    ``most_share`` of the rows raises ``ValueError`` if those are more than ``few_rows``: such
    a table is better joined by a shuffle, which can split the key.
    """
    largest, rows = df.groupBy(key).count().agg(F.max("count"), F.sum("count")).first()
    if rows and largest > max(few_rows, most_share * rows):
        raise ValueError(f"{table}: one {key} has {largest} of {rows} rows; one bucket would hold them all")
    # One task per bucket, so that a bucket is one file and is read in order.
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def forget(spark: SparkSession, *tables: str) -> None:
    """Take tables out of the catalog; their files stay, and frames made of them go on reading."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
