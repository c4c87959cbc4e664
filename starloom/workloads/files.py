"""File sources and sinks, over files that Spark first writes from the test tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import publish, tables
from starloom.operators.load import append_fact, load_dim, write_quoted_csv, write_table
from starloom.operators.layout import by_several, replace_groups
from starloom.operators.upsert import merge_upsert
from starloom.schemas import Table, columns
from starloom.sources import (
    by_json_paths,
    conform,
    file_count,
    scan_csv,
    scan_json,
    scan_parquet,
    stage,
)
from starloom.storage import children, new_path
from starloom.workloads.registry import query
from starloom.workloads.standin import table

EVENT = columns(
    event_id=schemas.LONG,
    user_id=schemas.LONG,
    event_type=schemas.TEXT,
    value=schemas.REAL,
    props=schemas.TEXT,
)
EVENT_SQL = "SELECT event_id, user_id, event_type, value, props FROM events"
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*EVENT.names)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


@query(EVENT_SQL)
def scan_json_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files two directory levels down."""
    root = new_path(spark, "json")
    events = _events(spark, sf_dir)
    levels = events.withColumns({"kind": F.col("event_type"), "parity": F.col("user_id") % 2})
    levels.write.partitionBy("kind", "parity").json(root)
    return scan_json(spark, root, EVENT, corrupt_column=None)


@query(
    """
SELECT (SELECT count(*) FROM (SELECT DISTINCT event_type, event_id // 20000 FROM events)) AS files,
       count(*) AS rows FROM events"""
)
def scan_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file for each type of event and 20,000 event numbers, written by the one task that has all of its rows."""
    root = new_path(spark, "json-count")
    part = F.floor(F.col("event_id") / 20000)
    events = _events(spark, sf_dir).withColumns({"kind": F.col("event_type"), "part": part})
    events.repartition("kind", "part").write.partitionBy("kind", "part").json(root)
    return file_count(scan_json(spark, root, EVENT, corrupt_column=None))


@query(
    """
SELECT event_id, event_type <> 'error' AS readable FROM events"""
)
def json_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events are written without the end of their line, and set aside."""
    root = new_path(spark, "json-corrupt")
    line = F.to_json(F.struct(*EVENT.names))
    cut = F.when(F.col("event_type") == "error", line.substr(F.lit(1), F.length(line) - 2))
    _events(spark, sf_dir).select(cut.otherwise(line).alias("value")).write.text(root)
    staged = stage(spark, root, new_path(spark, "staged"), EVENT)
    broken = F.regexp_extract("corrupt_record", '"event_id":([0-9]+)', 1).cast("long")
    return staged.rows.select("event_id", F.lit(True).alias("readable")).unionByName(
        staged.rejected.select(broken.alias("event_id"), F.lit(False).alias("readable"))
    )


@query(EVENT_SQL)
def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines staged by column name."""
    root = new_path(spark, "json-auto")
    _events(spark, sf_dir).write.json(root)
    return stage(spark, root, new_path(spark, "staged"), EVENT, glob="*.json").rows


@query(EVENT_SQL)
def stage_events_by_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with other names and a nested member, staged by one path per column."""
    root = new_path(spark, "json-paths")
    nested = _events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.struct(F.col("user_id").alias("number")).alias("user"),
        F.col("event_type").alias("kind of event"),
        "value",
        "props",
    )
    nested.write.json(root)
    paths = ["$.id", "$.user.number", "$['kind of event']", "$.value", "$.props"]
    return stage(spark, root, new_path(spark, "staged"), EVENT, json_paths=paths).rows


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def stage_json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    parsed = by_json_paths(lines, columns(k=schemas.LONG), ["$.k"])
    return parsed.select("event_id", "k")


@query(
    """
SELECT p_partkey, TRY_CAST(p_name AS INTEGER) AS name_number,
       TRY_CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS brand_number,
       TRY_CAST('' AS INTEGER) AS empty_number,
       CAST(trunc(CAST(p_retailprice AS DECIMAL(38,10))) AS BIGINT) AS price_number
FROM part"""
)
def stage_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that is no number becomes NULL; a fraction in a whole-number column is cut."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_name").alias("name_number"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("brand_number"),
        F.lit("").alias("empty_number"),
        F.col("p_retailprice").cast("string").alias("price_number"),
    )
    target = columns(
        p_partkey=schemas.LONG,
        name_number=schemas.INT,
        brand_number=schemas.INT,
        empty_number=schemas.INT,
        price_number=schemas.LONG,
    )
    return conform(part, target)


@query(EVENT_SQL)
def csv_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several CSV files, each with a header; quotes inside fields are doubled."""
    root = new_path(spark, "csv")
    events = _events(spark, sf_dir).withColumn("kind", F.col("event_type"))
    writer = events.write.partitionBy("kind").option("header", "true").option("escape", '"')
    writer.csv(root)
    return scan_csv(spark, root, EVENT)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_quote_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    root = new_path(spark, "csv-quoted")
    write_quoted_csv(customers, root)
    return scan_csv(spark, root, customers.schema, quoted_newlines=False)


@query(
    """
SELECT conv_id, turn, role, text FROM conversations"""
)
def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks survive quoted CSV."""
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    root = new_path(spark, "csv-breaks")
    write_quoted_csv(talks, root)
    return scan_csv(spark, root, talks.schema)


@query(ORDERS_SQL)
def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact that grows by three loads, which split the orders by key."""
    orders = _orders(spark, sf_dir)
    root = new_path(spark, "append")
    for part in range(3):
        append_fact(orders.filter(F.pmod("o_orderkey", F.lit(3)) == part), root)
    return scan_parquet(spark, root, orders.schema)


@query("SELECT * FROM supplier")
def load_dim_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    root = new_path(spark, "dim")
    for _ in range(2):
        load_dim(suppliers, root, truncate=True)
    return scan_parquet(spark, root, suppliers.schema)


@query("SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def load_dim_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    root = new_path(spark, "dim")
    for _ in range(2):
        load_dim(suppliers, root, truncate=False)
    return scan_parquet(spark, root, suppliers.schema)


@query("SELECT * FROM part")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    root = new_path(spark, "parquet")
    write_table(part, root)
    return scan_parquet(spark, root, part.schema)


def write_orders_by_month(spark: SparkSession, sf_dir: str) -> str:
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )
    root = new_path(spark, "partitioned")
    write_table(dated, root, partition_by=["year", "month"])
    return root


@query(
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders"""
)
def parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_parquet(spark, write_orders_by_month(spark, sf_dir))


@query(
    """
SELECT p_partkey AS song_id, p_name AS title, p_retailprice AS duration, p_size AS year, p_brand AS artist_id
FROM part WHERE p_partkey % 2 = 0
UNION ALL
SELECT p_partkey, p_name, p_retailprice, p_size, p_brand
FROM part WHERE p_partkey % 2 = 1 AND (p_size, p_brand) NOT IN (SELECT p_size, p_brand FROM part WHERE p_partkey % 2 = 0)"""
)
def parquet_by_year_and_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs laid out by year and artist; a second load replaces the pairs that it has rows for."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("duration"),
        F.col("p_size").alias("year"),
        F.col("p_brand").alias("artist_id"),
    )
    root, names = new_path(spark, "by-artist"), ["year", "artist_id"]
    kinds = {"songs": part.schema}
    first, second = (part.filter(F.col("song_id") % 2 == rest) for rest in (1, 0))
    publish.write_version(by_several(first, names, files=32), root, "songs", "first")
    publish.publish(spark, root, "first", {"songs": "overwrite"}, kinds)
    state = publish.current(spark, root)["songs"]
    stored = publish.read_state(spark, root, "songs", state)
    files = publish.touched_files(stored, second, names)
    rows = replace_groups(publish.in_files(stored, files), second, names)
    publish.write_version(by_several(rows, names), root, "songs", "second")
    publish.publish(spark, root, "second", {"songs": "append"}, kinds, {"songs": state.sequence}, {"songs": files})
    return publish.read_published(spark, root, "songs")


@query(
    """
SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 5"""
)
def parquet_partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads one of the directories."""
    stored = scan_parquet(spark, write_orders_by_month(spark, sf_dir))
    chosen = stored.filter((F.col("year") == 1997) & (F.col("month") == 5))
    return chosen.select("o_orderkey", "o_totalprice")


@query(
    """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, 0.0 FROM orders WHERE o_orderstatus = 'P'"""
)
def parquet_touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load replaces one partition and leaves the others."""
    orders = _orders(spark, sf_dir)
    root = new_path(spark, "touched")
    write_table(orders, root, partition_by=["o_orderstatus"])
    pending = orders.filter(F.col("o_orderstatus") == "P").withColumn("o_totalprice", F.lit(0.0))
    write_table(pending, root, partition_by=["o_orderstatus"], only_touched_partitions=True)
    return scan_parquet(spark, root).select("o_orderkey", "o_totalprice")


@query(
    """
SELECT 'customer' AS table_name, c_custkey AS id FROM customer
UNION ALL SELECT 'orders', o_orderkey FROM orders"""
)
def publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced and a table extended, made current together; a third load is never published."""
    root = new_path(spark, "versions")
    orders = _orders(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    building = customers.filter(F.col("c_mktsegment") == "BUILDING")
    modes = {"customer": "overwrite", "orders": "append"}
    columns_of = {"customer": customers.schema, "orders": orders.schema}
    loads = {
        "first": (building, orders.filter(F.col("o_orderstatus") == "F")),
        "second": (customers, orders.filter(F.col("o_orderstatus") != "F")),
    }
    for version, (some_customers, some_orders) in loads.items():
        publish.write_version(some_customers, root, "customer", version)
        publish.write_version(some_orders, root, "orders", version)
        publish.publish(spark, root, version, modes, columns_of)
    publish.write_version(building, root, "customer", "third")
    named = {"customer": "c_custkey", "orders": "o_orderkey"}
    parts = [
        publish.read_published(spark, root, name).select(
            F.lit(name).alias("table_name"), F.col(key).alias("id")
        )
        for name, key in named.items()
    ]
    return parts[0].unionByName(parts[1])


@query("SELECT *, CAST(1 AS BIGINT) AS versions FROM (" + ORDERS_SQL + ")")
def publish_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact of four appended versions, put into one; what is not read any more is removed."""
    root, orders = new_path(spark, "compacted"), _orders(spark, sf_dir)
    for part in range(4):
        rows = orders.filter(F.pmod("o_orderkey", F.lit(4)) == part)
        publish.write_version(rows, root, "orders", str(part))
        publish.publish(spark, root, str(part), {"orders": "append"}, {"orders": orders.schema})
    publish.compact(spark, root, "orders", "whole")
    publish.vacuum(spark, root)
    versions = len(children(spark, f"{root}/orders"))
    return publish.read_published(spark, root, "orders").withColumn("versions", F.lit(versions).cast("long"))


@query(f"SELECT *, CAST(2 AS BIGINT) AS loaders FROM ({ORDERS_SQL})")
def publish_two_loaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads started together, each with half of the orders; none loses the other's."""
    root, orders = new_path(spark, "loaders"), _orders(spark, sf_dir)

    def load(part: int) -> None:
        publish.write_version(orders.filter(F.pmod("o_orderkey", F.lit(2)) == part), root, "orders", str(part))
        publish.publish(spark, root, str(part), {"orders": "append"}, {"orders": orders.schema})

    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(load, part) for part in range(2)]:
            done.result()
    loaders = len(publish.current(spark, root)["orders"].versions)
    return publish.read_published(spark, root, "orders").withColumn("loaders", F.lit(loaders).cast("long"))


CHANGED = "c_custkey BETWEEN (SELECT max(c_custkey) // 2 FROM customer) AND (SELECT max(c_custkey) // 2 + max(c_custkey) // 100 FROM customer)"


@query(
    f"""
SELECT c_custkey, c_name, CASE WHEN {CHANGED} THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment,
       true AS few_files FROM customer
UNION ALL SELECT c_custkey + (SELECT max(c_custkey) FROM customer), c_name, 'CHANGED', true FROM customer WHERE {CHANGED}"""
)
def merge_touched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer in a hundred changes and as many are new: of forty files only those that hold them are written again."""
    root = new_path(spark, "merge")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    publish.write_version(customers.repartitionByRange(40, "c_custkey"), root, "customer", "first")
    publish.publish(spark, root, "first", {"customer": "overwrite"}, {"customer": customers.schema})
    state = publish.current(spark, root)["customer"]
    stored = publish.read_state(spark, root, "customer", state)
    last = stored.agg(F.max("c_custkey")).first()[0]
    some = stored.filter(F.col("c_custkey").between(last // 2, last // 2 + last // 100))
    some = some.withColumn("c_mktsegment", F.lit("CHANGED"))
    incoming = some.union(some.withColumn("c_custkey", F.col("c_custkey") + last))
    files = publish.touched_files(stored, incoming, ["c_custkey"])
    merged = merge_upsert(publish.in_files(stored, files), incoming, ["c_custkey"], ["c_mktsegment"])
    publish.write_version(merged, root, "customer", "second", order_by=["c_custkey"])
    modes, kinds = {"customer": "append"}, {"customer": customers.schema}
    publish.publish(spark, root, "second", modes, kinds, {"customer": state.sequence}, {"customer": files})
    publish.vacuum(spark, root)
    return publish.read_published(spark, root, "customer").withColumn("few_files", F.lit(len(files) <= 3))


@query("SELECT s_suppkey, s_name FROM supplier")
def recreate_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog tables dropped, created, filled by name, emptied and filled again."""
    location = new_path(spark, "catalog")
    suffix = location.rsplit("-", 1)[1]
    made = Table(
        f"supplier_{suffix}", columns(s_name=schemas.TEXT, s_suppkey=schemas.LONG), ("s_suppkey",)
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    tables.recreate_all(spark, [made], location=location)
    tables.create_all(spark, [made], location=location)
    tables.insert_by_name(suppliers, made.name)
    tables.insert_by_name(suppliers, made.name, truncate=True)
    stored = spark.read.schema(made.schema).parquet(f"{location}/{made.name}")
    tables.drop_all(spark, [made])
    tables.drop_all(spark, [made])
    return stored
