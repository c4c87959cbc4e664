import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import publish, tables
from starloom.operators.load import append_fact, load_dim, write_quoted_csv, write_table
from starloom.schemas import Table, columns
from starloom.sources import (
    conform,
    file_count,
    preview,
    scan_csv,
    scan_json,
    scan_parquet,
    stage,
)
from starloom.storage import children
from tests.conftest import plan_of, rows_of

ITEM = columns(id=schemas.INT, name=schemas.TEXT)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf8")


def test_json_files_at_any_depth(spark, tmp_path):
    write(tmp_path / "a.json", '{"id": 1, "name": "x"}')
    write(tmp_path / "A/B/C/b.json", '{"id": 2, "name": "ü"}\n{"id": 3}\n')
    write(tmp_path / "A/readme.txt", "not json")
    found = scan_json(spark, str(tmp_path), ITEM)
    assert rows_of(found.select("id", "name")) == [(1, "x"), (2, "ü"), (3, None)]
    assert rows_of(file_count(found)) == [(2, 3)]


def test_unreadable_lines_are_set_aside(spark, tmp_path):
    write(tmp_path / "in/a.json", '{"id": 1, "name": "x"}\n{"id": 2, "na\n{"id": "three"}\n')
    staged = stage(spark, str(tmp_path / "in"), str(tmp_path / "out"), ITEM)
    assert rows_of(staged.rows) == [(1, "x")]
    assert rows_of(staged.rejected) == [('{"id": "three"}',), ('{"id": 2, "na',)]
    # Counting uses no column, so no line may change sides for that.
    assert staged.rows.count() == 1 and staged.rejected.count() == 2
    with pytest.raises(ValueError):
        stage(spark, str(tmp_path / "in"), str(tmp_path / "out2"), ITEM, on_reject="fail")


def test_staging_without_rejects(spark, tmp_path):
    write(tmp_path / "in/a.json", '{"id": 1, "name": "x"}')
    staged = stage(spark, str(tmp_path / "in"), str(tmp_path / "out"), ITEM, on_reject="fail")
    assert staged.rows.count() == 1 and staged.rejected.count() == 0


def test_json_paths(spark, tmp_path):
    lines = [
        {"k": 7, "who": {"name": "x"}, "odd key": "p", "list": [1, 2]},
        {"k": "", "who": {}, "odd key": None},
        {"k": "1540919166796.0", "who": {"name": "y"}},
    ]
    write(tmp_path / "in/a.json", "\n".join(map(json.dumps, lines)) + '\n\n{"k": 1,\n')
    target = columns(k=schemas.LONG, name=schemas.TEXT, odd=schemas.TEXT, second=schemas.INT)
    paths = ["$.k", "$.who.name", "$['odd key']", "$.list[1]"]
    staged = stage(spark, str(tmp_path / "in"), str(tmp_path / "out"), target, json_paths=paths)
    assert rows_of(staged.rows) == [
        (1540919166796, "y", None, None), (7, "x", "p", 2), (None, None, None, None)
    ]
    assert rows_of(staged.rejected) == [('{"k": 1,',)]
    with pytest.raises(ValueError):
        stage(spark, str(tmp_path / "in"), str(tmp_path / "o3"), target, json_paths=paths[:2])


def test_formats_are_honoured(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, 'say "hi"')], ITEM)
    df.write.parquet(str(tmp_path / "p"))
    write_quoted_csv(df, str(tmp_path / "c"))
    for fmt, path in (("parquet", "p"), ("csv", "c")):
        staged = stage(spark, str(tmp_path / path), str(tmp_path / f"o{fmt}"), ITEM, fmt=fmt)
        assert rows_of(staged.rows) == rows_of(df)
    with pytest.raises(ValueError):
        stage(spark, str(tmp_path / "p"), str(tmp_path / "x"), ITEM, fmt="avro")


def test_csv_files_are_put_together(spark, tmp_path):
    head = "id,name\n"
    write(tmp_path / "one.csv", head + '1,"a, b"\n2,"the ""best"" of"\n')
    write(tmp_path / "deep/two.csv", head + '3,\n4,"two\nlines"\n')
    found = rows_of(scan_csv(spark, str(tmp_path), ITEM))
    assert found == [(1, "a, b"), (2, 'the "best" of'), (3, None), (4, "two\nlines")]


def test_csv_rows_that_do_not_fit_are_set_aside(spark, tmp_path):
    write(tmp_path / "in/a.csv", "id,name\n1,x\ntwo,y\n")
    staged = stage(spark, str(tmp_path / "in"), str(tmp_path / "out"), ITEM, fmt="csv")
    assert rows_of(staged.rows) == [(1, "x")]
    assert rows_of(staged.rejected) == [("two,y",)]


def test_quoted_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, "x\ny"), (3, None), (None, " z ")], ITEM)
    write_quoted_csv(df, str(tmp_path / "t"))
    text = "".join(p.read_text() for p in (tmp_path / "t").glob("*.csv"))
    assert '"id","name"' in text and '"1","a ""b"", c"' in text
    assert rows_of(scan_csv(spark, str(tmp_path / "t"), ITEM)) == rows_of(df)


def test_conversion_never_fails(spark):
    raw = spark.createDataFrame(
        [("", "1.54E12", "x"), ("39", "1540919166796.0", "2.5"), ("-3", "abc", "")], "a string, b string, c string"
    )
    typed = conform(raw, columns(b=schemas.LONG, a=schemas.INT, c=schemas.REAL))
    assert typed.columns == ["b", "a", "c"]
    assert rows_of(typed) == [(1540000000000, None, None), (1540919166796, 39, 2.5), (None, -3, None)]


def test_preview_is_ordered(spark):
    df = spark.range(100).repartition(7)
    assert rows_of(preview(df, ["id"], 3)) == [(0,), (1,), (2,)]


def test_modes(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], ITEM)
    fact, dim = str(tmp_path / "fact"), str(tmp_path / "dim")
    for _ in range(2):
        append_fact(df, fact)
        load_dim(df, dim, truncate=True)
    assert spark.read.parquet(fact).count() == 2 and spark.read.parquet(dim).count() == 1
    load_dim(df, dim, truncate=False)
    assert spark.read.parquet(dim).count() == 2


@pytest.fixture
def partitioned(spark, tmp_path):
    """More than half of the rows are in one partition, as with unknown years."""
    df = spark.range(1000).selectExpr("id", "IF(id % 5 < 3, 0, 1990 + id % 7) AS year", "id % 2 AS month")
    path = str(tmp_path / "t")
    write_table(df, path, partition_by=["year", "month"])
    return df, path


def test_partitioned_table_comes_back(spark, partitioned):
    df, path = partitioned
    stored = scan_parquet(spark, path)
    assert rows_of(stored.selectExpr("id", "CAST(year AS BIGINT)", "CAST(month AS BIGINT)")) == rows_of(
        df.selectExpr("id", "CAST(year AS BIGINT)", "month")
    )
    below = scan_parquet(spark, f"{path}/year=1990", base_path=path)
    assert {r.year for r in below.select("year").distinct().collect()} == {1990}


def test_partition_filters_prune(spark, partitioned):
    _, path = partitioned
    plan = plan_of(scan_parquet(spark, path).filter("year = 1990 AND month = 1"))
    assert "PartitionFilters: [isnotnull(year" in plan


def test_touched_partitions_only(spark, partitioned):
    _, path = partitioned
    new = spark.createDataFrame([(-1, 1990, 0)], "id long, year int, month long")
    write_table(new, path, partition_by=["year", "month"], only_touched_partitions=True)
    stored = spark.read.parquet(path)
    assert rows_of(stored.filter("year = 1990 AND month = 0").select("id")) == [(-1,)]
    assert stored.filter("year = 0").count() == 600


def test_versions_appear_together(spark, tmp_path):
    root = str(tmp_path)
    a, b = spark.range(3), spark.range(5)
    kinds = {"a": a.schema, "b": b.schema}
    publish.write_version(a, root, "a", "v1")
    publish.write_version(b, root, "b", "v1")
    with pytest.raises(LookupError):
        publish.read_published(spark, root, "a")
    publish.publish(spark, root, "v1", {"a": "overwrite", "b": "append"}, kinds)

    # A load that fails half way: table a was written, table b was not.
    publish.write_version(spark.range(100), root, "a", "v2")
    assert publish.read_published(spark, root, "a").count() == 3

    publish.write_version(spark.range(7), root, "a", "v3")
    publish.write_version(spark.range(2), root, "b", "v3")
    publish.publish(spark, root, "v3", {"a": "overwrite", "b": "append"}, kinds)
    assert publish.read_published(spark, root, "a").count() == 7
    assert publish.read_published(spark, root, "b").count() == 7
    with pytest.raises(ValueError):
        publish.publish(spark, root, "v4", {"a": "merge"}, kinds)


def test_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    for _ in range(2):
        tables.create_all(spark, database="made")
    assert {t.name for t in spark.catalog.listTables("made")} == {t.name for t in schemas.WAREHOUSE}
    for table in schemas.WAREHOUSE:
        stored = spark.table(f"made.{table.name}").schema
        assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in table.schema]

    # Columns are paired by name.
    row = spark.createDataFrame([("free", 8, "F", "Kay", "Sun")], "level string, user_id int, gender string, first_name string, last_name string")
    tables.insert_by_name(row, "made.users")
    tables.insert_by_name(row, "made.users", truncate=True)
    assert rows_of(spark.table("made.users")) == [(8, "Kay", "Sun", "F", "free")]

    tables.recreate_all(spark, database="made")
    assert spark.table("made.users").count() == 0
    for _ in range(2):
        tables.drop_all(spark, database="made")
    assert [t.name for t in spark.catalog.listTables("made") if not t.isTemporary] == []


def test_dimensions_come_before_the_fact():
    names = [t.name for t in schemas.STAR]
    for table in schemas.STAR:
        for key in table.foreign_keys:
            assert names.index(key.table) < names.index(table.name)


def test_times_survive_storage(spark, tmp_path):
    made = Table("t", columns(start_time=schemas.MOMENT))
    df = spark.createDataFrame([(datetime(2018, 3, 11, 2, 30),)], made.schema)
    write_table(df, str(tmp_path / "t"))
    back = spark.read.schema(made.schema).parquet(str(tmp_path / "t"))
    assert back.select(F.col("start_time").cast("string")).first()[0] == "2018-03-11 02:30:00"


def test_vacuum_removes_what_nobody_reads(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(10)
    for n in range(4):
        publish.write_version(rows.filter(F.col("id") % 4 == n), root, "a", str(n))
        publish.publish(spark, root, str(n), {"a": "append"}, {"a": rows.schema})
    publish.write_version(rows, root, "b", "only")
    publish.publish(spark, root, "only", {"b": "overwrite"}, {"b": rows.schema})
    publish.write_version(rows, root, "b", "never published")
    publish.compact(spark, root, "a", "whole")
    publish.compact(spark, root, "b", "not needed")
    (tmp_path / "t" / "_staging" / "x").mkdir(parents=True)
    logged = children(spark, f"{root}/_published")
    assert len(logged) == 6
    gone = publish.vacuum(spark, root)
    assert {name for name in gone if not name.startswith("_published")} == {
        "a/version=0", "a/version=1", "a/version=2", "a/version=3", "b/version=never published", "_staging/x"
    }
    assert len(children(spark, f"{root}/_published")) == 1
    assert children(spark, f"{root}/a") == ["version=whole"] and children(spark, f"{root}/nowhere") == []
    for table in ("a", "b"):
        assert sorted(r.id for r in publish.read_published(spark, root, table).collect()) == list(range(10))
    publish.write_version(rows, root, "a", "more")
    publish.publish(spark, root, "more", {"a": "append"}, {"a": rows.schema})
    assert publish.read_published(spark, root, "a").count() == 20
    assert publish.vacuum(spark, root) != []
    assert publish.read_published(spark, root, "b").count() == 10
