"""Several loaders at once, and merges that write only what they touch."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from threading import Barrier

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starloom import plans, schemas
from starloom.functions import keys
from starloom.functions.keys import in_number_order
from starloom.operators import publish
from starloom.operators.upsert import merge_upsert
from starloom.storage import children, create_new, read_text
from tests.conftest import event_rows, rows_of


def together(*jobs):
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def test_one_of_many_gets_the_name(spark, tmp_path):
    path, start = f"{tmp_path}/new/folder/1.json", Barrier(8)

    def write(n):
        start.wait()
        return create_new(spark, path, f"{n}" * 1000)

    won = together(*[lambda n=n: write(n) for n in range(8)])
    assert sum(won) == 1
    assert read_text(spark, path) == f"{won.index(True)}" * 1000
    assert children(spark, f"{tmp_path}/new/folder") == ["1.json"]


def test_two_loaders_that_finish_together_both_appear(spark, tmp_path, monkeypatch):
    root, rows, start = str(tmp_path / "t"), spark.range(10), Barrier(2)
    plain, raced = publish._append, []

    def at_once(*args):
        # Both have read the same state before either writes.
        if len(raced) < 2:
            raced.append(args[2])
            start.wait()
        return plain(*args)

    monkeypatch.setattr(publish, "_append", at_once)

    def load(version, table):
        publish.write_version(rows, root, "shared", version)
        publish.write_version(rows, root, table, version)
        return publish.publish(spark, root, version, {"shared": "append", table: "overwrite"}, {t: rows.schema for t in ("shared", table)})

    assert sorted(together(lambda: load("one", "a"), lambda: load("two", "b"))) == [1, 2]
    assert raced == [1, 1]
    state = publish.current(spark, root)
    assert sorted(state["shared"].versions) == ["one", "two"] and set(state) == {"shared", "a", "b"}
    assert publish.read_published(spark, root, "shared").count() == 20


def test_a_load_built_on_older_rows_conflicts(spark, tmp_path):
    root, rows = str(tmp_path / "t"), spark.range(3)
    for version in ("one", "two"):
        publish.write_version(rows, root, "a", version)
    kinds = {"a": rows.schema}
    publish.publish(spark, root, "one", {"a": "overwrite"}, kinds, {"a": 0})
    with pytest.raises(publish.Conflict, match="a changed"):
        publish.publish(spark, root, "two", {"a": "overwrite"}, kinds, {"a": 0})
    assert publish.current(spark, root)["a"].versions == ("one",)
    publish.publish(spark, root, "two", {"a": "overwrite"}, kinds, {"a": 1})
    assert publish.current(spark, root)["a"].versions == ("two",)


def test_two_whole_loads_at_once(spark, tmp_path, raw_files):
    output = str(tmp_path / "star")
    plans.run(spark, raw_files, output, plans.UPSERT)
    other = [("E7", 1541300000000, str(u), "paid", 300 + u, 0, "Beta", "Bob", 55.5, "NextSong") for u in (8, 10)]
    for n, event in enumerate(other):
        spark.createDataFrame(list(event_rows([event])), schemas.RAW_EVENT).write.json(str(tmp_path / f"more{n}"))
    loads = [replace(raw_files, events=str(tmp_path / f"more{n}")) for n in range(2)]
    together(*[lambda s=s: plans.run(spark, s, output, plans.UPSERT) for s in loads])
    fact = plans.read_table(spark, output, "songplays").collect()
    assert sorted(r.songplay_id for r in fact) == list(range(1, 8))
    assert {r.session_id for r in fact} >= {308, 310}
    assert {r.user_id: r.level for r in plans.read_table(spark, output, "users").collect()} == {8: "paid", 10: "paid"}
    assert plans.read_table(spark, output, "time").count() == 6


def test_a_merge_writes_the_files_it_touches(spark, tmp_path):
    root = str(tmp_path / "t")
    users = spark.range(1000).select("id", F.lit("a").alias("name"), F.lit("free").alias("level"))
    publish.write_version(users.repartitionByRange(20, "id"), root, "users", "one")
    publish.publish(spark, root, "one", {"users": "overwrite"}, {"users": users.schema})
    incoming = spark.range(420, 430).union(spark.range(2000, 2002))
    incoming = incoming.select("id", F.lit("b").alias("name"), F.lit("paid").alias("level"))
    for version in ("two", "three"):
        state = publish.current(spark, root)["users"]
        rows = publish.read_state(spark, root, "users", state)
        files = publish.touched_files(rows, incoming, ["id"])
        assert 1 <= len(files) <= 3 and rows.select("_metadata.file_name").distinct().count() >= 20
        part = merge_upsert(publish.in_files(rows, files), incoming, ["id"], ["level"])
        publish.write_version(part, root, "users", version, order_by=["id"])
        assert part.count() < 200
        publish.publish(spark, root, version, {"users": "append"}, {"users": users.schema}, {"users": state.sequence}, {"users": files})
        want = rows_of(merge_upsert(users, incoming, ["id"], ["level"]))
        assert rows_of(publish.read_published(spark, root, "users")) == want
    gone = publish.vacuum(spark, root)
    assert len([name for name in gone if name.startswith("users/version=one/part-")]) in (1, 2)
    assert rows_of(publish.read_published(spark, root, "users")) == want
    publish.compact(spark, root, "users", "whole")
    assert publish.current(spark, root)["users"].dropped == ()
    assert rows_of(publish.read_published(spark, root, "users")) == want


def test_numbers_are_given_when_rows_are_read(spark, tmp_path):
    root, start = str(tmp_path / "t"), 1
    for version, n in (("one", 700), ("none", 0), ("two", 300)):
        rows = spark.range(n).select(F.xxhash64("id").alias("at")).repartition(7)
        ranged = in_number_order(rows, ["at"])
        stored = publish.write_numbered(ranged, root, "fact", version, "number", start)
        assert [r.number for r in stored.orderBy("at").collect()] == list(range(start, start + n))
        assert publish.last_number(spark, root, "fact", version) == (start + n - 1 if n else None)
        schema = StructType([StructField("number", LongType()), *rows.schema.fields])
        publish.publish(spark, root, version, {"fact": "append"}, {"fact": schema}, marked={"fact": "number"})
        start += n
    assert sorted(r.number for r in publish.read_published(spark, root, "fact").collect()) == list(range(1, 1001))
    before = rows_of(publish.read_published(spark, root, "fact"))
    publish.compact(spark, root, "fact", "whole")
    assert publish.current(spark, root)["fact"].marked == ()
    gone = publish.vacuum(spark, root)
    assert {f"_numbers/fact/version={v}" for v in ("one", "none", "two")} <= set(gone)
    assert rows_of(publish.read_published(spark, root, "fact")) == before


def test_a_dense_load_writes_the_fact_once(spark, tmp_path, raw_files, monkeypatch):
    stored = []
    monkeypatch.setattr(keys, "materialize", lambda df, label: stored.append(label))
    output = str(tmp_path / "star")
    for n in (1, 2):
        plans.run(spark, raw_files, output, plans.UPSERT)
        fact = plans.read_table(spark, output, "songplays").orderBy("songplay_id").collect()
        assert [r.songplay_id for r in fact] == list(range(1, 5 * n + 1))
        assert [r.start_time for r in fact[-5:]] == sorted(r.start_time for r in fact[-5:])
    assert stored == [] and len(publish.current(spark, output)["songplays"].marked) == 2
