from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starloom import plans, schemas, workloads
from starloom.operators import quality
from starloom.operators.load import write_table
from starloom.operators.lookup import (
    LOOKUP_TABLES,
    SESSION_ITEM,
    SONG_USERS,
    USER_SESSION,
    build_lookup,
    read_lookup,
    store_lookup,
    write_lookup,
)
from starloom.operators.match import TITLE, match
from starloom.operators.star import Dimension, measured_bytes, replicate, star_join
from starloom.plans import load_lookups, stage_listens
from starloom.schemas import ForeignKey
from starloom.workloads.loads import write_raw_files
from tests.conftest import plan_of, rows_of

HEAD = "artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,page,registration,sessionId,song,status,ts,userId\n"


@pytest.fixture
def listens(spark, tmp_path):
    one = (
        ",Logged In,Kay,F,0,Sun,,free,here,GET,Home,1.54E+12,139,,200,1.54E+12,8\n"
        'Ann,Logged In,Kay,F,1,Sun,218.9,free,"a, b",PUT,NextSong,1.54E+12,139,Alpha,200,1.54E+12,8\n'
        'Bob,Logged In,Kay,F,2,Sun,55.5,free,"a, b",PUT,NextSong,1.54E+12,139,"The ""B""",200,1.54E+12,8\n'
    )
    two = (
        "Ann,Logged In,Syl,F,1,Cruz,1.0,paid,there,PUT,NextSong,1.54E+12,182,Alpha,200,1.54E+12,10\n"
        "Cyd,Logged In,Syl,F,0,Cruz,2.0,paid,there,PUT,NextSong,1.54E+12,182,Gamma,200,1.54E+12,10\n"
        "Ann,Logged In,Syl,F,7,Cruz,1.0,paid,there,PUT,NextSong,1.54E+12,183,Alpha,200,1.54E+12,10\n"
    )
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "one.csv").write_text(HEAD + one)
    (tmp_path / "in" / "deep" / "two.csv").write_text(HEAD + two)
    return stage_listens(spark, str(tmp_path / "in"), str(tmp_path / "staged"))


def test_staged_listens(listens):
    assert listens.columns == schemas.STAGED_LISTEN.names
    assert listens.count() == 5
    assert listens.filter("song = 'The \"B\"'").count() == 1


def test_lookup_tables_answer_their_questions(spark, tmp_path, listens):
    paths = load_lookups(listens, str(tmp_path / "lookups"), ["sessionId", "itemInSession"])
    stored = {t.name: spark.read.parquet(paths[t.name]) for t in LOOKUP_TABLES}
    assert {n: df.count() for n, df in stored.items()} == {
        "artist_song_lookup": 5, "user_activity": 5, "user_songs": 4
    }
    for table in schemas.LOOKUPS:
        assert [(f.name, f.dataType) for f in stored[table.name].schema] == [
            (f.name, f.dataType) for f in table.schema
        ]
    one = read_lookup(
        stored["artist_song_lookup"], SESSION_ITEM, {"session_id": 139, "item_in_session": 1}
    )
    assert [tuple(r) for r in one.collect()] == [(139, 1, "Ann", "Alpha", 218.9)]
    heard = read_lookup(
        stored["user_activity"], USER_SESSION, {"session_id": 182, "user_id": 10}, ["song_title", "last_name"]
    )
    # In the order of the items.
    assert [tuple(r) for r in heard.collect()] == [("Gamma", "Cruz"), ("Alpha", "Cruz")]
    users = read_lookup(
        stored["user_songs"], SONG_USERS, {"song_title": "Alpha"}, ["first_name", "last_name"]
    )
    assert [tuple(r) for r in users.collect()] == [("Kay", "Sun"), ("Syl", "Cruz")]


def test_lookup_values_are_checked(listens):
    table = build_lookup(listens, USER_SESSION)
    with pytest.raises(ValueError):
        read_lookup(table, USER_SESSION, {"session_id": 1})
    with pytest.raises(ValueError):
        read_lookup(table, USER_SESSION, {"session_id": 1, "user_id": 2, "level": "free"})


def test_same_key_overwrites(spark):
    rows = spark.createDataFrame(
        [("Ann", 1, 1.0, 5, "old", 1), ("Bob", 1, 2.0, 5, "new", 2)],
        "artist string, itemInSession int, length double, sessionId int, song string, seen int",
    )
    assert rows_of(build_lookup(rows, SESSION_ITEM, ["seen"])) == [(5, 1, "Bob", "new", 2.0)]


def test_hot_lookup_key_spans_files(spark, tmp_path):
    """A third of the rows are one title; they must not end up in one task."""
    df = spark.range(9000).selectExpr(
        "IF(id % 3 = 0, 'hit', concat('t', id % 100)) AS song_title",
        "CAST(id AS INT) AS user_id",
        "'f' AS first_name",
        "'l' AS last_name",
    )
    path = str(tmp_path / "t")
    write_lookup(df, path, SONG_USERS, files=9)
    stored = spark.read.parquet(path)
    assert stored.filter("song_title = 'hit'").selectExpr("input_file_name()").distinct().count() >= 3
    assert stored.count() == 9000


def test_point_reads_push_their_filters(spark, tmp_path, listens):
    path = str(tmp_path / "t")
    write_lookup(build_lookup(listens, SESSION_ITEM), path, SESSION_ITEM)
    found = read_lookup(
        spark.read.parquet(path), SESSION_ITEM, {"session_id": 139, "item_in_session": 1}, ["song_title"]
    )
    plan = plan_of(found)
    assert "EqualTo(session_id,139)" in plan and "EqualTo(item_in_session,1)" in plan
    assert "song_length" not in plan


@pytest.fixture
def frames(spark):
    users = spark.createDataFrame([(8, "Kay"), (10, None), (10, "Syl")], "user_id int, first_name string")
    plays = spark.createDataFrame([(1, 8), (2, 10), (3, 99), (4, 99), (5, None)], "id int, user_id int")
    return {"users": users, "plays": plays, "none": plays.filter("false")}


def report_of(df):
    return {(r.table_name, r.detail): (r.failing_rows, r.passed) for r in df.collect()}


def test_not_empty(frames):
    found = report_of(quality.check_not_empty(frames))
    assert found == {("users", ""): (0, True), ("plays", ""): (0, True), ("none", ""): (1, False)}
    with pytest.raises(quality.QualityError, match="none: not_empty"):
        quality.require(quality.check_not_empty(frames))
    with pytest.raises(quality.QualityError, match="no rows in none"):
        quality.require_not_empty(frames)
    passing = {n: df for n, df in frames.items() if n != "none"}
    quality.require(quality.check_not_empty(passing))
    quality.require_not_empty(passing)


def test_not_null(frames):
    found = report_of(quality.check_not_null("users", frames["users"], ["user_id", "first_name"]))
    assert found == {("users", "user_id"): (0, True), ("users", "first_name"): (1, False)}


def test_unique(frames):
    assert rows_of(quality.duplicate_keys(frames["users"], ["user_id"])) == [(10, 2)]
    assert report_of(quality.check_unique("users", frames["users"], ["user_id"])) == {
        ("users", "user_id"): (1, False)
    }
    assert report_of(quality.check_unique("plays", frames["plays"], ["id"])) == {("plays", "id"): (0, True)}


def test_foreign_keys(frames):
    key = ForeignKey("user_id", "users", "user_id")
    found = quality.check_foreign_key("plays", frames["plays"], frames["users"], key)
    assert report_of(found) == {("plays", "user_id -> users.user_id"): (2, False)}
    assert rows_of(quality.orphan_keys(frames["plays"], frames["users"], "user_id", "user_id")) == [(99, 2)]


def test_foreign_keys_are_counted_before_a_shuffled_join(spark, frames):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(
            quality.orphan_keys(frames["plays"], frames["users"], "user_id", "user_id"), "simple"
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.index("SortMergeJoin") < plan.index("HashAggregate")


def test_lengths(spark):
    df = spark.createDataFrame([("abc", "x"), (None, "xyz")], "a string, b string")
    assert report_of(quality.check_lengths("t", df, {"a": 3, "b": 2})) == {
        ("t", "a"): (0, True), ("t", "b"): (1, False)
    }


def test_row_counts_and_fan_out(plays, raw_songs, frames):
    assert rows_of(quality.row_counts({"none": frames["none"], "plays": plays})) == [("none", 0), ("plays", 5)]
    assert rows_of(quality.fan_out(plays, match(plays, raw_songs, [TITLE]))) == [(5, 10, 2.0)]
    assert rows_of(quality.fan_out(frames["none"], frames["none"])) == [(0, 0, None)]


def test_registry_checks(spark, frames):
    made = schemas.Table(
        "plays",
        frames["plays"].schema,
        ("id",),
        ("id", "user_id"),
        (ForeignKey("user_id", "users", "user_id"),),
    )
    assert report_of(quality.check_table(made, frames)) == {
        ("plays", "id"): (0, True),
        ("plays", "user_id"): (1, False),
        ("plays", "user_id -> users.user_id"): (2, False),
    }


def test_star_join(spark):
    fact = spark.createDataFrame([(1, 8, "S1"), (2, 8, "S9"), (3, 10, "S1")], "id int, user_id int, song string")
    users = spark.createDataFrame([(8, "Kay"), (10, "Syl")], "user_id int, name string")
    songs = spark.createDataFrame([("S1", "Alpha")], "song_id string, name string")
    joined = star_join(
        fact,
        [
            Dimension(users, {"user_id": "user_id"}, "user_", replicate=True),
            Dimension(songs, {"song": "song_id"}, "song_"),
        ],
    )
    assert joined.columns == ["id", "user_id", "song", "user_name", "song_name"]
    assert rows_of(joined) == [(1, 8, "S1", "Kay", "Alpha"), (3, 10, "S1", "Syl", "Alpha")]


def test_only_small_tables_are_replicated(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        dim = spark.range(1000).selectExpr("id", "repeat('x', 100) AS name")
        size = measured_bytes(dim)
        assert 100_000 < size < 200_000
        fact = spark.range(10)
        assert "BroadcastHashJoin" in plan_of(fact.join(replicate(dim, size), "id"))
        assert "SortMergeJoin" in plan_of(fact.join(replicate(dim, size - 1), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_queries_read_the_tables_as_they_are_now(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("part", "lineitem", "orders", "customer", "events"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    title = spark.read.parquet(f"{source}/part.parquet").select("p_name").first()[0]
    session = spark.read.parquet(f"{source}/lineitem.parquet").filter("l_orderkey = 56").count()
    assert session and workloads.queries()["lookup_user_session"](spark, str(tmp_path)).count() > 0
    less = spark.read.parquet(f"{source}/lineitem.parquet").filter("l_orderkey != 56")
    less.write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    assert workloads.queries()["lookup_user_session"](spark, str(tmp_path)).count() == 0
    few = spark.read.parquet(f"{source}/part.parquet").filter(F.col("p_name") != title)
    before = raw_song_files(spark, str(tmp_path))
    few.write.mode("overwrite").parquet(str(tmp_path / "part.parquet"))
    assert raw_song_files(spark, str(tmp_path)) == few.count() < before


def raw_song_files(spark, sf_dir):
    return spark.read.json(write_raw_files(spark, sf_dir).songs).count()


def scanned(df):
    """Rows that the scan of a collected frame gave."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(node.metrics().apply("numOutputRows").value())
    return sum(found)


def test_a_read_by_the_second_key_skips_row_groups(spark, tmp_path):
    rows = spark.range(20000).select(
        (F.col("id") % 5000).alias("sessionId"),
        (F.xxhash64("id") % 1_000_000).alias("userId"),
        F.col("id").alias("itemInSession"),
        F.lit("a").alias("artist"),
        F.col("id").cast("string").alias("song"),
        F.lit("f").alias("firstName"),
        F.lit("l").alias("lastName"),
    )
    lookup = build_lookup(rows, USER_SESSION)
    path = str(tmp_path / "lookup")
    write_lookup(lookup, path, USER_SESSION, files=16)
    second = USER_SESSION.primary_key[1]
    stored = spark.read.parquet(path)
    value = stored.select(second).first()[0]
    hit = stored.filter(F.col(second) == F.lit(value))
    assert scanned(hit) <= 20000 // 16 * 4 and hit.count() >= 1
    low, high = stored.agg(F.min(second), F.max(second)).first()
    absent = next(v for v in range(low + 1, high) if v % 7 == 3 and not stored.filter(F.col(second) == v).count())
    assert scanned(stored.filter(F.col(second) == F.lit(absent))) <= 20000 // 16 * 4


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    made = schemas.Table("t", schemas.columns(id=schemas.LONG, a=schemas.TEXT, b=schemas.TEXT), ("id",), required=("id", "a", "gone"), longest={"b": 3})
    rows = spark.range(1000).select(
        "id", F.when(F.col("id") % 10 != 0, "x").alias("a"), F.when(F.col("id") < 7, "long text").otherwise("ok").alias("b")
    )
    for name, df, parts in (("flat", rows, ()), ("parts", rows.repartition(6), ("b",)), ("none", rows.limit(0), ())):
        watch = quality.Watch(made)
        write_table(df, str(tmp_path / name), partition_by=parts, watch=watch)
        many = 0 if name == "none" else 1000
        assert watch.rows == many
        assert watch.failures() == (["t: not_null a (100)", "t: length b (7)"] if many else [])


def test_a_checked_load_reads_no_row_twice_for_nulls(spark, tmp_path, raw_files):
    with pytest.raises(quality.QualityError) as raised:
        plans.run(spark, raw_files, str(tmp_path / "star"), replace(plans.LAKE, enforce=True, check=True))
    assert "songs: not_null year (1)" in str(raised.value)
    assert not (tmp_path / "star" / "_published").exists()


def test_lookup_stored_with_one_shuffle(spark, tmp_path, listens):
    """Also where rows repeat, lack a key or come in another order."""
    staged = listens.union(listens).union(listens.withColumn("sessionId", F.lit(None).cast("int")))
    for lookup in LOOKUP_TABLES:
        path = str(tmp_path / f"one-{lookup.name}")
        store_lookup(staged, path, lookup, ["length", "session_id"][: 1 + ("session_id" in lookup.columns)])
        expected = build_lookup(staged, lookup, ["length", "session_id"][: 1 + ("session_id" in lookup.columns)])
        assert rows_of(spark.read.parquet(path)) == rows_of(expected)
    ranged = staged.filter("sessionId IS NOT NULL").repartitionByRange("sessionId", "itemInSession")
    assert plan_of(build_lookup(ranged, SESSION_ITEM), "simple").count("Exchange") == 1


def test_staged_listens_can_be_compressed(spark, tmp_path, listens):
    again = stage_listens(spark, str(tmp_path / "in"), str(tmp_path / "packed"), compression="lz4")
    assert list((tmp_path / "packed").glob("*.csv.lz4")) and not list((tmp_path / "packed").glob("*.csv"))
    assert rows_of(again) == rows_of(listens)
