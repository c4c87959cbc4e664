from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.functions import (
    dense_key,
    epoch_ms,
    fixed_point,
    hash_key,
    start_time,
    time_parts,
    weekday,
)
from starloom.functions import keys
from starloom.operators import dims
from starloom.operators.load import write_table
from starloom.storage import materialize
from tests.conftest import plan_of, rows_of


def test_times_keep_or_cut_milliseconds(plays):
    times = plays.select(start_time("ts").alias("ms"), start_time("ts", True).alias("s"))
    first = times.orderBy("ms").first()
    assert first.ms == datetime(2018, 11, 1, 21, 1, 46, 796000)
    assert first.s == datetime(2018, 11, 1, 21, 1, 46)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # Around both clock changes of New York, and in summer.
        df = spark.sql("SELECT explode(array(1520751600123L, 1541311200456L, 1530000000789L)) AS ts")
        out = df.select("ts", start_time("ts").alias("t")).select(
            "ts", epoch_ms("t").alias("back"), F.col("t").cast("string").alias("text"), F.hour("t").alias("h")
        )
        assert rows_of(out) == [
            (1520751600123, 1520751600123, "2018-03-11 07:00:00.123", 7),
            (1530000000789, 1530000000789, "2018-06-26 08:00:00.789", 8),
            (1541311200456, 1541311200456, "2018-11-04 06:00:00.456", 6),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar_of_the_first_play(spark):
    moment = F.expr("TIMESTAMP_NTZ '2018-11-01 21:01:46'")
    styles = ["name", "padded", "sunday1", "sunday0"]
    row = spark.range(1).select(
        *[part.alias(n) for n, part in time_parts(moment).items()],
        *[weekday(moment, style).alias(f"w_{style}") for style in styles],
    ).first()
    assert (row.hour, row.day, row.week, row.month, row.year) == (21, 1, 44, 11, 2018)
    assert (row.w_name, row.w_padded, row.w_sunday1, row.w_sunday0) == ("Thursday", "Thursday ", 5, 4)
    with pytest.raises(ValueError):
        weekday(moment, "short")


def test_week_numbers_are_iso(spark):
    days = spark.sql("SELECT explode(array(DATE'2018-12-31', DATE'2021-01-03')) AS d")
    parts = days.select(time_parts(F.col("d").cast("timestamp_ntz"))["week"].alias("w"))
    assert sorted(r.w for r in parts.collect()) == [1, 53]


@pytest.mark.parametrize(
    "scope, seconds, rows", [("plays", True, 3), ("plays", False, 5), ("all", True, 4), ("all", False, 6)]
)
def test_time_scopes(events, scope, seconds, rows):
    assert dims.time_dim(events, scope, whole_seconds=seconds).count() == rows


def test_time_of_a_fact_with_and_without_duplicates(plays):
    fact = plays.select(start_time("ts", True).alias("start_time"))
    assert dims.time_dim(fact, "fact", distinct=False).count() == 5
    assert dims.time_dim(fact, "fact").count() == 3
    as_text = dims.time_dim(fact, "fact", month_as_text=True).schema["month"].dataType
    assert as_text.simpleString() == "string"
    with pytest.raises(ValueError):
        dims.time_dim(fact, "fact", keep_epoch=True)


def test_time_may_keep_the_epoch(events):
    assert dims.time_dim(events, "plays", keep_epoch=True).columns[0] == "ts"


def test_time_plan_stays_in_generated_code(spark, tmp_path, events):
    events.write.parquet(str(tmp_path / "e"))
    plan = plan_of(dims.time_dim(spark.read.parquet(str(tmp_path / "e")), "all"))
    assert "EvalPython" not in plan and "UDF" not in plan
    assert "ReadSchema: struct<ts:bigint>" in plan


@pytest.mark.parametrize(
    "value, scale, rounded, truncated",
    [
        (218.93179, 0, "219", "218"),
        (218.5, 0, "219", "218"),
        (-218.93179, 0, "-219", "-218"),
        (0.29, 2, "0.29", "0.29"),
        (1.005, 5, "1.00500", "1.00500"),
        (2.999999, 5, "3.00000", "2.99999"),
    ],
)
def test_fixed_point(spark, value, scale, rounded, truncated):
    df = spark.createDataFrame([(value,)], "v double")
    row = df.select(
        fixed_point(F.col("v"), scale).alias("r"), fixed_point(F.col("v"), scale, "truncate").alias("t")
    ).first()
    assert (str(row.r), str(row.t)) == (rounded, truncated)
    with pytest.raises(ValueError):
        fixed_point(F.col("v"), 0, "up")


def test_hash_key_collides_within_a_second(plays):
    keyed = plays.select(
        hash_key(F.col("sessionId"), start_time("ts", True)).alias("k"), "sessionId", "ts"
    )
    assert keyed.select("k").distinct().count() == 3
    import hashlib

    expected = hashlib.md5(b"1392018-11-01 21:01:46").hexdigest()
    assert expected in {r.k for r in keyed.collect()}


def test_hash_key_of_a_missing_part_is_missing(spark):
    df = spark.sql("SELECT CAST(NULL AS INT) AS a, 'x' AS b")
    assert df.select(hash_key(F.col("a"), F.col("b")).alias("k")).first().k is None


def test_dense_keys_follow_the_order(spark):
    df = spark.range(1000).selectExpr("id", "(id * 7919) % 1000 AS place").repartition(7)
    keyed = dense_key(df, ["place"], start=5).orderBy("place").collect()
    assert [r.songplay_id for r in keyed] == list(range(5, 1005))
    assert [r.place for r in keyed] == list(range(1000))


def test_dense_keys_without_an_order_need_no_shuffle(spark):
    df = spark.range(0, 1000, 1, 6)
    keyed = dense_key(df)
    assert sorted(r.songplay_id for r in keyed.collect()) == list(range(1, 1001))
    assert dense_key(df.filter("id < 0")).count() == 0


def test_dense_keys_of_copies(spark, monkeypatch):
    """A third of the rows are equal; they get different numbers and several tasks."""
    kept = []
    monkeypatch.setattr(keys, "materialize", lambda df, label: kept.append(materialize(df, label)) or kept[0])
    df = spark.range(0, 900, 1, 9).selectExpr("IF(id % 3 = 0, 500, id) AS place", "'x' AS name")
    # Adaptive execution would put so little data into one task.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keyed = dense_key(df, ["place"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    rows = sorted(tuple(r) for r in keyed.collect())
    assert [r[0] for r in rows] == list(range(1, 901))
    assert [r[1] for r in rows] == sorted(r[1] for r in rows)
    files = kept[0].filter("place = 500").selectExpr("input_file_name() AS f").distinct()
    assert files.count() > 1


def test_written_numbers_are_unique(spark, tmp_path):
    df = spark.range(0, 400, 1, 5).selectExpr("id", "id % 3 AS part")
    write_table(df, str(tmp_path / "t"), partition_by=["part"], number="n")
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == stored.select("n").distinct().count() == 400
