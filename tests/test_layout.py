"""Rows laid out by two columns at once."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.layout import borders, by_several, replace_groups
from starloom.operators.load import write_table
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def songs(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, *range(1950, 2020)]), f"AR{rng.randrange(400):05d}") for i in range(6000)]
    return spark.createDataFrame(rows, "song_id long, year int, artist_id string")


def files_of(df):
    return df.select(F.col("_metadata.file_name")).distinct().count()


def test_a_filter_on_either_column_finds_rows_in_few_files(spark, tmp_path, songs):
    path = str(tmp_path / "songs")
    by_several(songs, ["year", "artist_id"], files=36).write.parquet(path)
    stored = spark.read.parquet(path)
    assert rows_of(stored) == rows_of(songs)
    assert files_of(stored) >= 30
    # A square of six by six: each filter meets about a row or a column of it.
    assert files_of(stored.filter("year = 1999")) <= 14
    assert files_of(stored.filter("artist_id = 'AR00200'")) <= 14
    assert files_of(stored.filter("year = 1999 AND artist_id BETWEEN 'AR00200' AND 'AR00210'")) <= 4


def test_one_pair_with_most_rows_spans_files(spark, tmp_path):
    rows = spark.range(4000).select("id", F.lit(1).alias("a"), F.lit("x").alias("b")).repartition(8)
    by_several(rows, ["a", "b"], files=4).write.parquet(str(tmp_path / "t"))
    assert files_of(spark.read.parquet(str(tmp_path / "t"))) > 1


def test_empty_and_null_only(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert borders(empty, "a") == [] and by_several(empty, ["a", "b"]).count() == 0
    nulls = spark.createDataFrame([(None, None)] * 3, "a int, b string")
    assert by_several(nulls, ["a", "b"]).count() == 3


def test_replacing_pairs_equals_replacing_directories(spark, tmp_path, songs):
    first, second = songs.filter("song_id % 2 = 1 AND song_id < 800"), songs.filter("song_id % 2 = 0 AND song_id < 300")
    root = str(tmp_path / "directories")
    write_table(first.filter("year > 2010"), root, partition_by=["year", "artist_id"])
    write_table(second.filter("year > 2010"), root, partition_by=["year", "artist_id"], only_touched_partitions=True)
    want = spark.read.schema(songs.schema).parquet(root).select(*songs.columns)
    got = replace_groups(first.filter("year > 2010"), second.filter("year > 2010"), ["year", "artist_id"])
    assert rows_of(got) == rows_of(want)
    nulls = spark.createDataFrame([(9, None, "AR1")], songs.schema)
    assert replace_groups(nulls, nulls, ["year", "artist_id"]).count() == 1
