"""Bucketed tables and the plans of their joins."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starloom.operators.colocated import forget, write_colocated
from starloom.workloads import queries
from tests.conftest import plan_of, rows_of

SF_DIR = "/root/testdata/sf0.001"


def test_the_join_of_lines_and_orders_has_no_exchange(spark):
    joined = queries()["star_retrieval_colocated"](spark, SF_DIR)
    plan = plan_of(joined, "simple")
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan_of(joined)
    assert "Exchange hashpartitioning" not in plan
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    assert joined.count() == lines.count()


def test_tables_that_are_taken_out_of_the_catalog_stay_readable(spark, tmp_path):
    rows = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    stored = write_colocated(rows, "forgotten", "id", 4, str(tmp_path / "t"))
    forget(spark, "forgotten")
    assert not spark.catalog.tableExists("forgotten")
    assert rows_of(stored) == rows_of(rows)
    assert len(list((tmp_path / "t").glob("part-*"))) == 4


def test_a_key_with_too_many_rows_raises(spark, tmp_path):
    rows = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("id"))
    with pytest.raises(ValueError, match="400 of 1000"):
        write_colocated(rows, "uneven", "id", 4, str(tmp_path / "t"), few_rows=100)
    write_colocated(rows, "uneven", "id", 4, str(tmp_path / "u"))
    forget(spark, "uneven")
    empty = write_colocated(rows.limit(0), "empty", "id", 4, str(tmp_path / "e"))
    assert empty.count() == 0
    forget(spark, "empty")
