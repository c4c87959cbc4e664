"""Every registered query against its SQL, on the smallest test tables."""

import pytest

import check
from __spark_entry__ import entry
from starloom.workloads import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, name):
    assert check.compare(spark, SF_DIR, name, oracle_sql()[name]) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 6000
    assert len(df.columns) == 13
