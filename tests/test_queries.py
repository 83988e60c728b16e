"""Every registered query of the library against its SQL, and the entry points."""

import math
import os

import duckdb
import pandas as pd
import pytest

from tessera.queries import ORACLES, QUERIES

WINDOWS = {"window_align_numbered", "window_align_marker", "window_align_other", "anchor_search"}


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)) or value is pd.NA:
        return None
    return int(value) if isinstance(value, float) and value.is_integer() else value


def rows(frame):
    return sorted(str([plain(x) for x in row]) for row in frame[sorted(frame.columns)].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.sql(f"create view {name.split('.')[0]} as select * from read_parquet('{sf_dir}/{name}')")
    return con


def test_which_have_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sql, sf_dir, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), sql.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(WINDOWS))
def test_windows_do_not_depend_on_partitioning(spark, sf_dir, name):
    first = rows(QUERIES[name](spark, sf_dir).toPandas())
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert rows(QUERIES[name](spark, sf_dir).toPandas()) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())
