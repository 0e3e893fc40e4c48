"""Every catalog query against its SQL twin on the smallest data."""

import glob
import os

import pytest
from conftest import SF

import __spark_entry__ as entry
from compare import normal
from oracle_queries import SQL
from runlake.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return db


def test_every_catalog_query_has_a_twin():
    assert QUERIES.keys() == SQL.keys() and QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, con, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), con.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)
