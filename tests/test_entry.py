"""Every registered query against its SQL statement on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from bindings.queries import QUERIES
from check import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    note, ok = compare(spark, con, name, SF)
    assert ok, note


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["split_id", "entity_id"]


def test_oracles_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
