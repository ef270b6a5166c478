"""Queries on training text against their SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as registry
from tablesync.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(registry.queries())
    assert sum(name.startswith("op") for name in registry.queries()) == 13


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    found = QUERIES[name](spark, SF)
    order = sorted(found.columns)
    rows = [tuple(row) for row in found.select(order).collect()]
    wanted = con.sql(f"select {', '.join(order)} from ({ORACLES[name]}) q").fetchall()
    assert rows and sorted(rows, key=repr) == sorted(wanted, key=repr)
