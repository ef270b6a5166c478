"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as registry
from tablesync.checks.oracles import ORACLES
from tablesync.checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(registry.queries()) & set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    found = QUERIES[name](spark, SF)
    order = sorted(found.columns)
    wanted = duck.sql(ORACLES[name])
    assert sorted(wanted.columns) == order
    columns = ", ".join(f'"{c}"' for c in order)
    expected = wanted.query("q", f"select {columns} from q").fetchall()
    rows = [tuple(row) for row in found.select(order).collect()]
    assert rows
    assert sorted(rows, key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    assert registry.entry(spark).count() > 0
