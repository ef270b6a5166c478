"""Reads that go on where the last one ended."""

from datetime import datetime, timedelta

import duckdb
import pytest

from tablesync.plans.increments import pull_increment
from tablesync.sinks.bookmark import Bookmark
from tablesync.sinks.target import TargetTable
from tablesync.sources import database as d
from tablesync.sources import growing as b

ROW = "id long, value string, changed timestamp_ntz, schema_name string"
DAYS = b.Growing("changed", timedelta(days=2))


def at(day):
    return datetime(2024, 1, day, 12)


@pytest.fixture
def target(tmp_path):
    return TargetTable(f"{tmp_path}/t", ("id",), ("changed",), schema=ROW)


def held(spark, target):
    return sorted((r.schema_name, r.id, r.value) for r in target.current(spark).collect())


def test_predicates():
    ids = b.Growing("seq", 5)
    assert ids.predicate(None, "90") == '("seq" <= 90 OR "seq" IS NULL)'
    assert ids.predicate(ids.low("70"), "90", "`") == "`seq` >= 65 AND `seq` <= 90"
    assert ids.predicate("65", None) == "1 = 1"
    low = DAYS.low("2024-01-05 12:00:00.000000")
    assert DAYS.predicate(low, "2024-01-09 00:00:00.500000") == (
        "\"changed\" >= TIMESTAMP '2024-01-03 12:00:00.000000' AND \"changed\" <= TIMESTAMP '2024-01-09 00:00:00.500000'"
    )
    assert b.high_query("t", ["o'k"], ids) == 'SELECT \'o\'\'k\' AS schema_name, MAX("seq") AS high FROM "o\'k"."t"'


def test_late_rows_and_new_tenants(spark, tmp_path, target):
    marks = Bookmark(f"{tmp_path}/marks")
    first = [(1, "a", at(1), "App1"), (2, "b", at(5), "App1"), (3, "no time", None, "App1")]
    second = first + [(4, "late", at(4), "App1"), (2, "b2", at(6), "App1"), (9, "new", at(1), "app2"), (5, "too late", at(1), "App1")]

    def pull(rows, tenants):
        source = b.GrowingFrames({"t": spark.createDataFrame(rows, ROW)})
        named = spark.createDataFrame([(t,) for t in tenants], "schema_name string")
        return pull_increment(spark, source, "t", named, target, marks, DAYS)

    pull(first, ["app1"])
    assert held(spark, target) == [("app1", 1, "a"), ("app1", 2, "b"), ("app1", 3, "no time")]
    for _ in range(2):
        pull(second, ["APP1", "app2", "empty"])
        known = [("app1", 1, "a"), ("app1", 2, "b2"), ("app1", 3, "no time"), ("app1", 4, "late"), ("app2", 9, "new")]
        assert held(spark, target) == known
    assert sorted(map(tuple, marks.marks(spark, "T").collect())) == [
        ("app1", "2024-01-06 12:00:00.000000"), ("app2", "2024-01-01 12:00:00.000000"),
    ]
    marks.reset(spark, "t", ["APP1"])
    pull(second, ["app1"])
    assert ("app1", 5, "too late") in held(spark, target)


def test_the_bookmark_stays_if_the_merge_fails(spark, tmp_path, target, monkeypatch):
    marks = Bookmark(f"{tmp_path}/marks")
    source = b.GrowingFrames({"t": spark.createDataFrame([(1, "a", at(1), "app1")], ROW)})
    tenants = spark.createDataFrame([("app1",)], "schema_name string")
    with monkeypatch.context() as broken:
        broken.setattr(TargetTable, "merge", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            pull_increment(spark, source, "t", tenants, target, marks, DAYS)
    assert marks.marks(spark, "t").isEmpty()
    pull_increment(spark, source, "t", tenants, target, marks, DAYS)
    assert held(spark, target) == [("app1", 1, "a")]
    with pytest.raises(ValueError, match="by key"):
        pull_increment(spark, source, "t", tenants, TargetTable("x", (), ()), marks, DAYS)


def test_the_database_reads_the_same_rows(spark, tmp_path, target, monkeypatch):
    con, seen = duckdb.connect(), []
    for tenant in ("app1", "app2", "app3"):
        con.execute(f'create schema "{tenant}"')
        con.execute(f'create table "{tenant}"."t" (id bigint, value varchar, changed timestamp)')

    def read(spark, conn, query):
        seen.append(query)
        return spark.createDataFrame(con.sql(query).to_arrow_table())

    monkeypatch.setattr(d, "read_query", read)
    source = d.DatabaseTables(spark, d.Connection({"url": "x"}), batch=2)
    tenants = spark.createDataFrame([("app1",), ("app2",), ("app3",)], "schema_name string")
    marks, rows = Bookmark(f"{tmp_path}/marks"), []
    for day in (1, 3, 6):
        con.execute(f"insert into app1.t values ({day}, 'x', '2024-01-0{day} 12:00:00')")
        con.execute(f"insert into app2.t values ({day}, 'y', '2024-01-0{day} 13:30:00.25')")
        rows += [("app1", day, "x"), ("app2", day, "y")]
        seen.clear()
        pull_increment(spark, source, "t", tenants, target, marks, DAYS)
        assert held(spark, target) == sorted(rows)
    # Two tenants a query, for the highest values and for the rows; the first days are not asked for again.
    assert len(seen) == 4 and sum("2024-01-01 1" in q for q in seen) == 1
