"""No database is started: SQL text runs in DuckDB, option setting on a stand-in."""

from datetime import date, datetime

import duckdb
import pytest

from tablesync.sources import database as d


class Recorder:
    """Stands in for a session or writer, and keeps what it is told."""

    def __init__(self):
        self.seen = {}

    @property
    def read(self):
        return self

    write = read

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **more):
        self.seen.update(more)
        return self

    def option(self, name, value):
        self.seen[name] = value
        return self

    def mode(self, name):
        self.seen["mode"] = name
        return self

    def load(self):
        return self.seen

    def save(self):
        pass


CONN = d.Connection({"url": "jdbc:some", "driver": "x"})


def test_reads():
    assert d.read_table(Recorder(), CONN, "information_schema.tables") == {
        "format": "jdbc", "fetchsize": "10000", "url": "jdbc:some", "driver": "x",
        "dbtable": "information_schema.tables",
    }
    assert d.read_query(Recorder(), CONN, "SELECT 1 ;\n")["query"].strip() == "SELECT 1"
    seen = d.read_snapshot(Recorder(), CONN, "t", "id", (1, 90), 4)
    assert (seen["partitionColumn"], seen["lowerBound"], seen["upperBound"], seen["numPartitions"]) == (
        "id", "1", "90", "4",
    )


def test_writes():
    from tablesync.sinks.tables import refresh_table, write_table

    made = Recorder()
    refresh_table(made, "stage.t", CONN)
    assert made.seen["mode"] == "overwrite" and made.seen["truncate"] == "true"
    made = Recorder()
    write_table(made, "stage.t", "errorifexists", CONN)
    assert made.seen["mode"] == "errorifexists" and "truncate" not in made.seen


@pytest.fixture
def duck():
    con = duckdb.connect()
    con.execute("create schema app1; create schema \"o'x\"")
    # A third of the keys is one value; some are null.
    con.execute(
        "create table app1.t as select case when i % 3 = 0 then 5 when i % 50 = 1 then null "
        "else i end as seq, i as n from range(900) r(i)"
    )
    con.execute("create table \"o'x\".t as select i as seq, i as n from range(7) r(i)")
    return con


def asking(duck, seen):
    def ask(spark, conn, query):
        seen.append(query)
        rows = duck.sql(query).fetchall()
        return spark.createDataFrame(rows, "FIRST_KEY long")

    return ask


def test_tenant_reads_cover_every_row_once(spark, duck, monkeypatch):
    seen = []
    monkeypatch.setattr(d, "read_query", asking(duck, seen))
    splits = d.find_splits(spark, CONN, "t", "seq", ["app1"], 150)
    keys = splits["t", "app1"]
    # A third of all rows has one key; the others are in ranges of 150.
    assert keys[0] == 2 and len(keys) in (4, 5) and len(seen) == len(keys) + 1
    assert not any("OVER" in q or "GROUP" in q for q in seen)
    tables = d.DatabaseTables(spark, CONN, split_columns={"t": "seq"}, splits=splits, batch=2)
    duck.execute("create schema app3; create table app3.t as select 1 as seq, 1 as n")
    tenants = spark.createDataFrame([("app1",), ("o'x",), ("app1",), ("app3",)], "schema_name string")
    reads = list(tables.reads("t", tenants))
    # The large tenant alone, in its ranges; the small ones together, once.
    assert sorted(len(predicates) for _, predicates in reads) == [1, len(keys)]
    assert all(("UNION ALL" in query) == (predicates == ["1 = 1"]) for query, predicates in reads)
    found = []
    for query, predicates in reads:
        for predicate in predicates:
            found.append(duck.sql(f"select schema_name, n from ({query}) x where {predicate}").fetchall())
    assert max(map(len, found)) < 300 + 2 * 150
    rows = [row for part in found for row in part]
    assert len(rows) == len(set(rows)) == 908
    counts = dict(row for query, _ in reads for row in duck.sql(d.count_query(query)).fetchall())
    assert counts == {"app1": 900, "o'x": 7, "app3": 1}


def test_ranges_follow_the_order_of_the_database(duck):
    duck.execute("create table words as select unnest(['b', 'A', 'a', 'C', 'c', 'B', null]) as k")
    found, keys = [], []
    while row := duck.sql(d.probe_query("words", "k COLLATE NOCASE", keys[-1] if keys else None, 1 if keys else 0)).fetchall():
        keys.append(row[0][0])
    for predicate in d.range_predicates("k COLLATE NOCASE", keys):
        found += duck.sql(f"select k from words where {predicate}").fetchall()
    assert sorted(str(k) for k, in found) == sorted(["b", "A", "a", "C", "c", "B", "None"])


def test_ranges():
    assert d.range_predicates("k", [1, 1, 1]) == ["1 = 1"]
    assert d.range_predicates("k", ["a", "m", "t"]) == [
        "(k < 'm' OR k IS NULL)", "k >= 'm' AND k < 't'", "k >= 't'",
    ]
    days = [datetime(2024, 1, 1), datetime(2024, 2, 1, 3), date(2024, 3, 1)]
    assert d.range_predicates("k", days)[1] == "k >= TIMESTAMP '2024-02-01 03:00:00.000000' AND k < DATE '2024-03-01'"


def test_checksums_of_tenants(spark, monkeypatch):
    from tablesync.operators.checksums import MYSQL

    seen = []
    monkeypatch.setattr(d, "read_query", lambda spark, conn, query: seen.append(query) or spark.createDataFrame(
        [("a", 0, 1, 2, 3)], "SCHEMA_NAME string, BUCKET long, N long, ONE long, TWO long"))
    tenants = spark.createDataFrame([("app1",), ("app2",), ("app3",)], "schema_name string")
    rows = spark.createDataFrame([("app1", 1, 0.5)], "schema_name string, id long, ratio double")
    plain = d.DatabaseTables(spark, CONN, batch=2)
    assert plain.sums("users", tenants, rows) is None
    what, found = d.DatabaseTables(spark, CONN, batch=2, dialect=MYSQL).sums("users", tenants, rows)
    assert found.columns == ["schema_name", "bucket", "n", "one", "two"] and len(seen) == 2
    assert seen[0].count("UNION ALL") == 1 and "DECIMAL(38, 6)" in seen[0] and what.by == ("schema_name",)
