"""Comparison by checksums: in Spark, and as SQL text that DuckDB runs."""

import random
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from tablesync.operators import checksums as c
from tablesync.operators.reconcile import reconcile_rows

DUCKDB = c.Dialect(
    number="CAST(('0x' || SUBSTR({0}, {1}, 8)) AS BIGINT)",
    text="CAST({0} AS VARCHAR)",
    length="LENGTH({0})",
    timestamp="STRFTIME({0}, '%Y-%m-%d %H:%M:%S.%f')",
)
ROW = "id long, name string, price decimal(10,2), ratio double, moment timestamp_ntz, day date, flag boolean, schema_name string"


def some_rows(n, seed=1):
    rng = random.Random(seed)

    def row(i):
        return (
            i,
            rng.choice([None, "", "n", "v1:x", "ümlaut", "a'b", "x" * 40]),
            rng.choice([None, Decimal("1.50"), Decimal("-0.01"), Decimal("12345678.90")]),
            rng.choice([None, 0.25, -3.5, 1e6, 0.0]),
            rng.choice([None, datetime(2024, 1, 2, 3, 4, 5, 678900), datetime(1969, 12, 31)]),
            rng.choice([None, date(2024, 2, 29)]),
            rng.choice([None, True, False]),
            rng.choice(["app1", "app2"]),
        )

    return [row(i) for i in range(n)]


def changed(rows):
    out = [list(r) for r in rows if r[0] % 97 != 5]
    for r in out:
        if r[0] % 89 == 7:
            r[1] = "changed"
    out += [[10_000, "extra", None, None, None, None, None, "app2"], [3, "again", None, None, None, None, None, "app1"]]
    return [tuple(r) for r in out]


@pytest.fixture(scope="module")
def sides(spark):
    rows = some_rows(600)
    return spark.createDataFrame(rows, ROW), spark.createDataFrame(changed(rows), ROW), rows


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("by", [(), ("schema_name",)])
def test_same_as_by_row(sides, by):
    source, target, _ = sides
    what = c.Compared.of(source, ["id"] if by else ["schema_name", "id"], by)
    tree = c.reconcile_tree(c.FrameSide(source), c.FrameSide(target), what, (3, 9))
    assert found(tree) == found(reconcile_rows(source, target, ["schema_name", "id"])) and tree.count() > 10
    same = c.reconcile_tree(c.FrameSide(source), c.FrameSide(source), what)
    assert same.count() == 0


def test_only_differing_buckets_are_read(spark, sides, tmp_path):
    source, target, _ = sides
    source.write.partitionBy("schema_name").parquet(f"{tmp_path}/t")
    stored = spark.read.schema(source.schema).parquet(f"{tmp_path}/t").select(source.columns)
    one = source.where("not (schema_name = 'app1' and id % 50 = 0)")
    what = c.Compared.of(source, ["id"], ["schema_name"])
    within = c.differing_buckets(c.FrameSide(one), c.FrameSide(stored), what, (4, 12))
    gone = source.count() - one.count()
    rows = c.FrameSide(stored).rows(what, within)
    assert 0 < within.frame.count() <= gone and gone <= rows.count() < 3 * gone
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(schema_name" in plan and "app1" in plan and "app2" not in plan


def test_repeated_rows_and_missing_groups(spark):
    schema = "id long, v string, g string"
    one = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "b", "x")], schema)
    two = spark.createDataFrame([(1, "a", None), (2, "b", "x")], schema)
    what = c.Compared.of(one, ["id"], ["g"])
    tree = c.reconcile_tree(c.FrameSide(one), c.FrameSide(two), what)
    assert found(tree) == [(None, 1, "missing")]


def database(spark, rows):
    con = duckdb.connect()
    seen = []
    kinds = "id bigint, name varchar, price decimal(10,2), ratio double, moment timestamp, day date, flag boolean"
    for tenant in ("app1", "app2"):
        con.execute(f'create schema "{tenant}"')
        con.execute(f'create table "{tenant}"."users" ({kinds})')
        mine = [r[:-1] for r in rows if r[-1] == tenant]
        con.executemany(f'insert into "{tenant}"."users" values (?, ?, ?, ?, ?, ?, ?)', mine)

    def read(query):
        seen.append(query)
        return spark.createDataFrame(con.sql(query).to_arrow_table())

    return read, seen


@pytest.mark.parametrize("most", [2000, 1])
def test_the_database_forms_the_same_checksums(spark, sides, most):
    source, target, rows = sides
    read, seen = database(spark, rows)
    what = c.Compared.of(source, ["id"], ["schema_name"], digits=6)
    db = c.DatabaseSide(spark, read, "users", ["app1", "app2"], DUCKDB, most_buckets=most)
    for bits in (0, 4, 16):
        assert found(db.sums(what, bits)) == found(c.FrameSide(source).sums(what, bits))
    tree = c.reconcile_tree(db, c.FrameSide(target), what, (3, 9))
    assert found(tree) == found(reconcile_rows(source, target, ["schema_name", "id"]))
    assert any("IN (" in q for q in seen) == (most > 1)
    assert c.reconcile_tree(db, c.FrameSide(source), what).count() == 0


def test_sql_of_other_databases(sides):
    what = c.Compared.of(sides[0].select("id", "name", "schema_name"), ["id"], ["schema_name"])
    sql = c.ChecksumSql("users", what, c.MYSQL, "`").sums({"app'1": [1, 2]}, 8, 4)
    assert "FROM `app'1`.`users` WHERE FLOOR(CAST(CONV(SUBSTR(MD5(" in sql and "IN (1, 2)" in sql
    assert sql.startswith("SELECT 'app''1' AS schema_name, bucket")
    fractions = c.Compared.of(sides[0].select("id", "ratio", "schema_name"), ["id"], ["schema_name"])
    with pytest.raises(ValueError, match="digits"):
        c.ChecksumSql("users", fractions).sums({"a": None}, 8)
