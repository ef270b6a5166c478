from datetime import datetime

from tablesync.operators import catalog as c
from tablesync.operators.keys import KeyList

PAIR = "table_schema string, table_name string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_missing_tables_ignores_case_and_repeats(spark):
    source = spark.createDataFrame(
        [("app1", "users")] * 500 + [("App2", "users"), ("app2", "users"), ("app3", "t")], PAIR
    )
    target = spark.createDataFrame([("APP1", "USERS")] * 300 + [("APP3", "X")], PAIR)
    missing = c.missing_tables(source, target)
    assert rows(missing) == [("App2", "users"), ("app2", "users"), ("app3", "t")]
    assert rows(c.missing_tables(source, source)) == []


def test_snapshot(spark):
    tables = spark.createDataFrame(
        [
            ("app1", "all_data", "BASE TABLE"),
            ("app1", "statuses", "VIEW"),
            ("app1", "other", "BASE TABLE"),
            ("INFORMATION_SCHEMA", "statuses", "SYSTEM"),
            (None, "statuses", "BASE TABLE"),
        ],
        "Table_Schema string, Table_Name string, Table_type string",
    )
    found = c.catalog_snapshot(tables, run_ts=datetime(2024, 1, 1))
    assert found.columns == ["src_schema", "src_table", "tgt_schema", "tgt_table", "synced_at"]
    assert [tuple(r)[:4] for r in found.collect()] == [("app1", "all_data", "", "")]


def test_column_catalog(spark):
    columns = spark.createDataFrame(
        [("APP1", "ALL_DATA", "ID", "NUMBER"), ("APP1", "T", "ID", "TEXT"), ("APP2", "T", "A", "X")],
        "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string",
    )
    schemas = spark.createDataFrame([("app1",), ("app1",)], "table_schema string")
    assert rows(c.column_catalog(columns, schemas, only="ALL_DATA")) == [
        ("app1", "all_data", "id", "number")
    ]
    assert rows(c.column_catalog(columns, schemas, exclude="ALL_DATA")) == [
        ("app1", "t", "id", "text")
    ]


def test_union_is_by_name(spark):
    first = spark.createDataFrame([("s", "t")], PAIR)
    second = spark.createDataFrame([("u", "r")], "table_name string, table_schema string")
    assert rows(c.union_catalogs(first, second, first)) == [("r", "u"), ("s", "t"), ("s", "t")]


def test_split_available_keeps_every_row(spark):
    changes = spark.createDataFrame(
        [("app1", "t", 1), ("APP1", "T", 2), ("app2", "t", 3), (None, "t", 4)],
        "schema_name string, table_name string, id int",
    )
    available = spark.createDataFrame([("App1", "t")], "schema_name string, table_name string")
    known, unknown = c.split_available(changes, available)
    assert [r.id for r in known.orderBy("id").collect()] == [1, 2]
    assert [r.id for r in unknown.orderBy("id").collect()] == [3, 4]
    assert known.columns == changes.columns


def test_key_list_with_and_without_broadcast(spark):
    # One key holds most rows.
    df = spark.range(3000).selectExpr("if(id % 3 = 0, id, 7) as k", "id")
    keys = spark.createDataFrame([(7,), (7,), (9,), (5,)], "k long")
    small = KeyList.of(keys, ["k"])
    large = KeyList.of(keys, ["k"], broadcast_bytes=0)
    assert small.small and not large.small
    assert "Broadcast" in small.keep(df)._jdf.queryExecution().toString()
    for made in (small, large):
        assert made.keep(df).count() == 2001
        assert made.drop(df).count() == 999


def test_declared_schema(spark):
    columns = spark.createDataFrame(
        [
            ("a", "T", "ID", "NUMBER", 38, 0),
            ("b", "t", "id", "number", 10, 0),
            ("a", "t", "price", "NUMBER", 10, 2),
            ("b", "t", "price", "NUMBER", 12, 1),
            ("a", "t", "wide", "NUMBER", 38, 0),
            ("b", "t", "wide", "NUMBER", 38, 20),
            ("a", "t", "unsized", "NUMBER", None, None),
            ("a", "t", "at", "TIMESTAMP_NTZ", None, None),
            ("a", "t", "mixed", "TEXT", None, None),
            ("b", "t", "mixed", "NUMBER", 5, 0),
            ("a", "t", "odd", "GEOGRAPHY", None, None),
            ("a", "other", "x", "TEXT", None, None),
        ],
        "table_schema string, table_name string, column_name string, data_type string, "
        "numeric_precision int, numeric_scale int",
    )
    found = {f.name: f.dataType.simpleString() for f in c.declared_schema(columns, "T").fields}
    assert found == {
        "at": "timestamp_ntz",
        "id": "decimal(38,0)",
        "mixed": "string",
        "odd": "string",
        "price": "decimal(13,2)",
        "unsized": "string",
        "wide": "string",
    }
    # Without sizes a number stays text, which keeps its fraction.
    bare = columns.drop("numeric_precision", "numeric_scale")
    assert c.declared_schema(bare, "T")["price"].dataType.simpleString() == "string"
    kept = c.column_catalog(columns, columns.select("table_schema"))
    assert c.declared_schema(kept, "t")["price"].dataType.simpleString() == "decimal(13,2)"
    assert c.declared_schema(columns, "none").fields == []
