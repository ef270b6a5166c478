"""Types of columns that differ between tenants."""

from itertools import permutations

import pytest
from pyspark.sql import types as T

from tablesync.operators import widening as w
from tablesync.plans.catalogs import Shape
from tablesync.plans.changes import apply_new
from tablesync.plans.loads import full_load
from tablesync.sinks.appended import AppendedTable
from tablesync.sinks.ledger import FileLedger
from tablesync.sources.database import FrameTables


def kind(text):
    return T.StructType.fromDDL(f"x {text}")["x"].dataType


@pytest.mark.parametrize(
    "kinds, wide",
    [
        ("int int", "int"), ("smallint int bigint", "bigint"), ("int decimal(5,2)", "decimal(12,2)"),
        ("bigint decimal(30,2)", "decimal(30,2)"), ("bigint decimal(10,2)", "decimal(21,2)"), ("bigint decimal(38,30)", "string"), ("int double", "double"),
        ("smallint float", "float"), ("int float", "double"), ("bigint double", "string"), ("int bigint double", "string"),
        ("decimal(5,2) double", "string"), ("float double", "double"), ("date timestamp_ntz", "timestamp_ntz"),
        ("date int", "string"), ("boolean int", "string"), ("void int", "int"), ("decimal(9,0) double", "double"),
    ],
)
def test_the_least_type_above(spark, kinds, wide):
    # Whatever order they come in.
    for order in permutations(kinds.split()):
        assert w.wider_type([kind(k) for k in order]) == kind(wide)


def test_schemas_are_matched_without_case(spark):
    found = w.wider_schema(T.StructType.fromDDL("Id int, a date"), T.StructType.fromDDL("b string, ID bigint"))
    assert found.simpleString() == "struct<Id:bigint,a:date,b:string>"


CATALOG = "table_schema string, table_name string, column_name string, data_type string, numeric_precision int, numeric_scale int"


@pytest.fixture
def catalog(spark):
    rows = [
        ("app1", "users", "username", "text", None, None), ("app2", "USERS", "USERNAME", "varchar", None, None),
        ("app1", "users", "score", "int", None, None), ("app2", "users", "score", "number", 8, 2),
        ("app1", "all_data", "v", "int", None, None), ("app2", "all_data", "v", "text", None, None),
    ]
    return spark.createDataFrame(rows, CATALOG)


def test_loads_and_changes_take_the_catalog(spark, tmp_path, catalog):
    shape = Shape(f"{tmp_path}/t", ("ts",), "ts bigint", "op")
    with pytest.raises(ValueError, match="other"):
        shape.target(catalog, "other")
    routes = {name: shape.route(catalog, name, "json") for name in ("users", "all_data")}
    assert isinstance(routes["all_data"].target, AppendedTable)
    users = routes["users"].target
    assert T.StructType.fromDDL(users.schema)["score"].dataType == T.DecimalType(12, 2)
    source = spark.createDataFrame([("app1", "a", 7)], "schema_name string, username string, score int")
    control = spark.createDataFrame([("app1", True)], "app_id string, flag boolean")
    from datetime import datetime

    full_load(spark, FrameTables({"users": source}), control, ["users"], lambda n: users, f"{tmp_path}/log", datetime(2024, 1, 1))
    for place, text in (
        ("app2/users", '{"username": "b", "score": 1.25, "ts": 1, "op": "U"}'),
        ("app1/users", '{"username": "a", "score": 9, "ts": 1, "op": "U"}'),
        ("app1/all_data", '{"v": 5, "ts": 1}'),
        ("app2/all_data", '{"v": "five"}'),
    ):
        folder = tmp_path / "in" / "events" / place
        folder.mkdir(parents=True)
        (folder / "f.json").write_text(text)
    apply_new(spark, f"{tmp_path}/in/events", routes, FileLedger(f"{tmp_path}/ledger"))
    assert sorted((r.schema_name, r.username, str(r.score)) for r in users.current(spark).collect()) == [
        ("app1", "a", "9.00"), ("app2", "b", "1.25"),
    ]
    rows = routes["all_data"].target.current(spark).collect()
    assert sorted((r.schema_name, r.v) for r in rows) == [("app1", "5"), ("app2", "five")]
