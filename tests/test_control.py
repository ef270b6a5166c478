from datetime import datetime

from tablesync.config import FULL_LOAD_TABLES
from tablesync.operators import control as c

CONTROL = "app_id string, flag boolean, fullload_timestamp string"
LOG = "app_id string, table_name string, status string, message string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_insert_if_absent_is_idempotent(spark):
    control = spark.createDataFrame([("APP1", True, None)], CONTROL)
    tenants = spark.createDataFrame([("app1",), ("APP2",), ("APP2",)], "app_id string")
    once = c.insert_if_absent(control, tenants)
    assert rows(once) == [("APP1", True, None), ("APP2", None, None)]
    assert rows(c.insert_if_absent(once, tenants)) == rows(once)


def test_plan(spark):
    control = spark.createDataFrame(
        [("APP1", True, None), ("app1", True, "x"), ("app2", False, None), ("app3", None, None)],
        CONTROL,
    )
    plan = c.full_load_plan(control)
    assert plan.count() == len(FULL_LOAD_TABLES) == 19
    assert {r.app_id for r in plan.collect()} == {"app1"}


def test_clear_flags(spark):
    control = spark.createDataFrame(
        [("APP1", True, None), ("app2", True, "old"), ("app3", True, None), ("app4", False, "old")],
        CONTROL,
    )
    log = spark.createDataFrame(
        [("app1", "t", "ok", None), ("app2", "t", "failed", "x"), ("app2", "u", "ok", None)], LOG
    )
    done = c.clear_flags(control, log, datetime(2024, 1, 2, 3, 4, 5), only_run=True)
    assert rows(done) == [
        ("APP1", False, "2024-01-02 03:04:05"),
        ("app2", True, "old"),
        ("app3", True, None),
        ("app4", False, "old"),
    ]
    flags = {r.app_id: r.flag for r in c.clear_flags(control, log).collect()}
    assert flags == {"APP1": False, "app2": True, "app3": False, "app4": False}


def test_a_tenant_of_several_spellings_is_inserted_once(spark):
    control = spark.createDataFrame([], CONTROL)
    tenants = spark.createDataFrame([("a",), ("A",), ("b",)], "app_id string")
    assert rows(c.insert_if_absent(control, tenants)) == [("A", None, None), ("b", None, None)]
