from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablesync.operators.catalog import missing_tables
from tablesync.operators.reconcile import reconcile_rows
from tablesync.plans.changes import apply_landing, register_tenants
from tablesync.plans.loads import LoadFailed, full_load, load_missing, target_catalog
from tablesync.sinks.tables import ensure_schema, refresh_table, replace_folder, write_table
from tablesync.sinks.target import TargetTable
from tablesync.sources.database import FrameTables

ROW = "schema_name string, id int, value string"


@pytest.fixture
def world(spark, tmp_path):
    frames = {
        "users": spark.createDataFrame(
            [("app1", n, "u") for n in range(30)] + [("app2", 1, "u"), ("app3", 1, "u")], ROW
        ),
        "seg": spark.createDataFrame([("app1", 1, "s"), ("app2", 2, "s")], ROW),
    }
    targets = {
        name: TargetTable(
            f"{tmp_path}/{name}", ("id",), ("ts",), schema="id int, value string, ts int, schema_name string"
        )
        for name in frames
    }
    catalog = frames["users"].select(
        F.upper("schema_name").alias("table_schema"), F.lit("users").alias("table_name")
    ).union(frames["seg"].select("schema_name", F.lit("seg")))
    return FrameTables(frames), targets, catalog


def lower_schema(df):
    return df.withColumn("table_schema", F.lower("table_schema"))


def test_missing_is_empty_on_rerun(spark, tmp_path, world):
    source, targets, catalog = world
    catalog = lower_schema(catalog)
    # app9 has the table, but no row in it.
    catalog = catalog.union(spark.createDataFrame([("app9", "seg")], catalog.schema))
    assert missing_tables(catalog, target_catalog(spark, targets)).count() == 6
    log = load_missing(
        spark, source, catalog, target_catalog(spark, targets), targets.get, f"{tmp_path}/log"
    )
    assert log.count() == 6 and log.where("status <> 'ok'").isEmpty()
    assert missing_tables(catalog, target_catalog(spark, targets)).isEmpty()
    assert targets["seg"].current(spark).count() == 2
    again = load_missing(
        spark, source, catalog, target_catalog(spark, targets), targets.get, f"{tmp_path}/log2"
    )
    assert again.isEmpty()


def test_full_load_reconciles_and_clears_flags(spark, tmp_path, world):
    source, targets, _ = world
    control = spark.createDataFrame(
        [("app1", True, None), ("app2", True, None), ("app3", False, None)],
        "app_id string, flag boolean, fullload_timestamp timestamp",
    )
    at = datetime(2024, 1, 1)
    for _ in range(2):
        log, after = full_load(
            spark, source, control, list(targets), targets.get, f"{tmp_path}/log", at
        )
    assert log.count() == 4
    assert {r.app_id: r.flag for r in after.collect()} == {"app1": False, "app2": False, "app3": False}
    assert after.where("fullload_timestamp is not null").count() == 2
    for name, target in targets.items():
        rows = source.frames[name].where("schema_name <> 'app3'")
        loaded = target.current(spark).select(rows.columns)
        assert reconcile_rows(rows, loaded, ["schema_name", "id"]).isEmpty()


def test_full_load_of_a_tenant_spelled_otherwise(spark, tmp_path, world):
    source, targets, _ = world
    upper = {n: f.withColumn("schema_name", F.upper("schema_name")) for n, f in source.frames.items()}
    control = spark.createDataFrame([("App1", True)], "app_id string, flag boolean")
    log, after = full_load(
        spark, FrameTables(upper), control, ["users"], targets.get, f"{tmp_path}/log",
        datetime(2024, 1, 1),
    )
    assert [tuple(r)[:3] for r in log.collect()] == [("app1", "users", "ok")]
    assert not after.first().flag
    assert targets["users"].current(spark).count() == 30


def test_a_failing_table_is_logged_and_keeps_the_flag(spark, tmp_path, world):
    source, targets, catalog = world
    broken = FrameTables({"users": source.frames["users"]})
    control = spark.createDataFrame(
        [("app1", True)], "app_id string, flag boolean"
    )
    log, after = full_load(
        spark, broken, control, list(targets), targets.get, f"{tmp_path}/log", datetime(2024, 1, 1)
    )
    assert sorted((r.table_name, r.status) for r in log.collect()) == [("seg", "failed"), ("users", "ok")]
    assert after.first().flag
    with pytest.raises(LoadFailed) as info:
        load_missing(
            spark, broken, lower_schema(catalog), target_catalog(spark, targets), targets.get,
            f"{tmp_path}/log2",
        )
    assert info.value.run_log.where("status = 'failed'").count() == 2


class Changing(FrameTables):
    """A source that is not what was read from it: by a row, by a value."""

    def counts(self, name, tenants):
        more = F.when(F.col("schema_name") == "app2", 1).otherwise(0)
        return super().counts(name, tenants).withColumn("n_source", F.col("n_source") + more)

    def sums(self, name, tenants, rows):
        what, found = super().sums(name, tenants, rows)
        return what, found.withColumn("two", F.col("two") + F.when(F.col("schema_name") == "app3", 1).otherwise(0))


def test_only_tenants_that_pass_are_published(spark, tmp_path, world):
    source, targets, _ = world
    users = targets["users"]
    names = ["app1", "app2", "app3", "app4"]
    old = spark.createDataFrame([(n, 99, "old") for n in names], ROW)
    users.load(old, old.select("schema_name"))
    rows = source.frames["users"].union(spark.createDataFrame([("App4", 1, "fine"), ("App4", 2, "much too long")], ROW))
    control = spark.createDataFrame([(n, True) for n in [*names, "app5"]], "app_id string, flag boolean")
    log, after = full_load(
        spark, Changing({"users": rows}), control, ["users"], targets.get, f"{tmp_path}/log", datetime(2024, 1, 1),
        limits={"users": {"value": 8}},
    )
    messages = {r.app_id: r.message for r in log.collect()}
    assert messages == {
        "app1": None,
        "app2": "2 rows in the source, 1 were read",
        "app3": "the rows read are not those of the source",
        "app4": "value: String is too long and would be truncated (1 of them, up to 13 long)",
        "app5": None,
    }
    assert {r.app_id for r in after.collect() if r.flag} == {"app2", "app3", "app4"}
    held = {}
    for r in users.current(spark).collect():
        held.setdefault(r.schema_name, set()).add(r.value)
    assert held == {"app1": {"u"}, "app2": {"old"}, "app3": {"old"}, "app4": {"old"}}


def test_landing_batch_and_tenants(spark, tmp_path, world):
    _, targets, _ = world
    change = "id int, value string, ts int, op string"
    for tenant in ("app1", "app7"):
        rows = spark.createDataFrame([(1, "x", 1, "U"), (2, "y", 1, "U")], change)
        rows.coalesce(1).write.parquet(f"{tmp_path}/events/{tenant}/users")
    available = spark.createDataFrame([("APP1", "USERS")], "schema_name string, table_name string")
    apply_landing(
        spark, f"{tmp_path}/events", change, "users", targets["users"], available,
        f"{tmp_path}/aside", op_col="op",
    )
    assert {r.schema_name for r in targets["users"].current(spark).collect()} == {"app1"}
    assert {r.schema_name for r in spark.read.parquet(f"{tmp_path}/aside").collect()} == {"app7"}

    from tablesync.sources.landing import landing_index

    index = landing_index(spark, f"{tmp_path}/events")
    assert {(r.schema_name, r.table_name) for r in index.collect()} == {
        ("app1", "users"), ("app7", "users"),
    }
    path = f"{tmp_path}/control"
    control = spark.createDataFrame([("APP1", True)], "app_id string, flag boolean")
    control.write.parquet(path)
    for _ in range(2):
        register_tenants(index, spark.read.parquet(path), path)
    assert sorted(r.app_id for r in spark.read.parquet(path).collect()) == ["APP1", "APP7"]


def test_catalog_tables(spark, tmp_path):
    ensure_schema(spark, "stage")
    ensure_schema(spark, "stage")
    for n in (3, 2):
        refresh_table(spark.range(n), "stage.snapshot")
    write_table(spark.range(1), "stage.snapshot")
    assert spark.table("stage.snapshot").count() == 3
    path = f"{tmp_path}/folder"
    spark.range(3).write.parquet(path)
    replace_folder(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
