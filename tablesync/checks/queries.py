"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablesync.checks import views as v
from tablesync.functions.names import (
    qualified,
    quoted,
    schema_part,
    stamped,
    table_part,
    timestamp_text,
)
from tablesync.operators import batches, catalog, cdc, checksums, control, reconcile
from tablesync.plans.catalogs import Shape
from tablesync.plans.changes import Route, apply_new
from tablesync.plans.increments import pull_increment
from tablesync.plans.loads import full_load, load_missing
from tablesync.session import scratch_path
from tablesync.sinks.appended import AppendedTable
from tablesync.sinks.bookmark import Bookmark
from tablesync.sinks.history import RunHistory
from tablesync.sinks.ledger import FileLedger
from tablesync.sinks.tables import replace_folder
from tablesync.sinks.target import TargetTable
from tablesync.sources.database import FrameTables
from tablesync.sources.frames import sql_over
from tablesync.sources.growing import Growing, GrowingFrames
from tablesync.sources.landing import landing_index, read_changes
from tablesync.streaming.sync import sync_stream, sync_tables

Query = Callable[[SparkSession, str], DataFrame]

KEYS = ["id"]
ORDER = ["ts", "seq"]


# Catalogs ---------------------------------------------------------------------


def catalog_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    names = [f"tbl_{n}" for n in range(1, 10)]
    return catalog.catalog_snapshot(v.src_catalog(spark, sf), names, "app7").drop("synced_at")


def catalog_by_sql(spark: SparkSession, sf: str) -> DataFrame:
    query = """
        SELECT table_schema AS src_schema, table_name AS src_table, table_type
        FROM {tables} WHERE table_schema <> 'app7' AND table_type <> 'VIEW'
    """
    return sql_over(spark, query, tables=v.src_catalog(spark, sf))


def missing_tables(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.missing_tables(v.src_catalog(spark, sf), v.wh_tables(spark, sf))


def column_catalog(spark: SparkSession, sf: str) -> DataFrame:
    schemas = v.src_catalog(spark, sf).where("table_type <> 'VIEW'")
    return catalog.column_catalog(v.wh_columns(spark, sf), schemas, exclude="TBL_1")


def available_tables(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.available_tables(v.wh_columns(spark, sf))


def group_tables(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.group_tables(v.src_catalog(spark, sf))


def union_catalogs(spark: SparkSession, sf: str) -> DataFrame:
    source = v.src_catalog(spark, sf).select("table_schema", "table_name")
    return catalog.union_catalogs(v.wh_tables(spark, sf), source)


def split_available(spark: SparkSession, sf: str) -> DataFrame:
    known, unknown = catalog.split_available(
        v.src_catalog(spark, sf), v.wh_tables(spark, sf), ["table_schema", "table_name"]
    )
    return known.withColumn("place", F.lit("target")).unionByName(
        unknown.withColumn("place", F.lit("quarantine"))
    )


def identifiers(spark: SparkSession, sf: str) -> DataFrame:
    name = qualified("table_schema", "table_name")
    return v.src_catalog(spark, sf).select(
        name.alias("full_name"),
        quoted("table_schema", "table_name").alias("quoted_name"),
        schema_part(name).alias("schema_name"),
        table_part(name).alias("table_name"),
    )


def stamped_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = v.table(spark, sf, "orders").select(
        "o_orderkey", timestamp_text("o_orderdate").alias("order_time")
    )
    rows = stamped(orders, "run_ts", datetime(2024, 1, 31, 12, 30))
    return rows.withColumn("run_ts", timestamp_text("run_ts"))


# Landing files ----------------------------------------------------------------


def landing_index_query(spark: SparkSession, sf: str) -> DataFrame:
    return batches.group_files(batches.index_paths(v.landing(spark, sf)))


def initial_filter(spark: SparkSession, sf: str) -> DataFrame:
    index = batches.index_paths(v.landing(spark, sf))
    return (
        batches.initial_filter(index)
        .groupBy("schema_name")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )


def batch_assign(spark: SparkSession, sf: str) -> DataFrame:
    return batches.batch_assign(batches.index_paths(v.landing(spark, sf)), size=2)


def batch_members(spark: SparkSession, sf: str) -> DataFrame:
    index = batches.index_paths(v.landing(spark, sf))
    flagged = v.control(spark, sf).where("flag")
    return batches.batch_members(index, flagged).select("event_id", "path")


def weighted_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Tenants by their orders in six runs; one tenant is a giant."""
    times = F.when(F.col("schema_name") == "app7", 40).otherwise(1)
    weights = v.tenant_rows(spark, sf).select("schema_name", times.alias("weight"))
    return batches.batch_by_weight(weights, 6)


# Changes ----------------------------------------------------------------------


def align_changes(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType.fromDDL("ID int, amount double, seq string, note string")
    return cdc.align(v.changes(spark, sf), schema, ["last_type", "ts", "op"]).withColumnRenamed("ID", "id")


def latest_change(spark: SparkSession, sf: str) -> DataFrame:
    newest = cdc.latest_change(v.changes(spark, sf), KEYS, ORDER)
    return newest.select("id", "amount", "last_type", "op")


def apply_changes(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.apply_changes(
        v.target_snapshot(spark, sf), v.changes(spark, sf), KEYS, ORDER, op_col="op"
    )


def late_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Newer changes first, older ones late, all of them twice."""
    rows = v.changes(spark, sf)
    target = v.target_snapshot(spark, sf).select(
        "*",
        F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.lit(None).cast("long").alias("seq"),
        F.lit(False).alias(cdc.DELETED),
    )
    late = F.dayofmonth("ts") < 20
    for part in (rows.where(~late), rows, rows.where(late)):
        target = cdc.apply_changes(target, part, KEYS, ORDER, op_col="op")
    return target.where(~F.col(cdc.DELETED)).select("id", "amount", "last_type")


def _tenant_of(name: str) -> Column:
    return F.concat(F.lit("app"), (F.col(name) % 5).cast("string"))


def _tenant() -> Column:
    return _tenant_of("id")


def _changed_table(spark: SparkSession | None, folder: str) -> TargetTable:
    return TargetTable(
        path=f"{folder}/target",
        keys=("id",),
        order=("ts", "seq"),
        buckets=2,
        tenant_buckets={"schema_name=app1": 4},
        schema="id long, amount double, last_type string, ts timestamp_ntz, seq long, "
        "schema_name string",
    )


def merge_table(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table: full load, then changes in two runs, the older run last."""
    target = _changed_table(spark, scratch_path(spark, "merge"))
    first = v.target_snapshot(spark, sf).withColumn("schema_name", _tenant())
    target.load(first, first.select("schema_name"))
    rows = v.changes(spark, sf).withColumn("schema_name", _tenant())
    late = F.dayofmonth("ts") < 20
    target.merge(rows.where(~late), op_col="op")
    target.merge(rows.where(late), op_col="op", broadcast_bytes=0)
    return target.current(spark).select("schema_name", "id", "amount", "last_type")


def split_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table whose tenants get more buckets between two merges, the second by a job with other counts."""
    target = _changed_table(spark, scratch_path(spark, "buckets"))
    first = v.target_snapshot(spark, sf).withColumn("schema_name", _tenant())
    target.load(first, first.select("schema_name"))
    rows = v.changes(spark, sf).withColumn("schema_name", _tenant())
    late = F.dayofmonth("ts") < 20
    target.merge(rows.where(~late), op_col="op")
    target.split(spark, "app1", 2)
    target.split(spark, "app3")
    replace(target, buckets=7, tenant_buckets={}).merge(rows.where(late), op_col="op")
    return target.current(spark).select("schema_name", "id", "amount", "last_type")


def partial_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Changes without ``last_type`` on a stored table: its values stay."""
    target = _changed_table(spark, scratch_path(spark, "partial"))
    first = v.target_snapshot(spark, sf).withColumn("schema_name", _tenant())
    target.load(first.withColumn("last_type", F.lit("loaded")), first.select("schema_name"))
    target.merge(v.changes(spark, sf).drop("last_type").withColumn("schema_name", _tenant()), op_col="op")
    return target.current(spark).select("schema_name", "id", "amount", "last_type")


def tied_changes(spark: SparkSession, sf: str) -> DataFrame:
    """All changes at the same time: in one batch, in two and a repeated one, in memory and stored."""
    rows = v.changes(spark, sf).withColumns(
        {"ts": F.lit("2024-01-01").cast("timestamp_ntz"), "seq": F.lit(0).cast("long"), "schema_name": _tenant()}
    )
    halves = [rows.where("amount < 100"), rows.where("amount >= 100"), rows.where("amount < 100")]
    empty = "schema_name string, id long, amount double, last_type string, ts timestamp_ntz, seq long, deleted boolean"
    memory = spark.createDataFrame([], empty)
    for part in halves:
        memory = cdc.apply_changes(memory, part, ["schema_name", "id"], ORDER, op_col="op")
    whole = _changed_table(spark, scratch_path(spark, "tied"))
    whole.merge(rows, op_col="op")
    split = _changed_table(spark, scratch_path(spark, "tied"))
    for part in halves:
        split.merge(part, op_col="op")
    found = {"memory": memory.where("not deleted"), "whole": whole.current(spark), "split": split.current(spark)}
    return catalog.union_catalogs(
        *[rows.select(F.lit(way).alias("way"), "id", "amount", "last_type") for way, rows in found.items()]
    )


def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of unknown tenants of two tables, as they are set aside by two runs side by side."""
    folder = scratch_path(spark, "aside")
    rows = v.changes(spark, sf)
    for name in ("one", "two"):
        places = rows.withColumn("schema_name", _tenant()).withColumn("table_name", F.lit(name))
        places.write.mode("append").partitionBy("schema_name", "table_name").parquet(f"{folder}/landing")
    available = spark.createDataFrame(
        [(f"schema_name=app{n}", f"table_name={t}") for n in (0, 1) for t in ("one", "two")],
        "schema_name string, table_name string",
    )
    tables = {
        f"table_name={t}": (rows.schema, replace(_changed_table(spark, folder), path=f"{folder}/{t}"))
        for t in ("one", "two")
    }
    sync_tables(
        spark,
        f"{folder}/landing",
        tables,
        f"{folder}/checkpoint",
        op_col="op",
        available=available,
        quarantine=f"{folder}/quarantine",
    )
    aside = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/quarantine")
    return aside.select("schema_name", "table_name", "id", "seq")


def _write_landing(rows: DataFrame, root: str) -> None:
    """Change files as ``<root>/<tenant>/<table>/<file>``."""
    places = rows.withColumn("schema_name", _tenant()).withColumn("table_name", F.lit("changes"))
    places.write.partitionBy("schema_name", "table_name").parquet(root)


def stream_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Landing files applied by a stream to a table that starts from a full load."""
    folder = scratch_path(spark, "stream")
    target = _changed_table(spark, folder)
    first = v.target_snapshot(spark, sf).withColumn(
        "schema_name", F.concat(F.lit("schema_name="), _tenant())
    )
    target.load(first, first.select("schema_name"))
    rows = v.changes(spark, sf)
    _write_landing(rows, f"{folder}/landing")
    sync_stream(
        spark,
        f"{folder}/landing",
        rows.schema,
        "table_name=changes",
        target,
        f"{folder}/checkpoint",
        op_col="op",
        max_files=2,
    ).awaitTermination()
    return target.current(spark).select("schema_name", "id", "amount", "last_type")


def landing_files(spark: SparkSession, sf: str) -> DataFrame:
    """Tenants and tables found by listing landing files."""
    root = scratch_path(spark, "files") + "/landing"
    _write_landing(v.changes(spark, sf), root)
    index = landing_index(spark, root).where("schema_name like 'schema_name=%'")
    return index.where("length > 0").select("schema_name", "table_name").distinct()


def landing_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Changes read back from landing files, with the place each came from."""
    root = scratch_path(spark, "read") + "/landing"
    rows = v.changes(spark, sf)
    _write_landing(rows, root)
    found = read_changes(spark, root, rows.schema, table="table_name=changes")
    return found.select("schema_name", "table_name", "id", "seq", "op")


def _routes(folder: str, schema: T.StructType) -> dict[str, Route]:
    """Two tables with keys and one without, by the names of their landing folders."""
    keyed = {
        f"table_name={name}": Route(replace(_changed_table(None, folder), path=f"{folder}/{name}"), schema, "op")
        for name in ("clicks", "others")
    }
    added = AppendedTable(f"{folder}/all_data", "id long, last_type string, seq long, op string, schema_name string")
    return keyed | {"table_name=all_data": Route(added, "id long, last_type string, seq long, op string")}


def _land(rows: DataFrame, root: str) -> None:
    """Changes of clicks, of all others, and all of them as data without keys."""
    name = F.when(F.col("last_type") == "click", "clicks").otherwise("others")
    places = rows.withColumns({"schema_name": _tenant(), "table_name": F.explode(F.array(name, F.lit("all_data")))})
    places.write.mode("append").partitionBy("schema_name", "table_name").parquet(root)


def _routed_rows(spark: SparkSession, routes: dict[str, Route]) -> DataFrame:
    found = [
        route.target.current(spark).select(F.lit(name).alias("table_name"), "schema_name", "id", "last_type", "seq")
        for name, route in routes.items()
    ]
    return catalog.union_catalogs(*found)


def ledger_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Landing files that arrive in two lots, and are applied in runs of few files; applied files are archived."""
    folder = scratch_path(spark, "ledger")
    root, rows = f"{folder}/landing", v.changes(spark, sf)
    routes = _routes(folder, rows.schema)
    late = F.dayofmonth("ts") < 20
    for lot in (rows.where(~late), rows.where(late)):
        _land(lot, root)
        apply_new(spark, root, routes, FileLedger(f"{folder}/ledger"), archive=f"{folder}/archive", max_files=40)
    return _routed_rows(spark, routes)


def routed_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Files of three table names, one without keys, applied by one call; the same call again alters nothing."""
    folder = scratch_path(spark, "routed")
    root, rows = f"{folder}/landing", v.changes(spark, sf)
    routes = _routes(folder, rows.schema)
    _land(rows, root)
    for _ in range(2):
        apply_new(spark, root, routes, FileLedger(f"{folder}/ledger"))
    return _routed_rows(spark, routes)


def declared_types(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of tenants whose columns have different types, in targets the column catalog declares."""
    folder = scratch_path(spark, "declared")
    kinds = {"app0": ("int", None), "app1": ("number", 12), "app2": ("bigint", None)}
    rows = [
        row
        for tenant, (kind, digits) in kinds.items()
        for row in [
            (f"schema_name={tenant}", "table_name=sums", "id", "bigint", None, None),
            (f"schema_name={tenant}", "table_name=sums", "total", kind, digits, digits and 3),
        ]
    ]
    columns = spark.createDataFrame(
        rows,
        "table_schema string, table_name string, column_name string, data_type string, "
        "numeric_precision int, numeric_scale int",
    )
    changes = v.changes(spark, sf).withColumn("schema_name", F.concat(F.lit("app"), (F.col("id") % 3).cast("string")))
    for tenant, kind in (("app0", "int"), ("app1", "decimal(12,3)"), ("app2", "bigint")):
        lot = changes.where(F.col("schema_name") == tenant).select("id", F.col("amount").cast(kind).alias("total"), "seq")
        lot.write.json(f"{folder}/landing/schema_name={tenant}/table_name=sums")
    shape = Shape(f"{folder}/tables", ("seq",), "seq bigint", keys={"table_name=sums": ["id"]})
    routes = {"table_name=sums": shape.route(columns, "table_name=sums", "json")}
    apply_new(spark, f"{folder}/landing", routes, FileLedger(f"{folder}/ledger"))
    found = routes["table_name=sums"].target.current(spark)
    return found.select("schema_name", "id", F.col("total").cast("string").alias("total"))


# Control table and loads ------------------------------------------------------


def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    tenants = v.table(spark, sf, "events").select(F.col("event_type").alias("app_id"))
    return control.insert_if_absent(v.control(spark, sf), tenants)


def control_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """A stored control table, rewritten in place: new tenants, then flags off."""
    path = scratch_path(spark, "control")
    v.control(spark, sf).write.parquet(path)
    tenants = v.table(spark, sf, "events").select(F.col("event_type").alias("app_id"))
    replace_folder(control.insert_if_absent(spark.read.parquet(path), tenants), path)
    replace_folder(control.clear_flags(spark.read.parquet(path), v.run_log(spark, sf)), path)
    return spark.read.parquet(path)


def full_load_plan(spark: SparkSession, sf: str) -> DataFrame:
    names = [f"tbl_{n}" for n in range(1, 6)]
    # At most as many values as the list has names.
    found = v.src_catalog(spark, sf).where(F.col("table_name").isin(names))
    tables = found.select(F.collect_set(F.lower("table_name"))).scalar()
    return control.full_load_plan(v.control(spark, sf), tables)


def clear_flags(spark: SparkSession, sf: str) -> DataFrame:
    return control.clear_flags(v.control(spark, sf), v.run_log(spark, sf))


def run_history(spark: SparkSession, sf: str) -> DataFrame:
    """The state of every table after three runs, the newest named first, and what is to be tried again."""
    history = RunHistory(scratch_path(spark, "history"))
    failed = F.max("value") > 255
    for n in (0, 1, 2):
        rows = v.table(spark, sf, "events").where(F.col("event_id") % 3 == n)
        log = rows.groupBy(
            F.col("event_type").alias("app_id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("table_name")
        ).agg(F.when(failed, "failed").otherwise("ok").alias("status"), F.when(failed, "connection reset").alias("message"))
        history.record(log, f"run{9 - n}", datetime(2024, 1, 1 + n))
    again = history.retry_plan(spark).select(F.col("schema_name").alias("app_id"), "table_name", F.lit(True).alias("again"))
    found = history.latest(spark).join(again, ["app_id", "table_name"], "left")
    return found.select("app_id", "table_name", "status", "run", F.coalesce("again", F.lit(False)).alias("again"))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.run_summary(v.run_log(spark, sf))


def _tenant_orders(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Three tables that many tenants have: orders by status."""
    orders = v.table(spark, sf, "orders")
    return {
        f"orders_{status.lower()}": orders.where(F.col("o_orderstatus") == status).select(
            F.concat(F.lit("app"), (F.col("o_custkey") % 50).cast("string")).alias("schema_name"),
            F.col("o_orderkey").alias("id"),
            F.col("o_totalprice").alias("amount"),
        )
        for status in ("F", "O", "P")
    }


def _order_target(folder: str) -> Callable[[str], TargetTable]:
    def target_of(name: str) -> TargetTable:
        return TargetTable(
            path=f"{folder}/{name}",
            keys=("id",),
            order=("changed",),
            schema="id long, amount double, changed timestamp_ntz, schema_name string",
        )

    return target_of


def _pairs(tables: dict[str, DataFrame]) -> DataFrame:
    found = [
        rows.select(F.col("schema_name").alias("table_schema"), F.lit(name).alias("table_name"))
        for name, rows in tables.items()
    ]
    return catalog.union_catalogs(*found)


def missing_load(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the tables that the target lacks, after they are loaded."""
    folder = scratch_path(spark, "missing")
    tables = _tenant_orders(spark, sf)
    pairs = _pairs(tables)
    number = F.substring("table_schema", 4, 9).cast("int")
    target_of = _order_target(folder)
    load_missing(
        spark, FrameTables(tables), pairs, pairs.where(number < 40), target_of, f"{folder}/log"
    )
    loaded = [
        target_of(name).current(spark).withColumn("table_name", F.lit(name)) for name in tables
    ]
    return catalog.union_catalogs(*loaded).select("schema_name", "table_name", "id", "amount")


def full_load_log(spark: SparkSession, sf: str) -> DataFrame:
    """Run log and new control table of a full load of the flagged tenants."""
    folder = scratch_path(spark, "full")
    tables = _tenant_orders(spark, sf)
    number = F.substring("app_id", 4, 9).cast("int")
    tenants = (
        _pairs(tables)
        .select(F.col("table_schema").alias("app_id"))
        .distinct()
        .withColumn("flag", number % 3 == 0)
    )
    log, after = full_load(
        spark,
        FrameTables(tables),
        tenants,
        list(tables),
        _order_target(folder),
        f"{folder}/log",
        datetime(2024, 1, 31, 12, 30),
    )
    return log.select("app_id", "table_name", "status").unionByName(
        after.select(
            "app_id", F.lit("control").alias("table_name"), F.col("flag").cast("string").alias("status")
        )
    )


def bookmark_reads(spark: SparkSession, sf: str) -> DataFrame:
    """A table read in three steps by a growing time; some rows of the last days before a step come late."""
    folder = scratch_path(spark, "bookmark")
    rows = v.table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("value").alias("amount"), "ts", _tenant_of("user_id").alias("schema_name")
    )
    target = TargetTable(f"{folder}/events", ("id",), ("ts",), schema="id long, amount double, ts timestamp_ntz, schema_name string")
    bookmark, growing = Bookmark(f"{folder}/marks"), Growing("ts", timedelta(days=3))
    for day in (10, 20, 32):
        late = (F.dayofmonth("ts") >= day - 2) & (F.col("id") % 7 == 3)
        seen = rows.where((F.dayofmonth("ts") < day) & ~(late & F.lit(day < 32)))
        tenants = rows.select("schema_name").distinct()
        pull_increment(spark, GrowingFrames({"events": seen}), "events", tenants, target, bookmark, growing)
    return target.current(spark).select("schema_name", "id", "amount")


class _Grown(FrameTables):
    """A source that one tenant has added a row to since it was read."""

    def counts(self, name: str, tenants: DataFrame) -> DataFrame:
        more = F.when(F.lower("schema_name") == "app5", 1).otherwise(0)
        return super().counts(name, tenants).withColumn("n_source", F.col("n_source") + more)


def staged_publish(spark: SparkSession, sf: str) -> DataFrame:
    """What tenants hold after a load in which one has a too long string and one has changed: these keep their old rows."""
    folder = scratch_path(spark, "publish")
    target = TargetTable(
        f"{folder}/orders", ("id",), ("changed",),
        schema="id long, amount double, note string, changed timestamp_ntz, schema_name string",
    )
    rows = v.tenant_rows(spark, sf)
    old = rows.withColumns({"amount": F.lit(0.0), "note": F.lit("old")})
    target.load(old, old.select("schema_name"))
    note = F.when((F.col("schema_name") == "app3") & (F.col("id") % 7 == 0), "far too long").otherwise("new")
    tenants = rows.select(F.col("schema_name").alias("app_id")).distinct().withColumn("flag", F.lit(True))
    log, after = full_load(
        spark,
        _Grown({"orders": rows.withColumn("note", note)}),
        tenants,
        ["orders"],
        lambda name: target,
        f"{folder}/log",
        datetime(2024, 1, 31, 12, 30),
        {"orders": {"note": 5}},
    )
    held = target.current(spark).groupBy(F.col("schema_name").alias("app_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("amount").alias("most"), F.min("note").alias("note")
    )
    return held.join(log.select("app_id", "status"), "app_id").join(after.select("app_id", "flag"), "app_id")


# Reconciliation ---------------------------------------------------------------


def reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    source = v.src_catalog(spark, sf).select(F.upper("table_schema").alias("schema_name"))
    target = v.wh_tables(spark, sf).select(F.col("table_schema").alias("schema_name"))
    return reconcile.reconcile_counts(source, target, ["schema_name"])


def reconcile_schema(spark: SparkSession, sf: str) -> DataFrame:
    columns = v.wh_columns(spark, sf)
    is_name = F.col("column_name") == "NAME"
    target = columns.where(~(F.col("table_name").like("%3") & (F.col("column_name") == "ID")))
    target = target.withColumn(
        "data_type",
        F.when(F.col("table_name").like("%5") & is_name, "VARIANT").otherwise(F.col("data_type")),
    )
    source = columns.where(~(F.col("table_name").like("%7") & is_name))
    return reconcile.reconcile_schema(source, target)


def reconcile_rows(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.reconcile_rows(v.src_rows(spark, sf), v.tgt_rows(spark, sf), KEYS)


def reconcile_hashed(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.reconcile_rows(
        v.src_rows(spark, sf), v.tgt_rows(spark, sf), KEYS, fingerprint=True
    )


def reconcile_checksums(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against a stored copy with few differences, by checksums of buckets of each tenant."""
    source = v.tenant_rows(spark, sf)
    key = F.col("id")
    copy = source.where(key % 997 != 0).withColumn(
        "amount", F.when(key % 991 == 0, F.col("amount") + 1).otherwise(F.col("amount"))
    )
    copy = copy.unionByName(source.where((key % 983 == 0) & (key > 0)).withColumn("id", -key))
    path = scratch_path(spark, "copy")
    copy.write.partitionBy("schema_name").parquet(path)
    stored = spark.read.schema(copy.schema).parquet(path)
    what = checksums.Compared.of(source, KEYS, ["schema_name"])
    return checksums.reconcile_tree(checksums.FrameSide(source), checksums.FrameSide(stored), what, (4, 12))


def overlength(spark: SparkSession, sf: str) -> DataFrame:
    documents = v.table(spark, sf, "documents")
    return reconcile.overlength(documents, {"text": 2000}, ["lang"]).drop("column_name")


QUERIES: dict[str, Query] = {
    "catalog_snapshot": catalog_snapshot,
    "catalog_by_sql": catalog_by_sql,
    "missing_tables": missing_tables,
    "column_catalog": column_catalog,
    "available_tables": available_tables,
    "group_tables": group_tables,
    "union_catalogs": union_catalogs,
    "split_available": split_available,
    "identifiers": identifiers,
    "stamped_orders": stamped_orders,
    "landing_index": landing_index_query,
    "landing_files": landing_files,
    "landing_changes": landing_changes,
    "initial_filter": initial_filter,
    "batch_assign": batch_assign,
    "batch_members": batch_members,
    "weighted_batches": weighted_batches,
    "align_changes": align_changes,
    "latest_change": latest_change,
    "apply_changes": apply_changes,
    "late_changes": late_changes,
    "merge_table": merge_table,
    "split_buckets": split_buckets,
    "stream_changes": stream_changes,
    "partial_changes": partial_changes,
    "tied_changes": tied_changes,
    "quarantine_rows": quarantine_rows,
    "ledger_changes": ledger_changes,
    "routed_changes": routed_changes,
    "declared_types": declared_types,
    "insert_if_absent": insert_if_absent,
    "control_rewrite": control_rewrite,
    "fullload_plan": full_load_plan,
    "clear_flags": clear_flags,
    "run_summary": run_summary,
    "run_history": run_history,
    "missing_load": missing_load,
    "full_load_log": full_load_log,
    "staged_publish": staged_publish,
    "bookmark_reads": bookmark_reads,
    "reconcile_counts": reconcile_counts,
    "reconcile_schema": reconcile_schema,
    "reconcile_rows": reconcile_rows,
    "reconcile_hashed": reconcile_hashed,
    "reconcile_checksums": reconcile_checksums,
    "overlength": overlength,
}
