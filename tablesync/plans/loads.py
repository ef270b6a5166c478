"""Loading tables of many tenants, and the jobs built on it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.config import TOO_LONG_MESSAGE
from tablesync.functions.names import same_name
from tablesync.operators.catalog import missing_tables
from tablesync.operators.checksums import Compared, FrameSide, differing
from tablesync.operators.control import FAILED, OK, clear_flags, full_load_plan
from tablesync.operators.keys import KeyList
from tablesync.operators.reconcile import compare_counts, overlength
from tablesync.session import reliable, staged
from tablesync.sinks.history import RunHistory
from tablesync.sinks.target import TargetTable
from tablesync.sources.frames import empty_frame

TENANT = "schema_name"


class SourceTables(Protocol):
    """Where the rows of a table name come from, for several tenants at once."""

    by_tenant: bool

    def table(self, name: str, tenants: DataFrame) -> DataFrame: ...

    def counts(self, name: str, tenants: DataFrame) -> DataFrame: ...

    def sums(self, name: str, tenants: DataFrame, rows: DataFrame) -> tuple[Compared, DataFrame] | None: ...


class LoadFailed(Exception):
    """Some tables could not be loaded; ``run_log`` says which."""

    def __init__(self, message: str, run_log: DataFrame):
        super().__init__(message)
        self.run_log = run_log


def load_tables(
    spark: SparkSession,
    source: SourceTables,
    plan: DataFrame,
    target_of: Callable[[str], TargetTable],
    log_path: str,
    limits: Mapping[str, Mapping[str, int]] | None = None,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Load every (``schema_name``, ``table_name``) of the plan; return the run log.

    One job per table name covers all its tenants, since the names differ in
    their columns and the tenants do not. Rows are read to a staging place and
    compared with the source there (counts, checksums), and with the lengths that
    ``limits`` allows the columns of a table name. Only tenants that pass are
    published; the others keep the rows they had and are logged. A name
    that fails is logged and the others go on.

    The log of each run is kept below ``log_path`` (see :class:`RunHistory`,
    which also has a plan for the tables to be tried again).
    """
    history, at = RunHistory(log_path), run_ts or datetime.now(timezone.utc)
    run = uuid.uuid4().hex
    # Fixed before the first write, which may change the catalog it comes from.
    plan = reliable(plan.select(TENANT, "table_name").distinct())
    for row in plan.select("table_name").distinct().toLocalIterator():
        name = row["table_name"]
        tenants = plan.where(F.col("table_name") == name).select(TENANT)
        try:
            log = _load_one(spark, source, name, tenants, target_of(name), (limits or {}).get(name, {}))
            history.record(log, run, at, name)
        except Exception as error:  # noqa: BLE001 - whatever went wrong goes to the log
            history.record(_failed(tenants, name, str(error)), run, at, name)
    return history.of(spark, run)


def _load_one(
    spark: SparkSession,
    source: SourceTables,
    name: str,
    tenants: DataFrame,
    target: TargetTable,
    limits: Mapping[str, int],
) -> DataFrame:
    """Read the source once to a staging place, and publish the tenants that pass there."""
    with staged(source.table(name, tenants), "load") as rows:
        verdicts = reliable(_verdicts(source, name, tenants, rows, limits))
        passed = verdicts.where(F.col("status") == OK).select(F.col("app_id").alias(TENANT))
        listed = KeyList.of(passed.select(F.col(TENANT).alias("__tenant")), ["__tenant"])
        good = listed.keep(rows.withColumn("__tenant", F.lower(TENANT))).drop("__tenant")
        # An empty plan of tenants would leave the target's folder without a table.
        if not passed.isEmpty():
            target.load(good, passed)
    return verdicts.select("app_id", F.lit(name).alias("table_name"), "status", "message")


def _verdicts(
    source: SourceTables, name: str, tenants: DataFrame, rows: DataFrame, limits: Mapping[str, int]
) -> DataFrame:
    """``app_id, status, message`` of each planned tenant: what was read against the source.

    Counts are compared, then checksums if the source has some, then the
    lengths of strings; the first that is off is the message.
    """

    def by_tenant(found: DataFrame, *sums: str) -> DataFrame:
        lowered = found.groupBy(F.lower(TENANT).alias(TENANT))
        return lowered.agg(*[F.sum(c).cast("long").alias(c) for c in sums])

    read = by_tenant(rows.groupBy(TENANT).agg(F.count(F.lit(1)).alias("n_target")), "n_target")
    counts = compare_counts(by_tenant(source.counts(name, tenants), "n_source"), read, [TENANT])
    message = F.when(
        F.col("n_source") != F.col("n_target"),
        F.format_string("%d rows in the source, %d were read", "n_source", "n_target"),
    )
    planned = tenants.select(F.lower(TENANT).alias(TENANT)).distinct()
    found = planned.join(counts, TENANT, "left")
    if sums := source.sums(name, tenants, rows):
        what, theirs = sums
        theirs = theirs.withColumn("bucket", F.lit(0).cast("long"))
        sides = [side.withColumn(TENANT, F.lower(TENANT)) for side in (theirs, FrameSide(rows).sums(what, 0))]
        off = differing(*sides, [TENANT]).select(TENANT, F.lit(True).alias("__off"))
        found = found.join(off, TENANT, "left")
        message = F.coalesce(message, F.when(F.col("__off"), "the rows read are not those of the source"))
    if limits:
        over = overlength(rows, limits, [TENANT]).groupBy(F.lower(TENANT).alias(TENANT))
        over = over.agg(F.min(F.struct("column_name", "n_over", "max_len")).alias("__over"))
        text = F.format_string(
            f"%s: String {TOO_LONG_MESSAGE} (%d of them, up to %d long)", "__over.column_name", "__over.n_over", "__over.max_len"
        )
        found = found.join(over, TENANT, "left")
        message = F.coalesce(message, F.when(F.col("__over").isNotNull(), text))
    found = found.select(F.col(TENANT).alias("app_id"), message.alias("message"))
    return found.select("app_id", F.when(F.col("message").isNull(), OK).otherwise(FAILED).alias("status"), "message")


def _failed(tenants: DataFrame, name: str, message: str) -> DataFrame:
    return tenants.select(
        F.col(TENANT).alias("app_id"),
        F.lit(name).alias("table_name"),
        F.lit(FAILED).alias("status"),
        F.lit(message).alias("message"),
    )


def load_missing(
    spark: SparkSession,
    source: SourceTables,
    source_catalog: DataFrame,
    target_catalog: DataFrame,
    target_of: Callable[[str], TargetTable],
    log_path: str,
) -> DataFrame:
    """Create and load the source tables that the target lacks.

    Only partitions of tenants without the table are written, so a second run
    finds nothing to do and a broken run can be repeated.
    """
    plan = missing_tables(source_catalog, target_catalog)
    run_log = load_tables(spark, source, plan, target_of, log_path)
    failures = run_log.where(F.col("status") == FAILED).count()
    if failures:
        raise LoadFailed(f"{failures} tables could not be loaded", run_log)
    return run_log


def full_load(
    spark: SparkSession,
    source: SourceTables,
    control: DataFrame,
    tables: list[str],
    target_of: Callable[[str], TargetTable],
    log_path: str,
    run_ts: datetime,
    limits: Mapping[str, Mapping[str, int]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Load all tables of the flagged tenants; return run log and new control table.

    A tenant keeps its flag if one of its tables failed, and the rows it had of
    that table (see :func:`load_tables`). The caller writes the
    control table (see ``replace_folder``), and decides whether to raise.
    """
    plan = full_load_plan(control, tables).withColumnRenamed("app_id", TENANT)
    run_log = load_tables(spark, source, plan, target_of, log_path, limits, run_ts)
    return run_log, clear_flags(control, run_log, run_ts, only_run=True)


def target_catalog(spark: SparkSession, targets: dict[str, TargetTable]) -> DataFrame:
    """The (tenant, table) pairs that replicated tables hold, from their folders."""
    found = empty_frame(spark, "table_schema string, table_name string")
    for name, target in targets.items():
        held = target.tenants(spark).withColumnRenamed(target.tenant, "table_schema")
        found = found.unionByName(held.withColumn("table_name", F.lit(name)))
    return found


def changed_tenants(index: DataFrame, schema: str = TENANT) -> DataFrame:
    """Distinct tenants of landing files, in the form the control table holds."""
    return index.select(same_name(schema).alias("app_id")).distinct()
